"""Struct flattening (F11): nested record -> flat columns named ``parent_child``.

Schema driven: the select list is generated from the DataFrame's StructType,
so the work stays a projection inside codegen.  Arrays are kept as array
columns (trip-update ``stopTimeUpdate`` lists), only structs are opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def flat_columns(schema: StructType, sep: str = "_", prefix: tuple[str, ...] = ()) -> list[Column]:
    out: list[Column] = []
    for field in schema.fields:
        path = prefix + (field.name,)
        if isinstance(field.dataType, StructType):
            out.extend(flat_columns(field.dataType, sep, path))
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            out.append(ref.alias(sep.join(path)))
    return out


def flatten(df: DataFrame, sep: str = "_", sort_columns: bool = True) -> DataFrame:
    """F11 + O2: open every nested struct; optionally sort the columns by name."""
    cols = flat_columns(df.schema, sep)
    flat = df.select(*cols)
    return flat.select(*sorted(flat.columns)) if sort_columns else flat
