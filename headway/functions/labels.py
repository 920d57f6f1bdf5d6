"""Text-building scalar functions: route label (F4, F5), trusted URL (F15), readable size (F16).

All are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last headsign letter -> direction word (anything else is kept as is)
DIRECTION_WORDS = {"E": "EST", "O": "OUEST", "S": "SUD", "N": "NORD"}

# Binary unit ladder of the size report
SIZE_UNITS = ["", "Ki", "Mi", "Gi", "Ti", "Pi", "Ei", "Zi"]


def direction_word(headsign: Column) -> Column:
    """last character of the headsign mapped to its direction word."""
    last = F.substring(headsign, -1, 1)
    word = None
    for letter, name in DIRECTION_WORDS.items():
        word = (F.when(last == letter, name) if word is None else word.when(last == letter, name))
    return word.otherwise(last)


def route_info(route_id: Column, route_long_name: Column, headsign: Column) -> Column:
    """``<route_id> <long name> dir. <direction>``; null when any part is null."""
    return F.concat(route_id.cast("string"), F.lit(" "), route_long_name, F.lit(" dir. "),
                    direction_word(headsign))


def url_path(url: Column) -> Column:
    """Path component of a URL: no scheme/host, query, fragment or last-segment ``;params``."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def trusted_url(url: Column, origin: str) -> Column:
    """keep the path, force the trusted scheme and host, drop query and fragment."""
    return F.concat(F.lit(origin.rstrip("/")), url_path(url))


def _one_decimal(value: Column) -> Column:
    """One decimal, ties to even, no thousands separator."""
    return F.format_string("%.1f", F.bround(value, 1))


def readable_size(num_bytes: Column, suffix: str = "B") -> Column:
    """F16: bytes -> ``'12.3 MiB'``; divide by 1024 while the value is at least 1024."""
    b = num_bytes.cast("double")
    out = None
    for i, unit in enumerate(SIZE_UNITS):
        scaled = b / F.pow(F.lit(1024.0), F.lit(i))
        text = F.concat(_one_decimal(scaled), F.lit(f" {unit}{suffix}"))
        cond = F.abs(b) < F.pow(F.lit(1024.0), F.lit(i + 1))
        out = F.when(cond, text) if out is None else out.when(cond, text)
    last = F.concat(_one_decimal(b / F.pow(F.lit(1024.0), F.lit(len(SIZE_UNITS)))),
                    F.lit(f" Yi{suffix}"))
    return out.otherwise(last)
