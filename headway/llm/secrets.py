"""Operator 4, secret scan by corpus-wide ownership (DataFrame functions only).

1. Row by row, candidate spans of each kind are found in the whole text.
   ``split`` and ``regexp_extract_all`` by the same pattern give the gaps and
   the matches in turn; their running lengths are the spans in code points.
2. The candidates' values are hashed and counted over the whole corpus: in how
   many distinct repositories (here: texts, so copies of one document are one) and
   of how many distinct owners (here: sources) does a value occur?  Repeats are
   taken out per (value, owner) and per (value, repository) before they are
   exchanged, so a value that a third of all rows hold never meets in one task
   before it is a handful of counters.
3. A value of at least ``WIDESPREAD`` owners and as many repositories is a widely
   copied example.  One that few own, or that only copies of a text or two hold,
   whoever owns them, is a live-looking credential.

Kinds ``assign``, ``access`` and ``hex`` are the base.  The method adds kind
``opaque``: a run of at least 32 URL-safe characters with small letters, capital
letters and digits, outside all base spans, whose value is live-looking.

A null text is empty.  A null owner counts as an owner of its own.  Texts of any
length are scanned whole; spans that start together are ordered by kind.  Repeated
rows are scanned each, but count once for an owner and a repository.  An empty
table gives an empty result.  Other columns are ignored by ``scan`` and kept by
``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import pinned

KINDS = ["assign", "access", "hex", "opaque"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# The longer minimum finds the same spans as a filter after the match: runs are maximal.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# The look-around spares attempts within a run; the spans are those of [A-Za-z0-9_-]{32,}.
OPAQUE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{32})[A-Za-z0-9_-]{32,}"
MIN_ASSIGN = 6
WIDESPREAD = 3
MARK = "[SECRET]"

SPAN = "struct<start:int,rank:int,end:int,value:string>"


def _spans(text: Column, kind: str, pattern: str, group: int = 0, least: int = 1) -> Column:
    """Spans of the pattern's matches whose ``group`` has at least ``least`` characters."""
    zipped = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(F.char_length(x["found"]), F.lit(0))
        value = F.regexp_extract(x["found"], pattern, group) if group else x["found"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
                        value.alias("value"))
        return F.struct(end.alias("at"), F.when(F.coalesce(F.char_length(value) >= least, F.lit(False)),
                                                F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda a: a["spans"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def base_spans(text: Column) -> Column:
    """assign, access and hex spans by start, then kind."""
    return F.sort_array(F.concat(_spans(text, "assign", ASSIGN, 1, MIN_ASSIGN), _spans(text, "access", ACCESS),
                                 _spans(text, "hex", HEX)))


def opaque_spans(text: Column) -> Column:
    mixed = _spans(text, "opaque", OPAQUE)
    return F.filter(mixed, lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, owner: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document with its spans, its owner and its repository (the text's hash)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spans = F.transform(F.array(base_spans(text)), lambda b: F.struct(b.alias("base"), F.filter(
        opaque_spans(text), lambda o: ~F.exists(b, lambda s: (s["start"] < o["end"]) & (o["start"] < s["end"]))
    ).alias("more")))[0]
    return docs.select(F.xxhash64(text).alias("_repository"),
                       F.coalesce(F.concat(F.lit("+"), F.col(owner).cast("string")), F.lit("-")).alias("_owner"),
                       spans.alias("_spans"), *carry)


def ownership(found: DataFrame) -> DataFrame:
    """(_value, n_owners, n_repositories) of rows (_value, _owner, _repository): the whole corpus."""
    def distinct(of: str, name: str) -> DataFrame:
        return found.select("_value", of).distinct().groupBy("_value").agg(F.count("*").alias(name))

    return distinct("_owner", "n_owners").join(distinct("_repository", "n_repositories"), "_value")


def judged(found: DataFrame, widespread: int = WIDESPREAD) -> DataFrame:
    """Per row number, its spans with the verdict on their value.  ``found``: a pinned frame with _row."""
    flat = (found.where(F.size("_spans.base") + F.size("_spans.more") > 0)
            .select("_row", "_owner", "_repository", F.explode(F.concat("_spans.base", "_spans.more")).alias("_span"))
            .withColumn("_value", F.xxhash64("_span.value")))
    owned = ownership(flat.select("_value", "_owner", "_repository"))
    return (flat.join(owned, "_value")
            .withColumn("_live", (F.col("n_owners") < widespread) | (F.col("n_repositories") < widespread))
            .where(F.col("_live") | (F.col("_span.rank") < KINDS.index("opaque")))
            .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
                F.col("_span.start").alias("start"), F.col("_span.rank").alias("rank"),
                F.col("_span.end").alias("end"), F.col("_live").alias("live"),
                F.concat_ws("/", "n_owners", "n_repositories").alias("held")))).alias("_judged")))


def scan(docs: DataFrame, widespread: int = WIDESPREAD) -> DataFrame:
    """Counts, spans and ownership verdicts of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    found = pinned(candidates(docs, carry=("doc_id",)).withColumn("_row", F.monotonically_increasing_id()))
    base = F.col("_spans.base")

    def n(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["rank"] == KINDS.index(kind))).cast("long")

    spans = F.coalesce("_judged", F.array().cast("array<struct<start:int,rank:int,end:int,live:boolean,held:string>>"))
    return (found.join(judged(found, widespread), "_row", "left")
            .select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                    F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"),
                    F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
                    F.size(F.filter(spans, lambda s: ~s["live"])).cast("long").alias("n_widespread"),
                    # owners and repositories of each span's value, in the order of ``spans``
                    F.array_join(F.transform(spans, lambda s: s["held"]), ",").alias("ownership")))


def redact(docs: DataFrame, mark: str = MARK, widespread: int = WIDESPREAD) -> DataFrame:
    """``docs``, all rows and columns, with live-looking spans of ``text`` replaced by ``mark``.

    Only documents with a candidate are exchanged; the others pass through.
    Where there is a column ``n_chars``, it is counted anew.
    """
    names = docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    suspect = F.coalesce(text.rlike("|".join((ASSIGN, ACCESS, HEX, OPAQUE))), F.lit(False))
    kept = F.struct(*[F.col(c) for c in names]).alias("_doc")
    found = pinned(candidates(docs.where(suspect), carry=(kept,))
                   .withColumn("_row", F.monotonically_increasing_id()))
    live = F.filter("_judged", lambda s: s["live"])

    def cut(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]       # overlaps the span before
        gap = F.substring(acc["text"], acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(acc["text"].alias("text"), F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark))).alias("out"))

    whole = F.coalesce(F.col("_doc.text"), F.lit(""))
    clean = F.aggregate(live, F.struct(whole.alias("text"), F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                        lambda a: F.concat(a["out"], F.substring(a["text"], a["at"] + 1, F.char_length(a["text"]))))
    cleaned = found.join(judged(found, widespread), "_row", "left").withColumn(
        "_text", F.when(F.size(live) > 0, clean).otherwise(F.col("_doc.text")))
    columns = []
    for c in names:
        if c == "text":
            columns.append(F.col("_text").alias(c))
        elif c == "n_chars":
            changed = F.char_length("_text").cast(docs.schema[c].dataType)
            columns.append(F.when(F.size(live) > 0, changed).otherwise(F.col("_doc.n_chars")).alias(c))
        else:
            columns.append(F.col("_doc")[c].alias(c))
    return docs.where(~suspect).unionByName(cleaned.select(*columns))
