"""Operator 5, quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a predicate over the whole text that is true for a document to be
rejected.  On a bounded sample, each rule's cost is the time of a pass with it less
that of a pass without rules, and one aggregate gives how often the rules reject
together.  The next rule is the one that rejects most of what the rules before it
leave, per cost; a document meets it only if none of those has rejected it (CASE
WHEN evaluates lazily).  The verdict is the same in any order.

``measure`` returns the contract's counts for all documents, so there the rules
on these counts compare finished numbers and only the rule beyond them is spared;
``keep``, the filter, evaluates nothing but the cascade.

Words are runs of characters other than space and U+0009 to U+000D.  Windows of
three words are compared by 64-bit hashes.  Null and empty texts have no words
and fail; texts of any length are read whole; a count exactly at a limit passes.
Repeated rows get the same verdict.  An empty table gives an empty result.
Columns other than doc_id and text are ignored by ``measure`` and kept by ``keep``.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import id_and_text, pinned

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000       # about so many rows are timed
MIN_WORDS = 50
MAX_REPEATED = 50        # per cent of the words
MAX_SYMBOLS = 10         # per cent of the words
MAX_DUP_LINES = 50       # per cent of the lines with a word
MEAN_WORD = (2, 15)      # code points
MAX_WORD = 1000          # code points of the longest word, as in blobs without spaces


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def n_words(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(_without(text, SPACES)).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(_without(text, SYMBOLS))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return _let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words: Column) -> Column:
    """Words within 3-word windows that occur twice or more.

    Windows are sorted by (hash, position); those equal to a neighbour are
    repeated.  Of their starts in order, each covers the words up to three
    after it that the one before does not.
    """
    def windows(h: Column) -> Column:
        n = F.size(h) - 2
        return F.transform(F.arrays_zip(F.slice(h, F.lit(1), n).alias("a"), F.slice(h, F.lit(2), n).alias("b"),
                                        F.slice(h, F.lit(3), n).alias("c")),
                           lambda z: F.xxhash64(z["a"], z["b"], z["c"]))

    def covered(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 1)
        placed = F.sort_array(F.transform(F.arrays_zip(w.alias("h"), at.alias("i")),
                                          lambda z: F.struct(z["h"].alias("h"), z["i"].alias("i"))))

        def starts(s: Column) -> Column:
            n, none = F.size(s) - 1, F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
            near = F.arrays_zip(s.alias("own"), F.concat(none, F.slice(s, F.lit(1), n)).alias("before"),
                                F.concat(F.slice(s, F.lit(2), n), none).alias("after"))
            same = F.filter(near, lambda z: F.coalesce(z["own"]["h"] == z["before"]["h"], F.lit(False))
                            | F.coalesce(z["own"]["h"] == z["after"]["h"], F.lit(False)))
            return F.sort_array(F.transform(same, lambda z: z["own"]["i"]))

        return F.aggregate(
            _let(placed, starts), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
            lambda a: a["n"])

    def counted(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))

    def long_enough(h: Column) -> Column:
        return F.when(F.size(h) < 4, F.lit(0).cast("long")).otherwise(_let(windows(h), counted))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), long_enough)


@dataclass(frozen=True)
class Rule:
    """``rejects(text)`` is true for a document that has to go."""
    name: str
    rejects: object


def rules() -> list[Rule]:
    low, high = MEAN_WORD
    return [
        Rule("few_words", lambda t: n_words(t) < MIN_WORDS),
        Rule("repeated_words", lambda t: _let(words_of(t), lambda w: 100 * n_repeat_words(w) > MAX_REPEATED * F.size(w))),
        Rule("symbols", lambda t: 100 * n_symbols(t) > MAX_SYMBOLS * n_words(t)),
        Rule("repeated_lines", lambda t: _let(_lines(t), lambda x: 100 * (F.size(x) - F.size(F.array_distinct(x)))
                                              > MAX_DUP_LINES * F.size(x))),
        Rule("mean_word", lambda t: _let(F.struct(n_words(t).alias("n"), word_chars(t).alias("c")),
                                         lambda x: (x["c"] < low * x["n"]) | (x["c"] > high * x["n"]))),
        Rule("long_word", lambda t: t.rlike(r"[^\x20\x09-\x0D]{%d}" % (MAX_WORD + 1))),
    ]


def rejects(rule: Rule, text: Column) -> Column:
    return F.coalesce(rule.rejects(text), F.lit(True))


def cascade(costs: dict[str, float], together: list[tuple[frozenset, int]]) -> list[str]:
    """Rule names by rejections, among documents that no rule before rejects, per cost; the cheaper first where none rejects.

    ``together``: which rules reject, and how many documents they do so for.
    """
    order, left = [], list(together)
    while len(order) < len(costs):
        def gain(name: str) -> tuple:
            return -sum(n for by, n in left if name in by) / costs[name], costs[name], name

        best = min((name for name in costs if name not in order), key=gain)
        order.append(best)
        left = [(by, n) for by, n in left if best not in by]
    return order


def ordered_rules(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order of the cascade, from about ``sample_rows`` rows drawn by a hash of their position."""
    parts = max(1, docs.count() // sample_rows)
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)) == 0
    sample = pinned(id_and_text(docs).withColumn("drawn", drawn).where("drawn").select("text"))
    text, known = F.col("text"), {rule.name: rule for rule in rules()}

    def seconds(condition: Column) -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(condition)).collect()
        return time.perf_counter() - began

    seconds(F.lit(True))                              # warm
    idle = seconds(F.char_length(text) >= 0)
    costs = {name: max(seconds(rejects(rule, text)) - idle, 1e-3) for name, rule in known.items()}
    found = sample.groupBy(*[rejects(rule, text).alias(name) for name, rule in known.items()]).count().collect()
    together = [(frozenset(name for name in known if r[name]), r["count"]) for r in found]     # 2 ** rules at most
    return [known[name] for name in cascade(costs, together)]


def verdict(text: Column, order: list[Rule]) -> Column:
    """True if no rule rejects the text; later rules are not evaluated for a rejected one."""
    out = F.when(rejects(order[0], text), F.lit(False))
    for rule in order[1:]:
        out = out.when(rejects(rule, text), F.lit(False))
    return out.otherwise(F.lit(True))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects."""
    order = ordered_rules(docs)
    return docs.where(verdict(F.coalesce(F.col("text"), F.lit("")), order))


def measure(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every document."""
    order = ordered_rules(docs)
    text, words = F.col("text"), F.col("_words")
    counted = (id_and_text(docs)
               .withColumn("_words", words_of(text))
               .select("doc_id", "text", F.size(words).cast("long").alias("n_words"),
                       word_chars(text).alias("word_chars"), n_symbols(text).alias("n_symbols"),
                       n_dup_lines(text).alias("n_dup_lines"), n_repeat_words(words).alias("n_repeat_words"),
                       F.size(_lines(text)).cast("long").alias("n_lines")))
    n = F.col("n_words")
    # the counts that the rows carry anyway stand for the rules' own expressions
    known = {
        "few_words": n < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > MAX_REPEATED * n,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOLS * n,
        "repeated_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
        "mean_word": (F.col("word_chars") < MEAN_WORD[0] * n) | (F.col("word_chars") > MEAN_WORD[1] * n),
    }
    order = [Rule(r.name, (lambda _, c=known[r.name]: c) if r.name in known else r.rejects) for r in order]
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (known["few_words"] | known["repeated_words"]).alias("base_failed"), verdict(text, order).alias("kept"))
