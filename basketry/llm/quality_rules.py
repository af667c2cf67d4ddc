"""Quality rules with thresholds that each language and source sets for itself.

Each document gets four measures; quantile sketches of them are gathered per
(lang, source), merged to languages and to the whole, and give the fences a
document must keep within. A sketch counts the values of a measure by their leading
bits: small values are exact, any other is off by 1 in 2^13 at most, sketches merge by adding counts, and
the same rows give the same fences in any order. All of it is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import WORD, let, record, words
from basketry.session import written

SYMBOLS = "#*$%&|<>"
BLANKS = "\t\n\x0b\x0c\r "
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Leading bits of a value that a sketch keeps.
SKETCH_BITS = 14
# A (lang, source) with fewer passing documents uses its language's fences, a
# language with fewer those of all documents.
MIN_GROUP = 100
# A fence stands FENCE spreads beyond the outer quartile. The spread is the
# distance of the quartiles, but at least the measure's own step (all in
# thousandths): a group in which nearly every document has no symbol at all must
# not reject one for its first.
FENCE = 3
LEAST_SPREAD = {
    "symbols_per_word": 30,
    "dup_lines_per_line": 100,
    "repeats_per_word": 50,
    "chars_per_word": 500,
}
TWO_SIDED = ("chars_per_word",)


def _windows(found: Column) -> Column:
    """The hash of each run of three words. Windows are compared by these 64 bits."""
    return F.transform(
        F.slice(found, 1, F.greatest(F.size(found) - 2, F.lit(0))),
        lambda word, i: F.xxhash64(word, F.get(found, i + 1), F.get(found, i + 2)),
    )


def _covered(placed: Column) -> Column:
    """How many words lie in a window that has an equal neighbour in hash order."""

    def same(i: Column, x: Column) -> Column:
        return F.coalesce(F.get(placed, i)["h"] == x["h"], F.lit(False))

    equal = F.filter(placed, lambda x, i: same(i - 1, x) | same(i + 1, x))
    words_of = F.transform(equal, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
    return F.size(F.array_distinct(F.flatten(words_of)))


def _repeat_words(windows: Column) -> Column:
    """Only a text with a repeated window is worth sorting its windows."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(placed, _covered)
    ).otherwise(F.lit(0))


def measured(docs: DataFrame) -> DataFrame:
    """The rows as `doc`, with the counts of each text and the rates the fences are for.

    A null text counts as an empty one.
    """
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    of_words = let(
        words(text),
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_words"),
            let(_windows(found), _repeat_words).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        ),
    )
    counts = F.struct(
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        of_words.alias("of_words"),
        of_lines.alias("of_lines"),
    )
    # A row of its own: a later filter on the counts stays above it and does not count again.
    rows = (
        record(docs)
        .select("doc", F.inline(F.array(counts)))
        .select("doc", "word_chars", "n_symbols", "of_words.*", "of_lines.*")
    )

    def rate(part: str, whole: str) -> Column:
        return F.expr(f"{part} * 1000 div greatest({whole}, 1)")

    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    return rows.select(
        "*",
        rate("n_symbols", "n_words").alias("symbols_per_word"),
        rate("n_dup_lines", "n_lines").alias("dup_lines_per_line"),
        rate("n_repeat_words", "n_words").alias("repeats_per_word"),
        rate("word_chars", "n_words").alias("chars_per_word"),
        failed.alias("base_failed"),
    )


def _leading_bits(value: Column) -> Column:
    """The value with all but its first SKETCH_BITS binary digits zero."""
    return let(
        value,
        lambda v: let(
            F.greatest(F.length(F.bin(v)) - SKETCH_BITS, F.lit(0)),
            lambda rest: (F.call_function("shiftleft", F.call_function("shiftright", v, rest), rest)),
        ),
    )


def sketches(rows: DataFrame) -> DataFrame:
    """Per (lang, source) and measure how often each value occurs in what passed the base rules."""
    values = F.explode(
        F.array(*(F.struct(F.lit(m).alias("measure"), _leading_bits(F.col(m)).alias("value")) for m in LEAST_SPREAD))
    )
    return (
        rows.filter(~F.col("base_failed"))
        .select("lang", "source", values.alias("at"))
        .groupBy("lang", "source", "at.measure", "at.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _limits(sketch: DataFrame, level: str, by: list[str], least: int) -> DataFrame:
    """The fences of each merged group of at least so many documents; nulls for a smaller one."""
    merged = sketch.groupBy(*by, "measure", "value").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*by, "measure")
    placed = merged.select(
        *by, "measure", "value",
        F.sum("n").over(group.orderBy("value")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )
    quartiles = []
    for m in LEAST_SPREAD:
        for name, quarters in (("low", 1), ("high", 3)):
            reached = (F.col("measure") == m) & (F.col("upto") * 4 >= F.col("total") * quarters)
            quartiles.append(F.min(F.when(reached, F.col("value"))).alias(f"{m}_{name}"))
    found = placed.groupBy(*by).agg(F.max("total").alias("total"), *quartiles)
    out = []
    for m, spread in LEAST_SPREAD.items():
        low, high = F.col(f"{m}_low"), F.col(f"{m}_high")
        reach = F.greatest(high - low, F.lit(spread)) * FENCE
        enough = F.col("total") >= least
        out.append(F.when(enough, low - reach).alias(f"{level}_{m}_low"))
        out.append(F.when(enough, high + reach).alias(f"{level}_{m}_high"))
    return found.select(*by, *out)


def fences(rows: DataFrame) -> DataFrame:
    """Per (lang, source): `<measure>_low` and `<measure>_high`, over what passed the base rules.

    rows: lang, source, base_failed and the measures. Each group has a row, also
    one without passing documents; null languages and sources are groups too.
    """
    keys = ["lang", "source"]
    sketch = written(sketches(rows))
    every = _limits(sketch, "all", [], 1)
    # One row: a scalar subquery, not a join.
    joined = rows.select(*keys).distinct().withColumn("every", every.select(F.struct("*")).scalar())
    for level, by in (("group", keys), ("lang", ["lang"])):
        limits = _limits(sketch, level, by, MIN_GROUP).withColumnsRenamed({k: f"_{k}" for k in by})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by])
        joined = joined.join(limits, same, "left").drop(*(f"_{k}" for k in by))
    joined = joined.select("*", "every.*")
    return joined.select(
        *keys,
        *(
            F.coalesce(*(F.col(f"{level}_{m}_{end}") for level in ("group", "lang", "all"))).alias(
                f"{m}_{end}"
            )
            for m in LEAST_SPREAD
            for end in ("low", "high")
        ),
    )


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with `kept`: neither failed at the base rules nor beyond a fence."""
    limits = limits.withColumnsRenamed({"lang": "lang_", "source": "source_"})
    within = reduce(
        and_,
        [F.col(m) <= F.col(f"{m}_high") for m in LEAST_SPREAD]
        + [F.col(m) >= F.col(f"{m}_low") for m in TWO_SIDED],
    )
    return rows.join(
        limits,
        F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")),
    ).withColumn("kept", ~F.col("base_failed") & within)


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"lang": F.col("doc.lang"), "source": F.col("doc.source")})


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Per document its counts, `base_failed` and `kept`.

    Repeated rows are judged like any other; no documents give no rows.
    """
    rows = measured(docs.select("doc_id", "text", "lang", "source"))
    rows = written(_with_keys(rows).withColumn("doc_id", F.col("doc.doc_id")).drop("doc"))
    return judged(rows, written(fences(rows)))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that keep within the fences, with all their columns.

    The texts are measured twice, which costs less than a copy of them on disk.
    """
    rows = _with_keys(measured(docs))
    limits = written(fences(written(rows.drop("doc"))))
    return judged(rows, limits).filter("kept").select("doc.*")
