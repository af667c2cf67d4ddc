from __future__ import annotations

import re
from collections import Counter

import corpus
import pytest
from pyspark.sql import functions as F

from basketry.llm import quality_rules as q

NAMES = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


TEXTS = [
    "a b c a b c", "a a a a a", "x y\nx y\n \nx y", "# one *two* $ % & | < >", "é 日本 \x0b\x0c z", "a b", "",
    None, " lead and trail ", "p q r s p q r t q r s", "line\r\nline\r\nline", "very " * 20_000,
]


def test_counts(spark):
    docs = corpus.table(spark, [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: r for r in q.quality_verdicts(docs).collect()}
    for i, text in enumerate(TEXTS):
        assert (got[i]["n_words"], *(got[i][n] for n in NAMES)) == expected(text), text


def test_odd_rows(spark):
    docs = corpus.table(spark)
    got = q.quality_verdicts(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in got) == sorted(
        (str(r[0]), expected(r[1])[0]) for r in corpus.rows()
    )
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert corpus.collected(q.quality_verdicts(corpus.empty(spark))) == []
    kept = corpus.collected(q.quality_filter(docs))
    wide = q.quality_filter(corpus.clashing(docs))
    assert wide.columns == corpus.clashing(docs).columns
    assert corpus.collected(wide.select(docs.columns)) == kept
    assert 0 < len(kept) < docs.count()


def test_fences_follow_their_group(spark):
    """A measure that is usual in one source is an outlier in another."""
    tables = " | ".join(["cell"] * 80)
    prose = "plain words of prose " * 20
    docs = [(i, f"{prose} {i} {i * 7} one", "en", "news", 0) for i in range(150)]
    docs += [(i, f"{' '.join(f'w{i + k} |' for k in range(80))}", "en", "tables", 0) for i in range(200, 350)]
    docs += [(900, " ".join(f"v{k} |" for k in range(80)), "en", "news", 0), (901, tables, "en", "news", 0)]
    distinct = [(d, " ".join(f"{w}{j}{d}" for j, w in enumerate(t.split())) if s == "news" and d < 900 else t, la, s, n) for d, t, la, s, n in docs]
    got = {r["doc_id"]: r["kept"] for r in q.quality_verdicts(corpus.table(spark, distinct)).collect()}
    assert all(got[i] for i in range(200, 350))
    assert all(got[i] for i in range(150))
    assert not got[900]


@pytest.mark.parametrize("size", [1, 5])
def test_small_groups_use_larger_ones(spark, size):
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", "big", 0) for i in range(120)]
    docs += [(1000 + i, " ".join(f"u{i}x{k} #" for k in range(60)), "en", "few", 0) for i in range(size)]
    got = {r["doc_id"]: r["kept"] for r in q.quality_verdicts(corpus.table(spark, docs)).collect()}
    assert not any(got[1000 + i] for i in range(size))
    assert all(got[i] for i in range(120))


def test_large_groups_are_judged_alike_again(spark):
    """Beyond any small sketch: the quartiles are those of the sorted values, whatever the partitions."""
    import random

    rng = random.Random(6)
    values = [rng.choice([rng.randrange(5000), rng.randrange(1 << 14)]) for _ in range(9000)]
    rows = [("en", "s", i % 10 == 0, v, v // 7, v % 90, v + 3) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, ["lang", "source", "base_failed", *q.LEAST_SPREAD])
    first = q.fences(df.repartition(3)).collect()
    assert first == q.fences(df.repartition(7)).collect()
    for at, (name, spread) in enumerate(q.LEAST_SPREAD.items(), 3):
        passed = sorted(r[at] for r in rows if not r[2])
        low, high = (passed[-(-len(passed) * share // 4) - 1] for share in (1, 3))
        reach = 3 * max(high - low, spread)
        assert (first[0][f"{name}_low"], first[0][f"{name}_high"]) == (low - reach, high + reach)


def test_large_values_keep_their_leading_bits(spark):
    numbers = [0, 1, 16383, 16384, 16385, 16387, 123_456_789, (1 << 50) + 12345]
    df = spark.createDataFrame([(n,) for n in numbers], "v long").select("v", q._leading_bits(F.col("v")).alias("b"))
    for r in df.collect():
        drop = max(r["v"].bit_length() - q.SKETCH_BITS, 0)
        assert r["b"] == r["v"] >> drop << drop
