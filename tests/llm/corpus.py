"""Small document tables with the odd cases, for the tests of all operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Columns named as the operators name their own.
CLASHES = ["words", "size", "key", "row", "fp", "block", "found", "windows", "version", "kept", "doc", "n", "m"]


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(words))


def rows(seed: int = 0, count: int = 60) -> list[tuple]:
    """Prose of all lengths with copies, near copies, shared passages, empty, null and long texts."""
    rng = random.Random(seed)
    shared = sentence(rng, 30)
    texts: list[str | None] = []
    for i in range(count):
        kind = i % 6
        text = sentence(rng, rng.choice([3, 40, 120, 300]))
        if kind == 1 and texts:
            text = texts[rng.randrange(len(texts))] or text
        elif kind == 2 and texts:
            words = (texts[rng.randrange(len(texts))] or text).split()
            if words:
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 3:
            text = f"{text}\n{shared}\n{sentence(rng, 20)}"
        texts.append(text)
    texts += [None, "", " \t\n", "é" * 300, "a" * 700, "ab" * 400, "x", "Ä ñ 日本 word", sentence(rng, 9000)]
    out = [
        (i, t, ["en", "de", None][i % 3], ["a", "b", None, "Z"][i % 4], len(t or ""))
        for i, t in enumerate(texts)
    ]
    out += [out[0], out[0], (None, texts[1], "en", "a", 5), (None, None, None, None, None)]
    # One id with different texts.
    return out + [(7, "another text " * 20, "en", "b", 260)]


def table(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clashing(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHES})


def collected(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
