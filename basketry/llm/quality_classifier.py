"""A quality score learnt without labels, from heuristics that vote on each document.

Each heuristic votes good, bad or abstains. Expectation-maximisation over the counts of
vote patterns estimates how the votes of each go with a hidden label and gives every
pattern the chance of being good. A linear scorer over hashed features of the
text then learns these chances on a bounded sample and scores all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import one_text, steps, texts
from basketry.session import written

GOOD, BAD, ABSTAIN = 2, 1, 0
# Name, good below, bad above; between the two a heuristic abstains.
UPPER_LIMITS = [
    ("symbols_per_word", 0.02, 0.1),
    ("symbol_ended_share", 0.02, 0.1),
    ("capital_share", 0.1, 0.3),
    ("capital_word_share", 0.1, 0.3),
    ("exclaims_per_word", 0.05, 0.3),
    ("dup_line_share", 0.1, 0.4),
    ("same_as_last_share", 0.02, 0.1),
]
# Name, bad below, good above.
LOWER_LIMITS = [
    ("letter_share", 0.7, 0.9),
    ("distinct_share", 0.3, 0.45),
    ("words", 1, 50),
]
LABELLERS = len(UPPER_LIMITS) + len(LOWER_LIMITS)
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OTHERS = bytes(c for c in range(128) if not chr(c).isalpha())
# Distinct words of so many words at most are counted for the distinct share, as the
# share falls with the length of any text.
DISTINCT_OF = 200
ROUNDS = 60
GOOD_WEIGHT = 0.7
BITS = 16
MAX_SAMPLE = 8_000
FIT_ROUNDS = 150
RATE = 0.2
GAIN = 50.0
KEEP = 0.5


def measures(body: bytes) -> dict[str, float]:
    """What the heuristics look at; shares of an empty text are zero."""
    words = body.split()
    lines = [line for line in body.split(b"\n") if line.strip()]
    n, n_lines = max(1, len(words)), max(1, len(lines))
    symbols = len(body) - len(body.translate(None, SYMBOLS))
    capitals = len(body) - len(body.translate(None, CAPITALS))
    chars = sum(map(len, words))
    letters = len(body.translate(None, OTHERS))
    runs = [words[i : i + DISTINCT_OF] for i in range(0, len(words), DISTINCT_OF)]
    return {
        "symbols_per_word": symbols / n,
        "symbol_ended_share": sum(word[-1] in SYMBOLS for word in words) / n,
        "capital_share": capitals / max(1, chars),
        "capital_word_share": sum(map(bytes.isupper, words)) / n,
        "dup_line_share": 1 - len(set(lines)) / n_lines if lines else 0.0,
        "same_as_last_share": sum(map(bytes.__eq__, words, words[1:])) / n,
        "exclaims_per_word": body.count(b"!") / n,
        "distinct_share": sum(len(set(run)) for run in runs) / n,
        "letter_share": letters / max(1, chars),
        "words": float(len(words)),
    }


def votes(values: dict[str, float]) -> int:
    """All votes as one number in base 3."""
    pattern = 0
    for name, good, bad in UPPER_LIMITS:
        vote = GOOD if values[name] < good else BAD if values[name] > bad else ABSTAIN
        pattern = pattern * 3 + vote
    for name, bad, good in LOWER_LIMITS:
        vote = BAD if values[name] < bad else GOOD if values[name] > good else ABSTAIN
        pattern = pattern * 3 + vote
    return pattern


def estimate(patterns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The chance of being good for every pattern, by expectation-maximisation.

    Junk is mostly of one kind, which few heuristics see, and the others' votes for good go
    together: they count by GOOD_WEIGHT. Starts from the number of votes for bad, two
    of which make a document junk.
    """
    chances = np.full(3**LABELLERS, 0.5)
    if not len(patterns):
        return chances
    every = np.arange(3**LABELLERS)
    vote = np.stack([every // 3 ** (LABELLERS - 1 - j) % 3 for j in range(LABELLERS)], axis=1)
    chances = 1 / (1 + np.exp(4.0 * (vote == BAD).sum(axis=1) - 6.0))
    weight = counts / counts.sum()
    for _ in range(ROUNDS):
        good = chances[patterns] * weight
        bad = (1 - chances[patterns]) * weight
        total = np.full(len(every), np.log((good.sum() + 1e-6) / (bad.sum() + 1e-6)))
        for j in range(LABELLERS):
            of_good = np.bincount(vote[patterns, j], weights=good, minlength=3) + 1e-4
            of_bad = np.bincount(vote[patterns, j], weights=bad, minlength=3) + 1e-4
            ratio = np.log(of_good / of_good.sum()) - np.log(of_bad / of_bad.sum())
            # A heuristic may be of no use, but its votes do not mean the opposite.
            ratio[ABSTAIN] = 0
            ratio[BAD], ratio[GOOD] = min(ratio[BAD], 0), GOOD_WEIGHT * max(ratio[GOOD], 0)
            total += ratio[vote[:, j]]
        chances = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
    return chances


def _levels(values: dict[str, float]) -> list[int]:
    """The measures in steps, as hashed features."""
    names = [f"{k}={min(20, int(v * 20)) if k != 'words' else int(np.log2(v + 1))}" for k, v in values.items()]
    return [zlib.crc32(name.encode()) & (1 << BITS) - 1 for name in names]


def _trigrams(body: bytes) -> np.ndarray:
    """Hashes of all runs of three bytes."""
    data = np.frombuffer(body, np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.empty(0, np.uint32)
    mixed = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77)) ^ (
        data[2:] * np.uint32(0xC2B2AE3D)
    )
    return mixed >> np.uint32(32 - BITS)


def _bodies(part: pa.RecordBatch) -> list[bytes]:
    return texts(part.column("text")).cast(pa.binary()).to_pylist()


def _vote() -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                patterns = [votes(measures(body)) for body in _bodies(part)]
                yield pa.RecordBatch.from_arrays([pa.array(patterns, pa.int32())], names=["pattern"])

    return run


def _examples(chances: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                rows = []
                for body in _bodies(part):
                    values = measures(body)
                    ids, counts = np.unique(_trigrams(body), return_counts=True)
                    shares = counts / max(1, counts.sum())
                    levels = _levels(values)
                    rows.append(
                        {
                            "chance": float(chances[votes(values)]),
                            "features": np.append(ids, levels).astype(np.int32),
                            "shares": np.append(shares * GAIN, np.ones(len(levels))).astype(np.float32),
                        }
                    )
                kind = pa.struct(
                    [
                        ("chance", pa.float64()),
                        ("features", pa.list_(pa.int32())),
                        ("shares", pa.list_(pa.float32())),
                    ]
                )
                yield pa.RecordBatch.from_struct_array(pa.array(rows, kind))

    return run


def _fit(examples: pd.DataFrame) -> pd.DataFrame:
    """Logistic regression on the chances."""
    lengths = examples["features"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(examples)), lengths)
    ids = np.concatenate(examples["features"].to_list()).astype(np.int64)
    shares = np.concatenate(examples["shares"].to_list()).astype(float)
    chance = examples["chance"].to_numpy()
    size = 1 << BITS
    value, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for turn in range(1, FIT_ROUNDS + 1):
        score = np.bincount(rows, weights=value[ids] * shares, minlength=len(chance)) + value[-1]
        slope = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - chance) / len(chance)
        grad = np.append(np.bincount(ids, weights=slope[rows] * shares, minlength=size), slope.sum())
        grad[:-1] += 1e-4 * value[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        step = mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)
        value -= RATE * (1 - turn / (FIT_ROUNDS + 1)) * step
    at = np.flatnonzero(value)
    return pd.DataFrame({"feature": at, "weight": value[at]})


def _score(chances: np.ndarray, weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                posterior, scores = [], []
                for body in _bodies(part):
                    values = measures(body)
                    grams = _trigrams(body)
                    total = weights[-1] + weights[_levels(values)].sum()
                    if len(grams):
                        total += GAIN * weights[grams].mean()
                    posterior.append(float(chances[votes(values)]))
                    scores.append(float(1 / (1 + np.exp(-np.clip(total, -30, 30)))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(posterior), pa.array(scores)],
                    names=["doc_id", "posterior", "score"],
                )

    return run


def quality_scores(docs: DataFrame) -> DataFrame:
    """doc_id, posterior (of the label model), score (of the linear scorer), kept of every row.

    Null texts are empty ones: no words, so voted bad on length. The patterns number
    3 ** LABELLERS at most; the scorer learns from the MAX_SAMPLE ids with the least
    hash, of each from one row, that with the least hash of its text, and has a fixed size. Rows
    without an id are not learnt from, but vote and are scored. Without documents there is no model and no row.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = docs.select("text").mapInArrow(_vote(), "pattern int").groupBy("pattern").count().collect()
    chances = estimate(
        np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted], float)
    )
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    sample = written(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_SAMPLE))
    examples = one_text(docs.join(sample, "doc_id", "left_semi")).select("text")
    examples = examples.mapInArrow(
        _examples(chances), "chance double, features array<int>, shares array<float>"
    )
    model = written(examples.withColumn("model", F.lit(0)).groupBy("model").applyInPandas(_fit, "feature long, weight double"))
    weights = np.zeros((1 << BITS) + 1, np.float32)
    for row in model.collect():
        weights[row["feature"]] = row["weight"]
    scored = docs.mapInArrow(
        _score(chances, weights), "doc_id long, posterior double, score double"
    )
    return scored.withColumn("kept", F.col("score") >= KEEP)
