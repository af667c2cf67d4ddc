"""Toxicity from confirmed toxic examples and unlabelled text only.

Non-negative positive-unlabelled learning: with the share p of toxic texts known, the risk
on unlabelled text stands in for the risk on clean text once p times the risk of the positives
being called clean is taken off it; where that difference falls below zero
it is over-fitted, and the step goes the other way. The classifier is linear over hashed words and
beginnings of words.
Several are trained, each in a task on unlabelled text of its own, and averaged.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import one_text, steps, texts, word_lists
from basketry.session import written

BITS = 18
PUNCTUATION = ".,;:!?\"'()[]#*$%&|<>"
BEGINNINGS = (4, 5, 6)
MEMBERS = 3
# Examples at most, the ones with the least hash of their id: toxic ones for all
# classifiers alike, unlabelled ones for each.
MAX_TOXIC = 4_000
MAX_UNLABELLED = 8_000
# What makes a feature worth a weight.
SIGMAS, LIFT = 4, 2.5
ROUNDS = 300
RATE = 0.1
DECAY = 2e-3
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _hashed(words: pa.Array) -> np.ndarray:
    """Per word its features: the word without punctuation around it, and its beginnings."""
    bare = pc.utf8_trim(words, characters=PUNCTUATION)
    forms = [bare, *(pc.utf8_slice_codeunits(bare, 0, n) for n in BEGINNINGS)]
    columns = []
    for number, form in enumerate(forms):
        digests = [zlib.crc32(w, number) & (1 << BITS) - 1 for w in form.cast(pa.binary()).to_pylist()]
        columns.append(np.array(digests, np.int64))
    return np.stack(columns, axis=1)


def _pairs(column: pa.Array, weights: np.ndarray | None = None) -> np.ndarray:
    """(row << BITS | feature) of every distinct feature of every text, sorted.

    With weights only the features that weigh anything.
    """
    found, rows = word_lists(texts(column))
    coded = found.dictionary_encode()
    code, ids = coded.indices.to_numpy(), _hashed(coded.dictionary)
    if weights is not None:
        heavy = (weights[ids] != 0).any(axis=1)[code]
        code, rows = code[heavy], rows[heavy]
    pairs = np.unique((rows[:, None] << BITS) | ids[code])
    return pairs


def _features() -> Callable:
    """Each text's distinct features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                pairs = _pairs(part.column("text"))
                bounds = np.searchsorted(pairs >> BITS, np.arange(part.num_rows + 1))
                values = pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column("member"), part.column("toxic"), lists],
                    names=["member", "toxic", "features"],
                )

    return run


def _telling(counts: np.ndarray, others: np.ndarray, n: int, m: int, prior: float) -> np.ndarray:
    """Features that far more of the n positives hold than chance gives, and by LIFT more than clean text.

    The unlabelled examples hold toxic ones too: what these add to the rate is taken off it.
    """
    expected = others * (n / m)
    clean = np.maximum(expected - prior * counts, 0) / (1 - prior)
    return np.flatnonzero(
        (counts - expected > SIGMAS * np.sqrt(expected + 1)) & (counts > LIFT * clean)
    )


def fit(features: list[np.ndarray], toxic: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights over all 2 ** BITS features and the bias, by the non-negative risk estimator."""
    weights, bias = np.zeros(1 << BITS), float(np.log(prior / (1 - prior)))
    n, m = int(toxic.sum()), int((~toxic).sum())
    if not n or not m:
        return weights, bias
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    flat = np.concatenate(features).astype(np.int64)
    size = 1 << BITS
    used = _telling(
        np.bincount(flat[toxic[rows]], minlength=size), np.bincount(flat[~toxic[rows]], minlength=size), n, m, prior
    )
    column = np.full(size, -1)
    column[used] = np.arange(len(used))
    known = column[flat] >= 0
    rows, flat = rows[known], column[flat[known]]
    value = np.append(np.zeros(len(used)), bias)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    # The weight of an example in the risk that it is called toxic.
    share = np.where(toxic, -prior / n, 1 / m)
    for turn in range(1, ROUNDS + 1):
        score = np.bincount(rows, weights=value[flat], minlength=len(features)) + value[-1]
        chance = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        clean_risk = (np.logaddexp(0, score) * share).sum()
        slope = chance * share
        if clean_risk < 0:
            slope = -slope
        else:
            slope = slope + np.where(toxic, (chance - 1) * prior / n, 0)
        grad = np.append(np.bincount(flat, weights=slope[rows], minlength=len(used)), slope.sum())
        grad[:-1] += DECAY * value[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        step = mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        value -= RATE * (1 - turn / (ROUNDS + 1)) * step
    weights[used] = value[:-1]
    return weights, float(value[-1])


def _train(prior: float) -> Callable:
    def run(examples: pd.DataFrame) -> pd.DataFrame:
        features = [np.asarray(f, np.int64) for f in examples["features"]]
        weights, bias = fit(features, examples["toxic"].to_numpy(bool), prior)
        at = np.flatnonzero(weights)
        return pd.DataFrame(
            {"feature": np.append(at, -1), "weight": np.append(weights[at], bias)}
        )

    return run


def train(docs: DataFrame, toxic_ids: DataFrame, prior: float) -> tuple[np.ndarray, float]:
    """The averaged classifier.

    docs: doc_id, text of the rows that may be learnt from; toxic_ids: doc_id of the confirmed
    ones among them. The unlabelled rows are drawn from all. The samples are bounded by
    MAX_TOXIC and MEMBERS * MAX_UNLABELLED rows, as an id is learnt from once, by the row with
    the least hash of its text; the model has a fixed size. Rows without an id are not learnt from.
    """
    order = F.xxhash64("doc_id")
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    positive = ids.join(toxic_ids.distinct(), "doc_id", "left_semi")
    every = F.sequence(F.lit(0), F.lit(MEMBERS - 1))
    positive = positive.orderBy(order, "doc_id").limit(MAX_TOXIC).select(
        "doc_id", F.lit(True).alias("toxic"), F.explode(every).alias("member")
    )
    others = ids.orderBy(order, "doc_id").limit(MEMBERS * MAX_UNLABELLED).select(
        "doc_id", F.lit(False).alias("toxic"), F.pmod(F.hash("doc_id"), F.lit(MEMBERS)).alias("member")
    )
    sample = written(positive.unionByName(others))
    known = one_text(docs.join(sample, "doc_id", "left_semi"))
    examples = known.join(sample, "doc_id").select("member", "toxic", "text")
    examples = examples.mapInArrow(_features(), "member int, toxic boolean, features array<int>")
    models = examples.groupBy("member").applyInPandas(_train(prior), "feature long, weight double")
    rows = written(models.groupBy("feature").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")))
    weights, bias = np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior)))
    # At most one row per feature, so bounded by 2 ** BITS.
    members = rows.filter("feature < 0").first()
    for row in rows.filter("feature >= 0").collect():
        weights[row["feature"]] = row["weight"] / members["n"]
    if members is not None:
        bias = members["weight"] / members["n"]
    return weights, bias


def _score(weights: np.ndarray, bias: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                pairs = _pairs(part.column("text"), weights)
                total = np.bincount(
                    pairs >> BITS,
                    weights=weights[pairs & ((1 << BITS) - 1)],
                    minlength=part.num_rows,
                )
                scores = 1 / (1 + np.exp(-np.clip(total + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
                )

    return run


def scored(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score of every row; null and empty texts score by the bias alone."""
    return docs.select("doc_id", "text").mapInArrow(_score(weights, bias), "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Learns from the rows outside the held-out fold; of their labels only the toxic ones and
    the share of these among all. Several labels of one id count as toxic if one is.
    Without a toxic label every row gets the prior of one half label.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    known = labels.filter(~held_out & F.col("toxic").isNotNull()).groupBy("doc_id")
    known = known.agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum(F.col("toxic"))).first()
    prior = ((toxic or 0) + 0.5) / (n + 1)
    toxic_ids = known.filter("toxic = 1").select("doc_id")
    weights, bias = train(docs.filter(~held_out), toxic_ids, prior)
    return scored(docs, weights, bias).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
