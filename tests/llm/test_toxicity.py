from __future__ import annotations

import random
import zlib

import corpus
import numpy as np
from pyspark.sql import functions as F

from basketry.llm import toxicity as t

INSULTS = ["grumblefoo", "snarkbar", "vilebaz"]


def data(seed=0, count=1500):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(count):
        words = corpus.sentence(rng, rng.randint(5, 60)).split()
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", ".", "x", "yz"]))
        docs.append((i, " ".join(words), "en", "a", 0))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    return docs, labels, {d[0] for d in docs if any(w in d[1] for w in INSULTS)}


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    docs, labels, toxic = data()
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    odd = [(-1, None, None, None, 0), (-2, "", None, None, 0), (None, "grumblefoo snarkbar", None, None, 0), docs[0]]
    got = t.toxicity(corpus.clashing(corpus.table(spark, docs + odd)), marks).collect()
    assert len(got) == len(docs) + len(odd)
    unseen = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] >= 0]
    assert {r["doc_id"] for r in unseen} == {d[0] for d in docs if held_out(d[0])}
    right = [r["predicted"] == (r["doc_id"] in toxic) for r in unseen]
    assert np.mean(right) > 0.97
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[-1] == scores[-2] < t.THRESHOLD < scores[None]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_an_id_is_learnt_from_once(spark):
    """Rows repeated under one id add nothing to the sample, whatever their number."""
    docs, labels, _ = data(seed=3, count=400)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    often = next(d for d in docs if not held_out(d[0]) and (d[0], 1) in labels)
    plain = {r["doc_id"]: r["score"] for r in t.toxicity(corpus.table(spark, docs), marks).collect()}
    rows = t.toxicity(corpus.table(spark, docs + [often] * 2000), marks).collect()
    assert len(rows) == len(docs) + 2000
    assert all(abs(r["score"] - plain[r["doc_id"]]) < 1e-6 for r in rows)


def test_held_out_labels_change_nothing(spark):
    docs, labels, _ = data(1, 400)
    turned = [(i, 1 - toxic if held_out(i) else toxic) for i, toxic in labels]
    table = corpus.table(spark, docs)
    first, second = (
        corpus.collected(t.toxicity(table, spark.createDataFrame(x, "doc_id long, toxic int"))) for x in (labels, turned)
    )
    assert first == second


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert t.toxicity(corpus.empty(spark), none).collect() == []
    got = t.toxicity(corpus.table(spark), none)
    assert got.select("score").distinct().count() == 1
    twice = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1)], "doc_id long, toxic int")
    assert t.toxicity(corpus.table(spark), twice).filter(F.col("score").isNull()).count() == 0


def test_risk_is_not_driven_below_zero():
    """Unlabelled text that holds the positives themselves does not teach that they are clean."""
    rng = np.random.default_rng(0)
    features = [np.unique(np.append(rng.integers(100, 400, 20), [7] if i < 60 else [])).astype(int) for i in range(600)]
    positives = [np.unique(np.append(rng.integers(100, 400, 20), 7)).astype(int) for _ in range(80)]
    weights, bias = t.fit(positives + features, np.r_[np.ones(80, bool), np.zeros(600, bool)], 0.1)
    assert 1 / (1 + np.exp(-(weights[7] + bias))) > 0.5 > 1 / (1 + np.exp(-bias))


def test_many_toxic_examples():
    """With 45 % toxic among the unlabelled, the words that tell still get weights."""
    rng = np.random.default_rng(1)

    def example(toxic):
        words = rng.integers(100, 400, 20)
        return np.unique(np.append(words, rng.choice([7, 8, 9], 2) if toxic else []).astype(int))

    truth = rng.random(2000) < 0.45
    unlabelled, positives = [example(x) for x in truth], [example(True) for _ in range(600)]
    weights, bias = t.fit(positives + unlabelled, np.r_[np.ones(600, bool), np.zeros(2000, bool)], 0.45)
    called = np.array([1 / (1 + np.exp(-(weights[f].sum() + bias))) >= t.THRESHOLD for f in unlabelled])
    assert (called == truth).mean() > 0.97
