from __future__ import annotations

import random

import corpus
import numpy as np

from basketry.llm import quality_classifier as q
from basketry.llm.common import one_text


def data(seed=0, count=600):
    rng = random.Random(seed)
    docs, junk = [], set()
    for i in range(count):
        words = corpus.sentence(rng, rng.randint(60, 200)).split()
        text = ". ".join(" ".join(words[k : k + 12]).capitalize() for k in range(0, len(words), 12))
        kind = rng.random()
        if kind < 0.07:
            text = " ".join(w + rng.choice(["***", "%%%", "&&&"]) for w in words)
        elif kind < 0.14:
            text = " ".join(w.upper() + "!!" for w in words)
        elif kind < 0.2:
            text = "\n".join([" ".join(words[:15])] * 20)
        if kind < 0.2:
            junk.add(i)
        docs.append((i, text, "en", "a", 0))
    return docs, junk


def test_finds_junk_without_labels(spark):
    docs, junk = data()
    got = q.quality_scores(corpus.clashing(corpus.table(spark, docs))).collect()
    assert np.mean([r["kept"] != (r["doc_id"] in junk) for r in got]) > 0.97
    assert all(r["kept"] for r in got if r["doc_id"] not in junk)


def test_odd_rows(spark):
    got = q.quality_scores(corpus.table(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in corpus.rows())
    assert all(0 <= r["score"] <= 1 and 0 <= r["posterior"] <= 1 for r in got)
    assert q.quality_scores(corpus.empty(spark)).collect() == []


def test_estimates_accuracies():
    """Heuristics that fail at random are told from one that always votes the same."""
    rng = np.random.default_rng(0)
    patterns = []
    for _ in range(4000):
        good = rng.random() < 0.8
        cast = [q.GOOD if (rng.random() < 0.95) == good else q.BAD for _ in range(5)]
        cast += [q.GOOD] + [q.ABSTAIN] * (q.LABELLERS - 6)
        patterns.append((good, sum(v * 3 ** (q.LABELLERS - 1 - j) for j, v in enumerate(cast))))
    kinds, counts = np.unique([p for _, p in patterns], return_counts=True)
    chances = q.estimate(kinds, counts.astype(float))
    assert np.mean([(chances[p] > 0.5) == good for good, p in patterns]) > 0.98


def test_sample_holds_a_row_per_id(spark):
    """Ids repeat with equal and with different texts, null ones among them."""
    rows = [(1, f"text {i % 7}") for i in range(500)] + [(2, None), (2, None), (3, "a"), (3, None), (4, "b")]
    found = [
        {r["doc_id"]: r["text"] for r in one_text(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()}
        for n in (1, 5)
    ]
    assert found[0] == found[1] and found[0].keys() == {1, 2, 3, 4}
    assert found[0][1].startswith("text") and found[0][2] is None and found[0][4] == "b"
