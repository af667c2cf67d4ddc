from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest

from basketry.llm import language_model as lm


def tokenised(text):
    return [*(text or "").encode().lower().split(), "</end>"]


class Plain:
    """The same model over dictionaries."""

    def __init__(self, texts):
        pairs = Counter()
        for text in texts:
            words = tokenised(text)
            pairs.update(zip(["<begin>", *words], words, strict=False))
        self.pairs = pairs
        self.count = Counter()
        self.kinds = Counter()
        self.followers = defaultdict(Counter)
        for (a, b), n in pairs.items():
            self.count[b] += n
            self.kinds[b] += 1
            self.followers[a][b] = n
        self.d2 = self.discounts(pairs.values())
        self.d1 = self.discounts(self.kinds.values())

    @staticmethod
    def discounts(values):
        n = Counter(values)
        n = [max(1, n[i]) for i in range(1, 5)]
        rate = n[0] / (n[0] + 2 * n[1])
        return [0.0] + [min(max(k - (k + 1) * rate * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    def word(self, b):
        total = sum(self.kinds.values())
        if not total:
            return 1.0
        rest = sum(self.d1[min(3, n)] for n in self.kinds.values()) / total
        left = max(0, self.kinds[b] - self.d1[min(3, self.kinds[b])])
        return left / total + rest / (len(self.kinds) + 1)

    def pair(self, a, b):
        after = self.followers.get(a)
        if not after:
            return self.word(b)
        total = sum(after.values())
        rest = sum(self.d2[min(3, n)] for n in after.values()) / total
        return max(0, after[b] - self.d2[min(3, after[b])]) / total + rest * self.word(b)

    def score(self, text):
        words = tokenised(text)
        return sum(math.log10(self.pair(a, b)) for a, b in zip(["<begin>", *words], words, strict=False))

    def base(self, text):
        total = sum(self.count.values())
        weight = total + 0.1 * (len(self.count) + 1)
        return sum(math.log10((self.count[w] + 0.1) / weight) for w in tokenised(text))


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def zipf(seed=0, count=150):
    rng = random.Random(seed)
    vocabulary = [corpus.sentence(rng, 1) for _ in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 80))) for _ in range(count)]
    return [(i, t if i % 9 else t.upper(), "en", "a", 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("chunk", [50, 1_500_000])
def test_against_dictionaries(spark, monkeypatch, chunk):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    data = zipf() + [(500 + i, "very often here " * 40, "en", "a", 0) for i in range(20)] + [(1000 + i, *r[1:]) for i, r in enumerate(corpus.rows())] + [(None, "w x y", None, None, 0)]
    data += [data[3]]
    got = lm.held_out_scores(corpus.clashing(corpus.table(spark, data))).collect()
    plain = Plain([r[1] for r in data if not held_out(r[0])])
    expected = sorted(
        (str(r[0]), held_out(r[0]), len(tokenised(r[1])), sum(plain.count[w] > 0 for w in tokenised(r[1])),
         round(plain.base(r[1]), 6), round(plain.score(r[1]), 6))
        for r in data
    )
    assert sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))
        for r in got
    ) == expected
    assert {r["train_tokens"] for r in got} == {sum(plain.count.values())}


def test_better_than_the_base_on_unseen_text(spark):
    rng = random.Random(6)
    words = [corpus.sentence(rng, 1) for _ in range(40)]
    after = {w: rng.choices(words, k=4) for w in words}

    def text():
        out = [rng.choice(words)]
        while len(out) < 30:
            out.append(rng.choice(after[out[-1]]))
        return " ".join(out)

    data = [(i, text(), "en", "a", 0) for i in range(400)]
    rows = [r for r in lm.held_out_scores(corpus.table(spark, data)).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_add_up(spark, tmp_path):
    """Over all words, the end and one unknown word, after any context."""
    data = zipf(1)
    model = lm.train(corpus.table(spark, data))
    words = {w for r in data for w in tokenised(r[1])[:-1]}
    hashes = np.array([*(lm.xxhash.xxh64_intdigest(w) for w in words), lm.END, 12345], np.uint64)
    assert model.vocabulary == len(hashes) - 1
    reader = lm.Reader(model, str(tmp_path))
    for context in (hashes[0], hashes[7], lm.BEGIN, np.uint64(999)):
        chance, _ = reader.probabilities(hashes, np.full(len(hashes), context))
        assert chance.sum() == pytest.approx(1)


def test_no_text(spark):
    assert lm.held_out_scores(corpus.empty(spark)).collect() == []
    nothing = lm.train(corpus.empty(spark))
    got = lm.scored(corpus.table(spark, [(1, "a b", None, None, 0), (2, None, None, None, 0)]), nothing).collect()
    assert [(r["n_tokens"], r["n_known"], r["score"]) for r in sorted(got)] == [(3, 0, 0.0), (1, 0, 0.0)]
