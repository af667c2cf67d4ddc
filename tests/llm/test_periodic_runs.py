from __future__ import annotations

import hashlib
import random
import zlib

import corpus
import numpy as np
import pytest

from basketry.llm import periodic_runs as p


def words_of(text):
    out, word = [], ""
    for char in text or "":
        if char in " \t\n\v\f\r":
            out, word = (out + [word], "") if word else (out, "")
        else:
            word += char
    return out + [word] if word else out


def runs_of(words, least=p.MIN_LENGTH):
    """Every stretch of every period; of equal ends the least period counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, q, e) for (s, e), q in found.items())


def periodic(rng, kinds, size):
    words = [rng.randrange(kinds) for _ in range(size)]
    for _ in range(rng.randrange(3)):
        if words:
            a, q = rng.randrange(size), rng.randint(1, 9)
            end = min(size, a + q * rng.randint(2, 5))
            words[a:end] = [words[min(a + (i - a) % q, size - 1)] for i in range(a, end)]
    return words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_against_all_periods(least):
    rng = random.Random(least)
    for _ in range(200):
        docs = [periodic(rng, rng.choice([1, 2, 3, 7]), rng.choice([0, 1, 6, 14, 40, 90])) for _ in range(rng.randint(0, 6))]
        lengths = np.array([len(d) for d in docs], np.int64)
        begin, end, period = p.find_runs(np.array([x for d in docs for x in d], np.int64), lengths, least)
        want, offset = [], 0
        for doc in docs:
            want += [(s + offset, q, e + offset) for s, q, e in runs_of(doc, least)]
            offset += len(doc)
        assert list(zip(begin.tolist(), period.tolist(), end.tolist(), strict=True)) == want


def test_fibonacci_word():
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    begin, end, period = p.find_runs(np.array(b), np.array([len(b)]), 2)
    assert list(zip(begin.tolist(), period.tolist(), end.tolist(), strict=True)) == runs_of(b, 2)


def documents():
    rng = random.Random(8)
    data = corpus.rows()
    for i in range(60):
        words = [f"w{x}" for x in periodic(rng, rng.choice([2, 30]), rng.choice([10, 60, 300]))]
        data.append((2000 + i, rng.choice([" ", "\n", " \t"]).join(words), "en", "a", 0))
    return data + [(3000, "same " * 5000, None, None, 0), (3001, "\x1fa\x85 b", None, None, 0)]


def digest(doc_id, text):
    words = words_of(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            q = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % q] for i in range(n)]
    runs = runs_of(words)
    dropped = {i for s, q, e in runs for i in range(s + q, e)}
    longest = min(((s - e, s, q) for s, q, e in runs), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (None,) * 4
    if longest:
        length, start, period = -longest[0], longest[1], longest[2]
        four = (start, length, period, 1000 * length // period)
    checksum = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *four, *checksum)


def test_texts_against_all_periods(spark):
    data = documents()
    df = corpus.clashing(corpus.table(spark, data))
    got = p.run_digest(p.periodic_runs(p.with_planted_runs(df)))
    assert corpus.collected(got) == sorted((digest(r[0], r[1]) for r in data), key=repr)
    assert any(digest(r[0], r[1])[1] > 1 for r in data)


def test_steps_do_not_matter(spark, monkeypatch):
    df = corpus.table(spark, documents())
    whole = corpus.collected(p.periodic_runs(df))
    rows = df.select("doc_id", "text").toArrow().to_batches()
    small = [p._step(part, p.MIN_LENGTH) for batch in rows for part in p.steps(batch, most=1)]
    found = [r for batch in small for r in batch.to_pylist()]
    assert sorted((r["doc_id"] or -1, len(r["runs"]), r["collapsed"]) for r in found) == sorted(
        (r[0] or -1, len(r[1]), r[2]) for r in whole
    )


def test_no_documents(spark):
    assert p.run_digest(p.periodic_runs(p.with_planted_runs(corpus.empty(spark)))).collect() == []
