from __future__ import annotations

import hashlib
import random

import corpus
import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffix_dedup as s


def covered(bodies, length):
    """Per body which bytes lie in a string that starts earlier too."""
    seen, out = set(), []
    for body in bodies:
        marks = bytearray(len(body))
        for i in range(len(body) - length + 1):
            window = body[i : i + length]
            if window in seen:
                marks[i : i + length] = b"\1" * length
            seen.add(window)
        out.append(marks)
    return out


def digest(body, marks):
    kept = bytes(b for b, m in zip(body, marks, strict=True) if not m)
    spans = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
    return len(body), sum(marks), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("seed", range(30))
def test_transform_against_sorting(tmp_path, seed):
    """Order, symbols before and common prefixes are those of the sorted suffixes."""
    rng = random.Random(seed)
    strings = ["".join(rng.choices("abc"[: 2 + seed % 2], k=rng.randint(1, 25))).encode() for _ in range(rng.randint(1, 9))]
    data = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(x) for x in strings])
    files = s.ColumnFiles(str(tmp_path))
    s.transform(data, np.cumsum(sizes), sizes, files)
    suffixes = sorted((x[i:], j, i) for j, x in enumerate(strings) for i in range(len(x) + 1))
    string, size = s.owners(files.read("before"), len(strings))
    assert list(zip(string, size, strict=True)) == [(j, len(x)) for x, j, _ in suffixes]
    assert files.read("before").tolist() == [strings[j][i - 1] if i else s.START for _, j, i in suffixes]

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    assert files.read("common").tolist()[1:] == [
        common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:], strict=False)
    ]


def test_a_round_sorts_runs_not_places(tmp_path, monkeypatch):
    """Equal strings make runs in the columns, and only runs and new suffixes are sorted."""
    rng = random.Random(6)
    strings = [rng.randbytes(30).replace(b"\xff", b"a")] * 200
    data, sizes = np.frombuffer(b"".join(strings), np.uint8), np.full(200, 30)
    lengths, plain = [], np.argsort
    monkeypatch.setattr(s.np, "argsort", lambda a, **how: lengths.append(len(a)) or plain(a, **how))
    s.transform(data, np.cumsum(sizes), sizes, s.ColumnFiles(str(tmp_path)))
    columns = sum(200 * size for size in range(1, 31))
    assert sum(lengths) < columns / 4


def test_counting_minimizers_needs_no_content():
    rng = random.Random(7)
    texts = pa.array([rng.choice("abc") * rng.randint(0, 300) + corpus.sentence(rng, 40) for _ in range(20)])
    windows = s.Windows(20, 8)
    for full, bare in zip(windows.of_batch(texts), windows.of_batch(texts, hashed=False), strict=True):
        assert not bare[1].any() and full[1].any()
        assert all((a == b).all() for a, b in zip(full[:1] + full[2:], bare[:1] + bare[2:], strict=True))


def test_equal_windows_have_equal_keys():
    rng = random.Random(5)
    windows = s.Windows(20, 8)
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 300))) for _ in range(8)] + ["a" * 400, "ab" * 200]
    minimizers, keys, seen = {}, {}, set()
    for m, _, text, start, n, alone in windows.of_batch(pa.array(texts)):
        for a, t, b, k, one in zip(*(x.tolist() for x in (m, text, start, n, alone)), strict=True):
            body = texts[t][b : b + k + 19].encode()
            if one:
                assert len({body[i : i + 20] for i in range(k)}) == k
            signed = a - 2**64 if a >= 2**63 else a
            (places,) = windows.occurrences([body], [signed])
            parts = s.keyed_parts(body, k, places, 8, 20)
            assert sum(p[2] for p in parts) == k
            for key, first, count in parts:
                for i in range(first, first + count):
                    assert minimizers.setdefault(body[i : i + 20], a) == a
                    assert keys.setdefault(body[i : i + 20], key) == key
                    seen.add((t, b + i))
    assert len(seen) == sum(max(0, len(t) - 19) for t in texts)


def unique_rows():
    """The odd rows with an id each, in the order of the ids."""
    return [(i, *r[1:]) for i, r in enumerate(corpus.rows(count=90))]


@pytest.mark.parametrize("length, gram", [(100, 40), (30, 12)])
def test_against_brute_force(spark, length, gram):
    data = unique_rows()
    got = s.cut_digest(corpus.table(spark, data), length, gram).collect()
    bodies = [(r[1] or "").encode() for r in data]
    expected = [(r[0], *digest(b, m)) for r, b, m in zip(data, bodies, covered(bodies, length), strict=True)]
    assert sorted(tuple(r) for r in got) == expected


@pytest.mark.parametrize("limits", [{"CROWD": 3}, {"COLLECTION": 500}, {"STRETCH": 1000, "MOST_WINDOWS": 7}])
def test_limits_do_not_change_results(spark, monkeypatch, limits):
    """Also inside the workers, which get the function with its module's values."""
    data = unique_rows()
    plain = corpus.collected(s.cut_digest(corpus.table(spark, data), 30, 12))
    for name, value in limits.items():
        monkeypatch.setattr(s, name, value)
    assert corpus.collected(s.cut_digest(corpus.table(spark, data), 30, 12)) == plain


def test_periodic_and_odd_rows(spark):
    rng = random.Random(8)
    texts = ["a" * 1000, "ab" * 300, "a" * 150, "abc" * 90 + "x" + "abc" * 90, corpus.sentence(rng, 5), None, ""]
    texts += [corpus.sentence(rng, 60)] * 3
    texts += [texts[-1][:150] + "changed" + texts[-1][150:], "é" * 200]
    data = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    got = s.cut_digest(corpus.table(spark, data)).collect()
    bodies = [(t or "").encode() for t in texts]
    expected = [(i, *digest(b, m)) for i, (b, m) in enumerate(zip(bodies, covered(bodies, 100), strict=True))]
    assert sorted(tuple(r) for r in got) == expected
    assert s.cut_digest(corpus.empty(spark)).collect() == []


def test_repeated_ids(spark):
    """Rows equal in id and text are one document; null ids come first."""
    rng = random.Random(9)
    long, other = corpus.sentence(rng, 50), corpus.sentence(rng, 50)
    data = [(1, long, None, None, 0), (1, long, None, None, 0), (None, other, None, None, 0), (0, other, None, None, 0)]
    got = {(r["doc_id"], r["n_removed"]) for r in s.cut_digest(corpus.table(spark, data)).collect()}
    assert got == {(1, 0), (None, 0), (0, len(other))}


def test_documents_without_repeats(spark):
    rng = random.Random(10)
    passage = corpus.sentence(rng, 40)
    data = [(i, f"{corpus.sentence(rng, 5)} ñé {passage} {corpus.sentence(rng, 5)}", "en", "a", 0) for i in range(4)]
    data += [(9, None, "en", "a", None), (10, "", "en", "a", 0)]
    docs = corpus.clashing(corpus.table(spark, data))
    got = s.without_repeats(docs)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r for r in got.collect()}
    assert passage in rows[0]["text"] and passage not in rows[3]["text"]
    assert rows[9]["text"] is None and rows[10]["text"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values() if r["text"] is not None)


def test_a_shared_passage_does_not_meet_in_one_task(spark, monkeypatch):
    """Equal windows of a crowd are not gathered for the transform, and all but the first go."""
    rng = random.Random(11)
    passage = corpus.sentence(rng, 30)
    data = [(i, f"{corpus.sentence(rng, 12)} {passage} {corpus.sentence(rng, 12)}", "en", "a", 0) for i in range(60)]
    plain = s._find_repeats

    def watched(length):
        run = plain(length)

        def checked(batches):
            batches, crowd = list(batches), {}
            for batch in batches:
                for key in batch.column("key").to_pylist():
                    crowd[key] = crowd.get(key, 0) + 1
            assert max(crowd.values(), default=0) <= 20
            yield from run(iter(batches))

        return checked

    monkeypatch.setattr(s, "CROWD", 20)
    monkeypatch.setattr(s, "_find_repeats", watched)
    got = s.cut_digest(corpus.table(spark, data)).collect()
    bodies = [r[1].encode() for r in data]
    expected = [(r[0], *digest(b, x)) for r, b, x in zip(data, bodies, covered(bodies, 100), strict=True)]
    assert sorted(tuple(r) for r in got) == expected
