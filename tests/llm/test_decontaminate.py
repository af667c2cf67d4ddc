from __future__ import annotations

import random

import corpus
import pytest

from basketry.llm import decontaminate as d


def distance(item, text):
    """Least edit distance of the item to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        place = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[place] = "z"
        elif kind == 1:
            chars.insert(place, "y")
        elif len(chars) > 1:
            del chars[place]
    return "".join(chars)


@pytest.mark.parametrize("seed", range(20))
def test_distance(seed):
    rng = random.Random(seed)
    item = "".join(rng.choices("abcd", k=rng.randint(1, 90)))
    text = "".join(rng.choices("abcd", k=rng.randint(0, 150)))
    if seed % 2:
        text = text[:40] + edited(rng, item, 5) + text[40:]
    assert d.Item(1, item, 12).distance(text) == distance(item, text)


def test_pieces_cover_the_item():
    for size in (1, 5, 11, 12, 95, 400):
        item = "".join(map(chr, range(200, 200 + size)))
        pieces = d.split(item, d.budget_of(item))
        assert "".join(p for _, p in pieces) == item
        assert len(pieces) == d.budget_of(item) + 1 and all(p for _, p in pieces)


@pytest.mark.parametrize("block_chars", [1 << 20, 200])
def test_against_brute_force(spark, block_chars):
    rng = random.Random(1)
    items = [(i, corpus.sentence(rng, 25)) for i in range(8)]
    items += [(20, "Tiny one"), (21, None), (22, " \n "), (None, corpus.sentence(rng, 12)), items[0]]
    items += [(30, items[1][1].upper())]
    docs = [(i, r[1], *r[2:]) for i, r in enumerate(corpus.rows(count=24))]
    for k in range(16):
        item = items[k % 8][1]
        body = edited(rng, item.replace(" ", "  ", 2), rng.choice([0, 1, 5, len(item) // 12, len(item) // 12 + 4]))
        docs.append((100 + k, f"{corpus.sentence(rng, 30)} {body}\n{corpus.sentence(rng, 30)}", "en", "a", 0))
    docs += [(200, items[2][1], "en", "a", 0), (201, "a TINY   one b", "en", "a", 0), (None, items[3][1], None, None, 0)]
    docs += [docs[-1], (202, items[-3][1] if items[-3][1] else "", "en", "a", 0)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = d.leaks(corpus.table(spark, docs), benchmark, block_chars=block_chars).collect()
    expected = []
    known = {(i, d.normal(t)) for i, t in items if t and d.normal(t)}
    for doc_id, text, *_ in docs:
        for item_id, item in known:
            body = d.normal(text or "")
            if len(body) < 20_000 and (best := distance(item, body)) <= d.budget_of(item):
                expected.append((doc_id, item_id, best, d.budget_of(item)))
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected, key=repr)
    assert len(expected) > 15


def test_clean_documents_stay(spark):
    rng = random.Random(2)
    item = corpus.sentence(rng, 25)
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    data = corpus.rows(count=12)
    dirty = (500, f"before {item} after", "en", "a", 0)
    docs = corpus.clashing(corpus.table(spark, [*data, dirty]))
    got = d.clean(docs, benchmark)
    assert got.columns == docs.columns
    assert corpus.collected(got.select(corpus.SCHEMA.fieldNames())) == sorted(data, key=repr)
    assert d.clean(corpus.empty(spark), benchmark).collect() == []
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert d.clean(docs, nothing).count() == docs.count()
    assert d.leaks(docs, nothing).collect() == []
