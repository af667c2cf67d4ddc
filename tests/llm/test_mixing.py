from __future__ import annotations

import corpus
import pytest

from basketry.llm import mixing as m


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Sharing by weight, holding sources at their limit until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        whole = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not above:
            return out | {s: left * weight[s] / whole for s in open_}
        for s in above:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in above)
        open_ -= above
    return out


def check(got, data):
    sizes = {}
    for _, text, _, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    aims = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        source = r["source"]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(aims[source], abs=1e-6)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert abs(words - aims[source]) <= 0.5 + 1e-6


def result(df):
    return m.with_taken(df).select("doc.doc_id", "doc.source", "size", "source_size", "target", "taken", "shards")


def test_odd_rows(spark):
    data = corpus.rows()
    docs = corpus.table(spark, data)
    got = result(m.mixed(docs, block_rows=5)).collect()
    assert sorted(str((r["doc_id"], r["size"])) for r in got) == sorted(
        str((r[0], len((r[1] or "").encode().split()))) for r in data
    )
    check(got, data)
    again = result(m.mixed(corpus.clashing(docs.repartition(2)), block_rows=5))
    assert corpus.collected(again) == sorted((tuple(r) for r in got), key=repr)
    assert m.mixed(corpus.empty(spark)).collect() == []


@pytest.mark.parametrize("counts", [[200, 10, 10, 10], [1, 1, 1], [50], [5, 300, 2, 2, 2, 2, 90]])
def test_targets(spark, counts):
    data = [
        (1000 * s + i, "word " * (1 + i % 7), "en", f"s{s}", 0)
        for s, n in enumerate(counts)
        for i in range(n)
    ]
    check(result(m.mixed(corpus.table(spark, data), block_rows=8)).collect(), data)


def test_no_words_at_all(spark):
    data = [(1, "", None, "a", 0), (2, None, None, None, 0)]
    got = result(m.mixed(corpus.table(spark, data))).collect()
    assert [(r["size"], r["target"], r["taken"], r["shards"]) for r in got] == [(0, 0.0, 0, "")] * 2


def test_tree_halves_every_node(spark):
    """Quotas add up along the tree, and the nodes of a level are of equal size."""
    data = [(i, "word " * 5, "en", "abc"[i % 3], 0) for i in range(300)]
    rows = m._sized(corpus.table(spark, data), "mix").select("source", "size", "key")
    sources = m.targets(rows)
    draws = m._draws(m._blocked(rows, sources, 4), "mix")
    levels = m.splitting_tree(draws, 4)
    quota = {(d, r["node"], r["source"]): r["quota"] for d, rows in enumerate(levels) for r in rows.collect()}
    for level in range(4):
        for node in range(2**level):
            for source in "abc":
                halves = sum(quota.get((level + 1, 2 * node + k, source), 0) for k in (0, 1))
                assert halves == quota.get((level, node, source), 0)
        nodes = [sum(v for (d, n, _), v in quota.items() if (d, n) == (level, node)) for node in range(2**level)]
        assert max(nodes) - min(nodes) <= 1
    dealt = m._dealt(draws, levels[-1]).collect()
    assert len(dealt) == draws.count()
    assert len({(r["source"], r["draw_no"]) for r in dealt}) == len(dealt)
    for source in "abc":
        shards = [r["shard"] for r in sorted(dealt, key=lambda r: r["draw_no"]) if r["source"] == source]
        assert shards == sorted(shards)


def test_a_level_is_drawn_from_the_one_above(spark):
    """Whatever quotas a level has, the next one halves its nodes, at random and again the same way."""
    odd = [(0, "a", 7), (0, None, 4), (1, "a", 1), (3, "b", 2000)]
    above = spark.createDataFrame(odd, "node long, source string, quota long")
    got = {(r["node"], r["source"]): r["quota"] for r in m._split(above, 2, "x").collect()}
    assert got == {(r["node"], r["source"]): r["quota"] for r in m._split(above, 2, "x").collect()}
    for node, source, quota in odd:
        assert got.get((2 * node, source), 0) + got.get((2 * node + 1, source), 0) == quota
    assert sum(v for (n, _), v in got.items() if n == 0) == 5
    assert got[6, "b"] == got[7, "b"] == 1000
    lefts = {m._split(above.filter("node = 0"), level, "x").filter("node = 0 AND source = 'a'").first()["quota"] for level in range(8)}
    assert len(lefts) > 1


def test_depth_follows_the_words(spark):
    def depth(words):
        return m._depth(spark.createDataFrame([(0, 0, words)], "passes long, source_size long, rest long"))

    most = m.SHARD_WORDS << m.DEPTH
    assert [depth(n) for n in (0, most, most + 1, 2 * most, 2 * most + 1)] == [m.DEPTH] * 2 + [m.DEPTH + 1] * 2 + [m.DEPTH + 2]


def test_a_shard_is_a_partition(spark):
    data = [(i, "word " * 5, "en", "abc"[i % 3], 0) for i in range(600)]
    parts = m.mixture(corpus.table(spark, data), block_rows=2, depth=3).rdd.map(lambda r: r["shard"]).glom().collect()
    assert [set(p) for p in parts] == [{n} for n in range(8)]


def test_shards_hold_what_was_taken(spark):
    data = corpus.rows()
    rows, depth = m.mix_plan(corpus.table(spark, data), block_rows=5)
    placed = m.shards(rows, depth).collect()
    assert sum(r["words"] for r in placed) == sum(r["taken"] for r in result(rows).collect())
    by_shard = {}
    for r in placed:
        by_shard.setdefault(r["shard"], []).append(r["place"])
    assert all(places == sorted(places) for places in by_shard.values())


def test_shards_leave_out_and_cut(spark):
    """Documents that are not taken have no row; one taken in part keeps the blanks it is written with."""
    data = [(1000 * s + i, "one  two\tthree\n four" + " more" * i, "en", f"s{s:02}", 0) for s in range(20) for i in range(30)]
    rows, depth = m.mix_plan(corpus.table(spark, data), block_rows=5)
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in result(rows).collect()}
    texts = {r[0]: r[1] for r in data}
    got = m.shards(rows, depth).select("words", "doc.doc_id", "doc.text").collect()
    assert {r["doc_id"] for r in got} == {i for i, (_, words) in taken.items() if words}
    assert any(words == 0 for _, words in taken.values())
    for r in got:
        assert len(r["text"].split()) == r["words"] and texts[r["doc_id"]].startswith(r["text"])
    assert any(0 < words % size for size, words in taken.values())
