from __future__ import annotations

import re
from pathlib import Path

import corpus
import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from basketry.llm import decontaminate, mixing, quality_rules, simhash, suffix_dedup
from basketry.llm.oracle import STATEMENTS
from basketry.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_registered():
    assert [re.match(r"op(\d+)_", name)[1] for name in QUERIES] == [str(n) for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(STATEMENTS) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    cursor = duck.execute(STATEMENTS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()]
    assert sorted(tuple(r[c] for c in columns) for r in result.collect()) == sorted(expected)


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_has_a_row_per_document(spark, name):
    result = QUERIES[name](spark, FOLDER)
    if name == "op13_conversations":
        talks = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id").distinct()
        assert corpus.collected(result.select("conv_id")) == corpus.collected(talks)
        return
    assert "doc_id" in result.columns
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert result.count() == documents or name == "op5_decontamination"


def data():
    """Long enough for the rules, with copies, shared passages and an item of the benchmark."""
    import random

    rng = random.Random(3)
    passage, item = corpus.sentence(rng, 60), corpus.sentence(rng, 30)
    docs = []
    for i in range(60):
        text = corpus.sentence(rng, rng.randint(120, 300))
        if i % 10 == 3:
            text = docs[-1][1]
        elif i % 10 == 5:
            text = f"{text} {passage} {corpus.sentence(rng, 60)}"
        elif i % 10 == 7:
            text = f"{text} {item} {text[:80]}"
        elif i % 10 == 9:
            text = " ".join(f"{w}***" for w in text.split())
        docs.append((i, text, "en", "ab"[i % 2], len(text)))
    return docs + [(100, None, None, None, None), (101, "", "en", "a", 0), (102, "short", "en", "a", 5)], item


def test_stages_and_run(spark, tmp_path):
    docs, item = data()
    corpus.table(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = now.columns
    sizes = [now.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{number}")
        sizes.append(now.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == columns
        if number == 0:
            judged = quality_rules.quality_verdicts(before).filter("kept").select("doc_id")
            assert corpus.collected(judged) == corpus.collected(now.select("doc_id"))
        elif number == 1:
            heads = simhash.near_duplicates(before).select("component_id").distinct()
            assert corpus.collected(heads) == corpus.collected(now.select("doc_id"))
        elif number == 2:
            cut = suffix_dedup.cut_digest(before).collect()
            kept = {r["doc_id"]: r["n_bytes"] - r["n_removed"] for r in cut}
            assert {r["doc_id"]: len(r["text"].encode()) for r in now.collect()} == kept
            assert sum(r["n_removed"] > 0 for r in cut) > 0
        elif number == 3:
            benchmark = spark.read.parquet(f"{tmp_path}/benchmark.parquet")
            gone = {r["doc_id"] for r in decontaminate.leaks(before, benchmark).collect()}
            assert {r["doc_id"] for r in before.collect()} - gone == {r["doc_id"] for r in now.collect()}
            assert gone
        else:
            check_draws(mixing.with_taken(mixing.mixed(before)).select("*", "doc.*").collect(), now.collect())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4]
    result = driver.queries()["pipeline"](spark, str(tmp_path))
    assert corpus.collected(result) == corpus.collected(now)


def check_draws(account, drawn):
    """The last stage gives what the mix takes, as often and as much of it, by shard."""
    account = {r["doc_id"]: r for r in account}
    taken = dict.fromkeys(account, 0)
    for r in drawn:
        assert len(r["text"].split()) == r["words"] > 0
        assert account[r["doc_id"]]["text"].startswith(r["text"])
        assert str(r["shard"]) in account[r["doc_id"]]["shards"].split(",")
        taken[r["doc_id"]] += r["words"]
    assert taken == {i: r["taken"] for i, r in account.items()}
    assert len(drawn) > len({r["doc_id"] for r in drawn})


def test_stages_on_an_empty_table(spark, tmp_path):
    corpus.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
