from __future__ import annotations

from types import SimpleNamespace

import pytest

from basketry.session import delete, new_path, recorded, shared_folder, tune_joins, written


def session(master, folder=None):
    settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "file:/w"}
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, *default: settings.get(key))
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_a_cluster_needs_a_folder_that_all_see():
    assert shared_folder(session("yarn", "hdfs://name/tmp/")) == "hdfs://name/tmp"
    for folder in (None, "file:///tmp/here"):
        with pytest.raises(RuntimeError):
            shared_folder(session("yarn", folder))


def test_local_mode_may_go_without():
    assert shared_folder(session("local[8]")) == "file:/w/checkpoints"
    assert shared_folder(session("local[8]", "file:///tmp/here")) == "file:///tmp/here"


def test_written_tables_are_recorded_and_deleted(spark):
    with recorded() as paths:
        copy = written(spark.range(5))
        with recorded() as inner:
            new_path(spark)
        written(spark.range(2))
    assert copy.count() == 5 and len(paths) == 3 and len(inner) == 1
    delete(spark, paths)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(paths[0])


ESTIMATED = "spark.sql.autoBroadcastJoinThreshold"
MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"
TASK_INPUT = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.mark.parametrize(
    "named, kept",
    [
        ({ESTIMATED: "10485760b"}, {MEASURED: "10485760b", TASK_INPUT: "16m"}),
        ({ESTIMATED: "256k", TASK_INPUT: "8m"}, {MEASURED: "256k", TASK_INPUT: "8m"}),
        ({ESTIMATED: "1m", MEASURED: "2m"}, {MEASURED: "2m", TASK_INPUT: "16m"}),
    ],
)
def test_joins_and_tasks_go_by_measured_sizes(named, kept):
    settings = dict(named)
    conf = SimpleNamespace(get=lambda key, *default: settings.get(key), set=settings.__setitem__)
    for _ in range(2):  # a session is tuned by every query
        tune_joins(SimpleNamespace(conf=conf))
    assert settings[ESTIMATED] == "-1"
    assert {key: settings[key] for key in kept} == kept


SHUFFLE = "spark.sql.shuffle.partitions"
FILE_PART = "spark.sql.files.maxPartitionBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.mark.parametrize("named, kept", [({}, "2000"), ({INITIAL: "300"}, "300"), ({SHUFFLE: "200"}, "2000"), ({SHUFFLE: "5000"}, "5000")])
def test_tasks_stay_small_beyond_the_partitions_of_the_session(named, kept):
    settings = {ESTIMATED: "10m"} | named
    conf = SimpleNamespace(get=lambda key, *default: settings.get(key), set=settings.__setitem__)
    for _ in range(2):
        tune_joins(SimpleNamespace(conf=conf))
    assert settings[INITIAL] == kept
    assert settings[FILE_PART] == settings[TASK_INPUT] == "16m"


def test_a_shuffle_larger_than_the_partitions_named_is_cut_into_tasks_of_one_size(spark):
    session = spark.newSession()
    session.conf.set(SHUFFLE, "2")
    session.conf.set(TASK_INPUT, "64k")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    rows = tune_joins(session).range(200_000).selectExpr("id", "xxhash64(id) AS x")
    assert rows.groupBy("x").agg({"id": "max"}).rdd.getNumPartitions() > 10
