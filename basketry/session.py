"""Session settings the operators count on, and tables written on the way."""

from __future__ import annotations

import atexit
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, suppress
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings only, so they can be applied to a session that already runs.
# A skewed join is split even where the split costs a further shuffle: one hot
# receipt, card or SKU must not decide the run time of the whole job.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A rank limit cuts each map task's rows first, also for more than 1000 rows a key.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}

# A task after a shuffle gets this much (compressed): neighbouring partitions are put together up to it. So that
# this holds for shuffles up to 32 GB, and not only up to Spark's 200 partitions, they start from more. A map
# task holds its rows to sort them by so many partitions, so it reads no more of a file than that either.
TASK_INPUT = "16m"
PARTITIONS = 2000

# What a shuffle moves stays on disk until its job is over. Work on more rows than this is done part by part, so
# that the disk holds the shuffles of one part; more parts than these would read the input too often.
PASS_ROWS = 32_000_000
MOST_PASSES = 32

# Tables written and not yet deleted, by the session they were written in.
_written: dict[str, tuple[SparkSession, list[str]]] = {}
_recordings: list[list[str]] = []
_folders: list[str] = []


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def tune_joins(spark: SparkSession) -> SparkSession:
    """tune(), and joins and tasks that go by measured sizes, for the shop's tables.

    Spark estimates a table from its files before anything runs. A few compressed megabytes of products
    are millions of rows once listed by store, and a broadcast planned on such an estimate goes through the
    driver whatever its size turns out to be. So only shuffled, measured tables are broadcast, up to
    the limit the session has for estimated ones. Tasks get less than Spark's 64 MB of a shuffle and 128 MB
    of a file, as one of them sorts both sides of a join and aggregates the result, also where the input grows.
    Sizes the session names itself stay, and so does a larger number of partitions.
    """
    estimated, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark.conf.get(measured, None) is None:
        spark.conf.set(measured, spark.conf.get(estimated))
    spark.conf.set(estimated, "-1")
    for task_input in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"):
        if spark.conf.get(task_input, None) is None:
            spark.conf.set(task_input, TASK_INPUT)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(initial, None) is None:
        named = int(spark.conf.get("spark.sql.shuffle.partitions", None) or 0)
        spark.conf.set(initial, str(max(named, PARTITIONS)))
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    A session in local mode may go without and then uses its warehouse. Elsewhere
    the setting is required, and must not name a disk of one machine.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if named.startswith("file:") and not local:
        raise RuntimeError(f"spark.checkpoint.dir names {named}, which other machines do not see")
    return named.rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the shared folder, deleted at the end of the program unless before."""
    if _folders:
        return f"{_folders[-1]}/{kind}-{uuid4().hex}"
    path = f"{shared_folder(spark)}/basketry/{kind}-{uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, (spark, []))[1].append(path)
    for recording in _recordings:
        recording.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """The table as a Parquet copy in the shared folder.

    Cuts the lineage like a checkpoint, survives the loss of executors, and
    unlike a checkpoint lets later reads pick columns and see the true size.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def passes(rows: DataFrame) -> int:
    """In how many parts work on these rows is done. They are counted, which reads no column of a Parquet file."""
    with _shuffles_freed(rows.sparkSession):
        counted = rows.count()
    return min(MOST_PASSES, max(1, -(-counted // PASS_ROWS)))


def part_of(rows: DataFrame, key: str, number: int, parts: int) -> DataFrame:
    """The rows whose key falls to part `number`; every row, also one without a key, falls to one part."""
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == F.lit(number))


def written_in_passes(parts: Iterable[DataFrame]) -> DataFrame:
    """Tables of one schema as a single Parquet copy in the shared folder, written one after the other.

    What the shuffles of a part left on the executors' disks is deleted before the next part begins. Spark
    would keep it until the driver happens to collect its garbage.
    """
    path = None
    for part in parts:
        spark = part.sparkSession
        path = path or new_path(spark)
        with _shuffles_freed(spark):
            part.write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths taken inside, for the caller to delete when they are of no more use."""
    paths: list[str] = []
    _recordings.append(paths)
    try:
        yield paths
    finally:
        _recordings.remove(paths)


@contextmanager
def within(folder: str) -> Iterator[None]:
    """New paths taken inside lie in this folder, which was taken before, and go with it."""
    _folders.append(folder)
    try:
        yield
    finally:
        _folders.pop()


def delete(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        known = _written.get(context.applicationId, (spark, []))[1]
        if path in known:
            known.remove(path)


@atexit.register
def _delete_all() -> None:
    for spark, paths in list(_written.values()):
        with suppress(Exception):  # the session may have ended before
            if spark.sparkContext._jsc is not None:
                delete(spark, list(paths))
