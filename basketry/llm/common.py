"""Helpers that several operators share."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six ASCII blanks \x09-\x0D and \x20. Everything else belongs to a word.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Text is handled in steps of about so many bytes, so that the memory of a task
# does not depend on how many documents Spark puts into one batch.
STEP_BYTES = 4 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(folder, f"{name}.parquet"))


def words(text: Column) -> Column:
    """The words of a text, none for a null one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once per row however often body and its lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def record(docs: DataFrame) -> DataFrame:
    """The rows packed into one column `doc`: no name of theirs can clash with a helper's."""
    return docs.select(F.struct("*").alias("doc"))


def texts(column: pa.Array) -> pa.Array:
    """Null texts as empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with at most `most` bytes of text, or a single longer row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def word_lists(column: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and of each word the row it comes from."""
    column = pc.ascii_lower(column) if lower else column
    split = pc.ascii_split_whitespace(column)
    flat = split.flatten()
    rows = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    real = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(real).as_py() and len(flat):
        flat, rows = flat.filter(real), rows[real.to_numpy(zero_copy_only=False)]
    return flat, rows


def one_text(docs: DataFrame) -> DataFrame:
    """doc_id and text, one row per id: of an id's rows the text with the least hash."""
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    return docs.groupBy("doc_id").agg(least).select("doc_id", "least.text")
