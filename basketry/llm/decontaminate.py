"""Finds benchmark items in documents, edits included.

Pigeonhole: an item with an error budget of k is cut into k + 1 pieces; a passage
within k edits of the item holds at least one piece unchanged. One automaton finds
all pieces in one pass over a text, and around each hit Myers' bit-parallel
algorithm gives the least edit distance between the item and any stretch of the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import record, steps, texts

# One edit is allowed per so many characters of an item.
CHARS_PER_ERROR = 12
# The items are searched in blocks of about so many characters, each a pass over the documents.
BLOCK_CHARS = 1 << 20

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("distance", T.IntegerType()),
            T.StructField("budget", T.IntegerType()),
        ]
    )
)


def normal(text: str) -> str:
    """Lower case, with single spaces: the form in which items and texts are compared."""
    return " ".join(text.lower().split())


def budget_of(item: str, chars_per_error: int = CHARS_PER_ERROR) -> int:
    return len(item) // chars_per_error


def split(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 pieces of nearly equal length, each with its offset."""
    cuts = [i * len(item) // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Item:
    """An item with the tables of Myers' algorithm: for each character the bits of its places."""

    def __init__(self, item_id: int | None, text: str, chars_per_error: int):
        self.item_id = item_id
        self.text = text
        self.budget = budget_of(text, chars_per_error)
        self.bits: dict[str, int] = {}
        for place, char in enumerate(text):
            self.bits[char] = self.bits.get(char, 0) | (1 << place)

    def distance(self, text: str) -> int:
        """Least edit distance between the item and any substring of the text."""
        size = len(self.text)
        full, last = (1 << size) - 1, 1 << (size - 1)
        plus, minus, score, best = full, 0, size, size
        for char in text:
            equal = self.bits.get(char, 0)
            vertical = equal | minus
            diagonal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | (~(diagonal | plus) & full)
            down = plus & diagonal
            if up & last:
                score += 1
            elif down & last:
                score -= 1
                best = min(best, score)
            up = (up << 1) & full
            down = (down << 1) & full
            plus = down | (~(vertical | up) & full)
            minus = up & vertical
        return best


class Searcher:
    """All items of a block behind one automaton of their pieces."""

    def __init__(self, rows: list[tuple[int | None, str]], chars_per_error: int):
        self.items = [Item(item_id, text, chars_per_error) for item_id, text in rows]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, item in enumerate(self.items):
            for offset, piece in split(item.text, item.budget):
                places.setdefault(piece, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[dict]:
        """The items found, each with its least distance."""
        windows: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            begin = end - size + 1
            for number, offset in where:
                item = self.items[number]
                first = max(0, begin - offset - item.budget)
                last = begin - offset + len(item.text) + item.budget
                # Hits come in order of their ends: overlapping windows become one.
                known = windows.setdefault(number, [])
                if known and first <= known[-1][1]:
                    known[-1] = (min(first, known[-1][0]), max(last, known[-1][1]))
                else:
                    known.append((first, last))
        found = []
        for number, known in windows.items():
            item = self.items[number]
            best = min(item.distance(text[a:b]) for a, b in known)
            if best <= item.budget:
                found.append({"item_id": item.item_id, "distance": best, "budget": item.budget})
        return sorted(found, key=lambda x: (x["item_id"] is None, x["item_id"]))


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list]:
    """The items with text, normalised, in blocks of bounded size; a block at a time is fetched."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_chars))
    for number in range(count):
        part = items
        if count > 1:
            part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = [(row[0], normal(row[1])) for row in part.distinct().collect()]
        if rows := [row for row in rows if row[1]]:
            yield rows


ARROW_FOUND = pa.list_(
    pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32())])
)


def _scan(rows: list, chars_per_error: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(rows, chars_per_error)
        for batch in batches:
            for part in steps(batch):
                found = [
                    before + searcher.search(normal(text))
                    for before, text in zip(
                        part.column("found").to_pylist(),
                        texts(part.column("text")).to_pylist(),
                        strict=True,
                    )
                ]
                columns = [part.column("doc"), part.column("text"), pa.array(found, ARROW_FOUND)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "found"])

    return scan


def searched(
    docs: DataFrame, benchmark: DataFrame, chars_per_error: int = CHARS_PER_ERROR,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Every document as `doc` (without its text) and `text`, with the items `found` in it.

    found: array of (item_id, distance, budget). Equal items of different ids are found
    each, rows of an item that repeat once. Items without a character but blanks
    are found nowhere, null and empty texts hold nothing. Each block of items is
    a further pass over the same rows.
    """
    rows = record(docs).select(
        F.col("doc").dropFields("text").alias("doc"),
        "doc.text",
        F.array().cast(FOUND).alias("found"),
    )
    for block in blocks(benchmark, block_chars):
        rows = rows.mapInArrow(_scan(block, chars_per_error), rows.schema)
    return rows


def leaks(docs: DataFrame, benchmark: DataFrame, **limits: int) -> DataFrame:
    """doc_id, item_id, distance, budget: one row per document and item found in it."""
    rows = searched(docs.select("doc_id", "text"), benchmark, **limits)
    return rows.select("doc.doc_id", F.explode("found").alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame, **limits: int) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    rows = searched(docs, benchmark, **limits).filter(F.size("found") == 0)
    return rows.select(
        *(F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns)
    )
