"""Counts a tokenizer's tokens per document through the distinct pre-tokens of the corpus.

A byte-level tokenizer cuts a text into pre-tokens and each of them, by itself, into
pieces. So the pre-tokens of the documents are counted, each distinct one is
encoded where all its occurrences meet, and a document's tokens are the sum
over its pre-tokens of frequency times pieces. No ids of a document are ever made.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm.common import steps, texts

# Unicode white space, which is what the pre-tokenizer's pattern takes for \s.
SPACE = "\t-\r \x85\xa0  -     　"
# Stretches the pattern never joins: a word with the blank before it, or blanks up
# to that one. The pre-tokens of a text are those of its stretches.
STRETCH = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Letters only, so a pre-token by itself.
PLAIN = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
# Documents of a step at most: a document's number in its step takes two bytes.
STEP_ROWS = 50_000
# A pre-token in so large a part of a step's documents is dealt by step as well.
COMMON_PART = 1 / 16
# Distinct pre-tokens whose pieces a task remembers.
REMEMBERED = 1_000_000
CHUNK = (
    "bucket int, words array<string>, sizes binary, docs binary, counts binary, first long,"
    " doc_ids array<long>, n_bytes array<long>, extra array<long>"
)


def load(path: str) -> Tokenizer:
    # A task has one core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def added_tokens(tokenizer: Tokenizer) -> re.Pattern | None:
    """The strings the tokenizer takes out of a text as a token each before it cuts the rest."""
    contents = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    longest_first = sorted(contents, key=len, reverse=True)
    return re.compile("|".join(map(re.escape, longest_first))) if contents else None


def _pre_tokens(tokenizer: Tokenizer, stretch: str) -> list[str]:
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str(stretch)
    return [stretch[a:b] for _, (a, b) in pieces]


def occurrences(tokenizer: Tokenizer, bodies: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of the texts, and of each occurrence its pre-token and its text."""
    stretches = [STRETCH.findall(body) for body in bodies]
    rows = np.repeat(np.arange(len(bodies)), [len(s) for s in stretches])
    coded = pa.array([s for one in stretches for s in one], pa.string()).dictionary_encode()
    code = coded.indices.to_numpy()
    plain = pc.match_substring_regex(coded.dictionary, PLAIN).to_numpy(zero_copy_only=False)
    names: dict[str, int] = {}
    parts: list[list[int]] = []
    for stretch, simple in zip(coded.dictionary.to_pylist(), plain.tolist(), strict=True):
        found = [stretch] if simple else _pre_tokens(tokenizer, stretch)
        parts.append([names.setdefault(x, len(names)) for x in found])
    lengths = np.array([len(p) for p in parts], np.int64)
    flat = np.array([x for p in parts for x in p], np.int64)
    begins = np.cumsum(lengths) - lengths
    each = lengths[code]
    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    return list(names), flat[np.repeat(begins[code], each) + within], np.repeat(rows, each)


def _frequencies(path: str, buckets: int) -> Callable:
    """Per step and bucket of pre-tokens one row: the pre-tokens and their frequencies by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        special = added_tokens(tokenizer)
        number = TaskContext.get().partitionId() << 33
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                for part in steps(batch.slice(at, STEP_ROWS)):
                    yield from _step(tokenizer, special, part, number, turn, buckets)
                    number += part.num_rows
                    turn += 1

    return run


def _step(tokenizer, special, part, number, turn, buckets) -> Iterator[pa.RecordBatch]:
    column = texts(part.column("text"))
    size = len(column)
    bodies = column.to_pylist()
    extra = [0] * size
    for i, body in enumerate(bodies):
        if special is not None and special.search(body):
            extra[i] = len(special.findall(body))
    if any(extra):
        pieces = [special.split(b) if n else [b] for b, n in zip(bodies, extra, strict=True)]
        owner = np.repeat(np.arange(size), [len(p) for p in pieces])
        names, token, piece = occurrences(tokenizer, [x for p in pieces for x in p])
        doc = owner[piece]
    else:
        names, token, doc = occurrences(tokenizer, bodies)
    pairs, counts = np.unique(token * size + doc, return_counts=True)
    token, doc = pairs // size, pairs % size
    spread = np.bincount(token, minlength=len(names))
    bucket = np.array([zlib.crc32(x.encode()) for x in names], np.int64)
    bucket = (bucket + (spread > size * COMMON_PART) * turn) % buckets
    # The roster of the documents travels with one of the buckets.
    yield _chunk(
        turn % buckets, [], spread[:0], doc[:0], counts[:0], number,
        part.column("doc_id").to_pylist(), pc.binary_length(column).to_pylist(), extra,
    )
    if not len(names):
        return
    order = np.argsort(bucket[token], kind="stable")
    token, doc, counts = token[order], doc[order], counts[order]
    edges = np.searchsorted(bucket[token], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        some = slice(edges[b], edges[b + 1])
        used, sizes = np.unique(token[some], return_counts=True)
        yield _chunk(b, [names[i] for i in used], sizes, doc[some], counts[some], number, [], [], [])


def _chunk(bucket, words, sizes, docs, counts, number, doc_ids, n_bytes, extra) -> pa.RecordBatch:
    def packed(values: np.ndarray, kind: type = np.uint32) -> pa.Array:
        return pa.array([values.astype(kind).tobytes()], pa.binary())

    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket], pa.int32()),
            pa.array([words], pa.list_(pa.string())),
            packed(sizes),
            packed(docs, np.uint16),
            packed(counts),
            pa.array([number], pa.int64()),
            pa.array([doc_ids], longs),
            pa.array([n_bytes], longs),
            pa.array([extra], longs),
        ],
        names=["bucket", "words", "sizes", "docs", "counts", "first", "doc_ids", "n_bytes", "extra"],
    )


class Pieces:
    """How many pieces a pre-token has; encoded at its first occurrence in the task."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        # What a text's special strings would be is settled before its pre-tokens are cut.
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, words
        for begin in range(0, len(fresh), 10_000):
            some = fresh[begin : begin + 10_000]
            for word, got in zip(
                some, self.tokenizer.encode_batch(some, add_special_tokens=False), strict=True
            ):
                self.known[word] = len(got)
        return np.array([self.known[w] for w in words], np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, as a row holds a whole chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _lookup(path: str) -> Callable:
    """Per chunk one row: the tokens its pre-tokens give each document of the step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(path)
        for row in _rows(batches):
            if row["doc_ids"]:
                sums = np.array(row["extra"], np.int64)
            else:
                sizes, counts = (np.frombuffer(row[n], np.uint32) for n in ("sizes", "counts"))
                each = np.repeat(pieces.of(row["words"]), sizes) * counts
                where = np.frombuffer(row["docs"], np.uint16)
                sums = np.bincount(where, weights=each).astype(np.int64)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["first"]], pa.int64()),
                    pa.array([sums.tobytes()], pa.binary()),
                    pa.array([row["doc_ids"]], longs),
                    pa.array([row["n_bytes"]], longs),
                ],
                names=["first", "sums", "doc_ids", "n_bytes"],
            )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each step with the sum over its chunks."""
    totals: dict[int, np.ndarray] = {}
    rosters: dict[int, tuple[list, list]] = {}
    for row in _rows(batches):
        sums = np.frombuffer(row["sums"], np.int64)
        if row["doc_ids"]:
            rosters[row["first"]] = (row["doc_ids"], row["n_bytes"])
        so_far = totals.get(row["first"], sums[:0])
        grown = np.zeros(max(len(sums), len(so_far)), np.int64)
        grown[: len(so_far)] += so_far
        grown[: len(sums)] += sums
        totals[row["first"]] = grown
    for first, (doc_ids, n_bytes) in rosters.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(n_bytes, pa.int64()), pa.array(totals[first])],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row; null texts are empty and have no tokens.

    path: the file of a byte-level tokenizer, which the executors have. Special
    strings in a text are tokens, as the library has it; none are added. A text
    of any length is counted whole. Repeated rows are counted each.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _frequencies(path, buckets), CHUNK
    )
    sums = chunks.repartition(buckets, "bucket").mapInArrow(
        _lookup(path), "first long, sums binary, doc_ids array<long>, n_bytes array<long>"
    )
    return sums.repartition(buckets, "first").mapInArrow(
        _totals, "doc_id long, n_bytes long, n_tokens long"
    )
