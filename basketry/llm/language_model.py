"""A bigram model with interpolated modified Kneser-Ney smoothing.

Counted: each task adds up its bigrams, Spark gathers them by shard, and the
task of a shard writes its bigrams as a sorted array of 64-bit hashes with their counts. What a word
has as a context (occurrences, followers seen once, twice, more often) and
as a word (occurrences, different contexts) is gathered by word and written likewise.
Scored: workers map the files into memory and look the hashes of a stretch of text up in order,
so that no text is moved and no worker holds the model.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from basketry.llm.common import steps, texts, word_lists
from basketry.llm.toxicity import fold
from basketry.session import new_path

FOLDS, HELD_OUT = 10, 0
# Bytes of text tokenised at a time.
STEP = 2 << 20
# Tokens a task adds up before it passes its bigrams on.
CHUNK_TOKENS = 1_500_000
# The bigrams of one context lie in so many shards: none is that of a single word.
SPREAD = 8
# Blanks are in no word, so these are no word's hashes.
BEGIN, END = (np.uint64(xxhash.xxh64_intdigest(name)) for name in (b" begin", b" end"))
ADDED = 0.1

COUNTED = "shard int, contexts binary, lengths binary, words binary, counts binary"
STATS = "part int, stats binary, path string, shard int, tally array<long>"
# The parts of rows that name a file of bigrams, and of those with MANY occurrences and more.
PAIRS, FREQUENT = -1, -2
MANY = 255
# Per word: occurrences as a context, followers once, twice, oftener; occurrences, contexts.
COLUMNS = 6


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each with its end, and of each the text it is from."""
    column = texts(column)
    found, rows = word_lists(column)
    coded = found.dictionary_encode()
    digest = xxhash.xxh64_intdigest
    known = np.array([digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    size = len(column)
    out = np.full(len(rows) + size, END, np.uint64)
    out[np.arange(len(rows)) + rows] = known[coded.indices.to_numpy()]
    counts = np.bincount(rows, minlength=size) + 1
    return out, np.repeat(np.arange(size), counts)


def contexts(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The token before each, a text's begin before its first."""
    out = np.empty_like(hashes)
    out[1:] = hashes[:-1]
    if len(out):
        first = np.ones(len(rows), bool)
        first[1:] = rows[1:] != rows[:-1]
        out[first] = BEGIN
    return out


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = before * np.uint64(0x9E3779B97F4A7C15) ^ (word + np.uint64(0x632BE59BD9B4E019))
    key ^= key >> np.uint64(32)
    key *= np.uint64(0xD6E8FEB86659FD93)
    return key ^ (key >> np.uint64(29))


def pair_shard(before: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    return ((before + (word >> np.uint64(8)) % np.uint64(SPREAD)) % np.uint64(shards)).astype(np.int64)


def _count(shards: int) -> Callable:
    def flush(held: list) -> Iterator[pa.RecordBatch]:
        before, word = (np.concatenate(x) for x in zip(*held, strict=True))
        _, at, counts = np.unique(pair_keys(before, word), return_index=True, return_counts=True)
        before, word = before[at], word[at]
        shard = pair_shard(before, word, shards)
        order = np.lexsort((before, shard))
        before, word, counts, shard = before[order], word[order], counts[order], shard[order]
        edges = np.searchsorted(shard, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[s], edges[s + 1])
            names, lengths = np.unique(before[part], return_counts=True)
            packed = (names, lengths.astype(np.uint32), word[part], counts[part].astype(np.uint32))
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                names=["shard", "contexts", "lengths", "words", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in steps(batch, most=STEP):
                hashes, rows = tokens(part.column("text"))
                held.append((contexts(hashes, rows), hashes))
                size += len(hashes)
                if size >= CHUNK_TOKENS:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _write(folder: str, name: str, columns: list[np.ndarray]) -> str:
    """The columns one after the other in a new file; complete or not there. Returns its URI."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    own = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{path}/.{own}") as out:
        for column in columns:
            out.write(column.tobytes())
    store.move(f"{path}/.{own}", f"{path}/{own}")
    return f"{folder}/{own}"


class Mapped:
    """The columns of a file, mapped into memory; one that lies elsewhere is fetched to a local one."""

    def __init__(self, uri: str, kinds: list[type], scratch: str):
        store, path = fs.FileSystem.from_uri(uri)
        if not isinstance(store, fs.LocalFileSystem):
            # For the time of the task; the folder goes with it.
            near = os.path.join(scratch, uuid.uuid4().hex)
            fs.copy_files(path, near, source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
            path = near
        size = os.path.getsize(path) // sum(np.dtype(k).itemsize for k in kinds)
        self.columns, offset = [], 0
        for kind in kinds:
            if size:
                self.columns.append(np.memmap(path, kind, "r", offset, (size,)))
            else:
                self.columns.append(np.empty(0, kind))
            offset += size * np.dtype(kind).itemsize

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each of the sorted keys, and whether it is there."""
        stored = self.columns[0]
        at = np.searchsorted(stored, keys)
        here = at < len(stored)
        here[here] = stored[at[here]] == keys[here]
        return at, here


def _grouped(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys in order, and the sums of each column over the rows of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    # One column at a time: a shard's rows are many.
    sums = [np.add.reduceat(v[order], first, dtype=np.int64) if len(keys) else v for v in values]
    return keys[first], sums


def _tally(counts: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4, how many there are and what they add up to."""
    return [*(int((counts == i).sum()) for i in range(1, 5)), len(counts), int(counts.sum())]


def _build_pairs(folder: str, parts: int) -> Callable:
    """Writes the bigrams of each shard; passes on what they say about each word."""

    def build(shard: int, held: list) -> Iterator[pa.RecordBatch]:
        before, word, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        keys = pair_keys(before, word)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        total = np.add.reduceat(counts[order], first).astype(np.uint32)
        # A byte is enough for nearly all counts.
        often = total >= MANY
        few = np.minimum(total, MANY).astype(np.uint8)
        path = _write(folder, f"pairs-{shard}", [keys[first], few])
        frequent = _write(folder, f"frequent-{shard}", [keys[first[often]], total[often]])
        before, word = before[order[first]], word[order[first]]
        del keys, order, first, counts
        of_context, as_context = _grouped(before, [total, total == 1, total == 2, total > 2])
        of_word, as_word = _grouped(word, [total, np.ones(len(total), bool)])
        names = np.union1d(of_context, of_word)
        sums = np.zeros((len(names), COLUMNS), np.int64)
        sums[np.searchsorted(names, of_context), :4] = np.stack(as_context, axis=1)
        sums[np.searchsorted(names, of_word), 4:] = np.stack(as_word, axis=1)
        part = names % np.uint64(parts)
        for p in range(parts):
            some = part == p
            yield _stats_row(p, names[some].tobytes() + sums[some].tobytes(), None, None, None)
        yield _stats_row(PAIRS, None, path, shard, _tally(total))
        yield _stats_row(FREQUENT, None, frequent, shard, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for row in _rows(batches):
            lengths = np.frombuffer(row["lengths"], np.uint32)
            held.setdefault(row["shard"], []).append(
                (
                    np.repeat(np.frombuffer(row["contexts"], np.uint64), lengths),
                    np.frombuffer(row["words"], np.uint64),
                    np.frombuffer(row["counts"], np.uint32),
                )
            )
        while held:
            yield from build(*held.popitem())

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, as a row holds a whole chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _stats_row(part, packed, path, shard, tally) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([packed], pa.binary()),
            pa.array([path], pa.string()),
            pa.array([shard], pa.int32()),
            pa.array([tally], pa.list_(pa.int64())),
        ],
        names=["part", "stats", "path", "shard", "tally"],
    )


def _build_words(folder: str) -> Callable:
    """Writes the sums of each part's words; those that occur as words go into the tally."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for row in _rows(batches):
            if row["part"] < 0:
                yield _stats_row(row["part"], None, row["path"], row["shard"], row["tally"])
                continue
            packed = np.frombuffer(row["stats"], np.uint64)
            size = len(packed) // (COLUMNS + 1)
            held.setdefault(row["part"], []).append(
                (packed[:size], packed[size:].view(np.int64).reshape(size, COLUMNS))
            )
        while held:
            part, rows = held.popitem()
            keys, values = (np.concatenate(x) for x in zip(*rows, strict=True))
            del rows
            names, sums = _grouped(keys, list(values.T))
            path = _write(folder, f"words-{part}", [names, *sums])
            contexts_of = sums[5][sums[5] > 0]
            yield _stats_row(part, None, path, part, [*_tally(contexts_of), int(sums[4].sum())])

    return run


def _discounts(tally: list[int]) -> list[float]:
    """What is taken off counts of 1, 2 and more; a corpus too small for an estimate takes its part."""
    n = [max(1, x) for x in tally[:4]]
    rate = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * rate * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


@dataclass
class Model:
    """Where the files are, and the few numbers that concern all words. Small whatever the corpus."""

    pairs: dict[int, str]
    frequent: dict[int, str]
    words: dict[int, str]
    shards: int
    pair_discounts: list[float]
    word_discounts: list[float]
    word_counts: list[int]  # words with 1, 2 and more contexts
    distinct_pairs: int
    vocabulary: int
    train_tokens: int

    def rest_of_words(self) -> float:
        """The share of the words' probability that goes to all words alike."""
        if not self.distinct_pairs:
            return 1.0
        taken = sum(d * n for d, n in zip(self.word_discounts, self.word_counts, strict=True))
        return taken / self.distinct_pairs


def train(docs: DataFrame) -> Model:
    """Counts the texts and writes the model into the shared folder."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_path(spark, "model")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    counted = docs.select("text").mapInArrow(_count(shards), COUNTED)
    stats = counted.repartition(shards, "shard").mapInArrow(_build_pairs(folder, shards), STATS)
    # A file is complete or not there, and every attempt writes its own: whichever a row
    # names, it holds the shard.
    files = stats.repartition(shards, "part").mapInArrow(_build_words(folder), STATS).collect()
    pairs = [row for row in files if row["part"] == PAIRS]
    frequent = [row for row in files if row["part"] == FREQUENT]
    words = [row for row in files if row["part"] >= 0]

    def added(rows: list[Row], size: int) -> list[int]:
        return [sum(row["tally"][i] for row in rows) for i in range(size)]

    of_pairs, of_words = added(pairs, 6), added(words, 7)
    return Model(
        pairs={row["shard"]: row["path"] for row in pairs},
        frequent={row["shard"]: row["path"] for row in frequent},
        words={row["shard"]: row["path"] for row in words},
        shards=shards,
        pair_discounts=_discounts(of_pairs),
        word_discounts=_discounts(of_words),
        word_counts=[of_words[0], of_words[1], of_words[4] - of_words[0] - of_words[1]],
        distinct_pairs=of_pairs[4],
        vocabulary=of_words[4],
        train_tokens=of_words[6],
    )


class Reader:
    """Looks words and bigrams up in the mapped files."""

    def __init__(self, model: Model, scratch: str):
        self.model = model
        kinds = [np.uint64, *[np.int64] * COLUMNS]
        self.words = {k: Mapped(uri, kinds, scratch) for k, uri in model.words.items()}
        self.pairs = {k: Mapped(uri, [np.uint64, np.uint8], scratch) for k, uri in model.pairs.items()}
        self.frequent = {
            k: Mapped(uri, [np.uint64, np.uint32], scratch) for k, uri in model.frequent.items()
        }

    def word_stats(self, hashes: np.ndarray) -> np.ndarray:
        """The COLUMNS sums of each of the sorted distinct hashes, zero for unknown ones."""
        out = np.zeros((len(hashes), COLUMNS), np.int64)
        part = hashes % np.uint64(self.model.shards)
        for p, mapped in self.words.items():
            asked = np.flatnonzero(part == p)
            at, here = mapped.find(hashes[asked])
            for i in range(COLUMNS):
                out[asked[here], i] = mapped.columns[i + 1][at[here]]
        return out

    def pair_counts(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for s, mapped in self.pairs.items():
            asked = np.flatnonzero(shard == s)
            order = np.argsort(keys[asked])
            asked = asked[order]
            at, here = mapped.find(keys[asked])
            out[asked[here]] = mapped.columns[1][at[here]]
            often = asked[out[asked] == MANY]
            at, _ = self.frequent[s].find(keys[often])
            out[often] = self.frequent[s].columns[1][at]
        return out

    def probabilities(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each token after its context, and its training count."""
        model = self.model
        names, place = np.unique(np.concatenate([hashes, before]), return_inverse=True)
        word, context = place[: len(hashes)], place[len(hashes) :]
        stats = self.word_stats(names).astype(float)
        total, once, twice, more, count, kinds = stats.T
        # By the number of different contexts, interpolated with the same for every word.
        left = np.maximum(kinds - np.append(0, model.word_discounts)[np.minimum(kinds, 3).astype(int)], 0)
        alone = left / max(1, model.distinct_pairs) + model.rest_of_words() / (model.vocabulary + 1)
        # By the count after the context, interpolated with that.
        pair, back = np.unique(context.astype(np.int64) * len(names) + word, return_inverse=True)
        context, word = pair // max(1, len(names)), pair % max(1, len(names))
        seen = self.pair_counts(
            pair_keys(names[context], names[word]), pair_shard(names[context], names[word], model.shards)
        )
        d = np.array([0.0, *model.pair_discounts])
        taken = d[1] * once + d[2] * twice + d[3] * more
        known = total[context] > 0
        of_context = np.where(known, total[context], 1)
        chance = np.where(
            known,
            np.maximum(seen - d[np.minimum(seen, 3)], 0) / of_context
            + taken[context] / of_context * alone[word],
            alone[word],
        )
        return chance[back], count[place[: len(hashes)]]


def _score(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory(prefix="model-") as scratch:
            reader = Reader(model, scratch)
            weight = model.train_tokens + ADDED * (model.vocabulary + 1)
            for batch in batches:
                for part in steps(batch, most=STEP):
                    hashes, rows = tokens(part.column("text"))
                    chance, count = reader.probabilities(hashes, contexts(hashes, rows))
                    size = part.num_rows

                    def summed(values: np.ndarray, rows=rows, size=size) -> np.ndarray:
                        return np.bincount(rows, weights=values, minlength=size)

                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("doc_id"),
                            pa.array(np.bincount(rows, minlength=size)),
                            pa.array(summed(count > 0).astype(np.int64)),
                            pa.array(summed(np.log10((count + ADDED) / weight))),
                            pa.array(summed(np.log10(chance))),
                        ],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                    )

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity of every row.

    Null texts are empty ones: their only token is the end. Repeated rows score alike. A
    model of no text gives every token the same probability of one.
    """
    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score(model), schema)
    return rows.withColumns(
        {
            "train_tokens": F.lit(model.train_tokens).cast("long"),
            "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")),
        }
    )


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all rows under a model of those outside the held-out fold."""
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    model = train(docs.filter(~held_out))
    return scored(docs, model).withColumn("held_out", held_out)
