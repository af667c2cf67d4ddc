"""Removes bytes covered by a string of LENGTH bytes that also starts earlier in the corpus.

1. Every window of LENGTH bytes is named by its minimizer, the least hash of the
   runs of GRAM bytes inside it. Equal windows have equal minimizers, so windows can be gathered
   by minimizer. Neighbouring windows with one minimizer make one string.
2. Strings whose minimizer occurs nowhere else hold no repeat. Of equal strings the
   earliest stands for all; every window of the others has an earlier copy there.
3. What is left are different strings that share a minimizer. Their windows are
   dealt anew by the minimizer and CONTEXT bytes beside it, on the side where
   the window has more of them; a part that shares this with no other holds no repeat.
4. Per partition the collection Burrows-Wheeler transform of the parts and its common prefixes are
   built by columns: each round puts in one symbol per part, from the last
   to the first, and the columns of the growing transform go from file to file in sequence.
   Suffixes with LENGTH bytes in common stand side by side; all but the earliest
   of such a group are repeats.
5. The repeated windows of a document are merged and cut out of its text.
"""

from __future__ import annotations

import hashlib
import io
import math
import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import record, steps, texts
from basketry.session import written

LENGTH = 100
GRAM = 40
# Windows of a string at most; longer runs (periodic texts) are cut.
MOST_WINDOWS = 64
CONTEXT = 30
# Bytes hashed at a time, few enough for a core's cache; a longer text is taken in
# overlapping stretches.
STRETCH = 1 << 17
# Symbols a partition's transform holds, about.
COLLECTION = 1 << 20
# Parts with so many others of their kind are dealt by whole windows instead.
CROWD = 8192
BASE = 0x9E3779B97F4A7C15
# Stands before the first symbol of a string: no byte of UTF-8 text, and sorted behind all.
START = 255


def _random_table() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Windows:
    """The strings of one minimizer each that cover all windows of some texts."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self.table = _random_table()
        self.up = _powers(STRETCH + length, BASE)
        self.down = _powers(STRETCH + length, pow(BASE, -1, 1 << 64))

    def _grams(self, symbols: np.ndarray) -> np.ndarray:
        """The hash of the `gram` bytes from each place on, by doubling."""
        have, size = symbols, 1
        whole, done = None, 0
        while True:
            if self.gram & size:
                # whole covers `done` bytes; `have` the next `size`.
                if whole is None:
                    whole = have
                else:
                    n = len(symbols) - done - size + 1
                    whole = whole[:n] * self.up[size] + have[done : done + n]
                done += size
            if size * 2 > self.gram:
                break
            have = have[:-size] * self.up[size] + have[size:]
            size *= 2
        whole = whole ^ (whole >> np.uint64(32))
        whole *= np.uint64(0xD6E8FEB86659FD93)
        whole ^= whole >> np.uint64(29)
        return whole

    def occurrences(self, strings: list[bytes], minimizers: list[int]) -> list[list[int]]:
        """Where each string holds the gram with the hash that is its minimizer."""
        data = np.frombuffer(b"".join(strings), np.uint8)
        ends = np.cumsum([len(s) for s in strings])
        wanted = np.repeat(np.array(minimizers, np.int64).view(np.uint64), np.diff(ends, prepend=0))
        grams = self._grams(self.table[data])
        at = np.flatnonzero(grams == wanted[: len(grams)])
        string = np.searchsorted(ends, at, side="right")
        inside = at + self.gram <= ends[string]
        at, string = at[inside], string[inside]
        bounds = np.searchsorted(string, np.arange(len(strings) + 1))
        at = (at - np.append(0, ends)[string]).tolist()
        return [at[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    @staticmethod
    def _slide(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
        """best(values[i : i + width]) for every i."""
        size = 1
        while size * 2 <= width:
            values = best(values[:-size], values[size:])
            size *= 2
        rest = width - size
        return best(values[: len(values) - rest], values[rest:]) if rest else values

    def strings(self, data: np.ndarray, ends: np.ndarray, hashed: bool = True) -> tuple[np.ndarray, ...]:
        """minimizer, content hash, text number, start in the data, windows, alone.

        data: texts one after the other, ends: where each ends. `alone` is false
        if the minimizer may occur twice within the string. Unless `hashed`, all content hashes are 0.
        """
        if len(data) < self.length:
            return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
        width = self.length - self.gram + 1
        symbols = self.table[data]
        grams = self._grams(symbols)
        least = self._slide(grams, width, np.minimum)
        # Places that are the minimizer of some window: the largest of the minima over them.
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        places = np.flatnonzero(self._slide(padded, width, np.maximum) == grams)
        values = grams[places]
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        close = np.diff(places[order]) <= MOST_WINDOWS + width
        several = np.unique(values[order][1:][same & close])
        # Windows must not cross from one text to the next.
        begins = np.concatenate([[0], ends[:-1]])
        last = ends - self.length + 1
        has = last > begins
        cut = np.empty(len(least), bool)
        cut[0] = True
        np.not_equal(least[1:], least[:-1], out=cut[1:])
        cut[begins[has]] = True
        start = np.flatnonzero(cut)
        text = np.searchsorted(ends, start, side="right")
        inside = start < last[text]
        start, text = start[inside], text[inside]
        stop = np.minimum(np.append(start[1:], len(least)), last[text])
        count = stop - start
        # Cut long runs.
        parts = -(-count // MOST_WINDOWS)
        if (parts > 1).any():
            first = np.repeat(np.cumsum(parts) - parts, parts)
            shift = (np.arange(len(first)) - first) * MOST_WINDOWS
            start, text, count = (np.repeat(x, parts) for x in (start, text, count))
            start, count = start + shift, np.minimum(count - shift, MOST_WINDOWS)
        if hashed:
            prefix = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(symbols * self.up[: len(data)], out=prefix[1:])
            content = (prefix[start + count + self.length - 1] - prefix[start]) * self.down[start]
            content ^= content >> np.uint64(31)
            content = content * np.uint64(0xBF58476D1CE4E5B9) + count.astype(np.uint64)
        else:
            content = np.zeros(len(start), np.uint64)
        minimizer = least[start]
        return minimizer, content, text, start, count, ~np.isin(minimizer, several)

    def of_batch(self, column: pa.Array, hashed: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
        """The strings of a column of texts, with row numbers and starts inside the row."""
        column = texts(column).cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        row = 0
        while row < len(column):
            top = offsets[row] + STRETCH
            until = max(row + 1, int(np.searchsorted(offsets, top, side="right")) - 1)
            low, high = int(offsets[row]), int(offsets[until])
            for at in range(low, max(high - self.length + 1, low + 1), STRETCH):
                piece = data[at : min(high, at + STRETCH + self.length - 1)]
                ends = np.minimum(offsets[row + 1 : until + 1] - at, len(piece))
                minimizer, content, text, start, count, alone = self.strings(piece, ends, hashed)
                yield minimizer, content, text + row, start + at - offsets[text + row], count, alone
            row = until


def _count_minimizers(length: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, gram)
        for batch in batches:
            for part in steps(batch):
                for minimizer, _, _, _, _, alone in windows.of_batch(part.column("text"), hashed=False):
                    # A string that may repeat a window by itself counts as two.
                    every = np.concatenate([minimizer, minimizer[~alone]])
                    values, counts = np.unique(every, return_counts=True)
                    columns = [pa.array(values.view(np.int64)), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["m", "n"])

    return run


def _list_strings(length: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, gram)
        for batch in batches:
            for part in steps(batch):
                for minimizer, content, text, start, count, alone in windows.of_batch(part.column("text")):
                    rows = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(minimizer.view(np.int64)),
                            pa.array(content.view(np.int64)),
                            part.column("doc_id").take(rows),
                            part.column("version").take(rows),
                            pa.array(start.astype(np.int64)),
                            pa.array(count.astype(np.int32)),
                            pa.array(alone),
                        ],
                        names=["m", "h", "doc_id", "version", "start", "n", "alone"],
                    )

    return run


STRINGS = "m long, h long, doc_id long, version long, start long, n int, alone boolean"
PARTS = "key long, doc_id long, version long, start long, n int, again boolean, bytes binary"


def _key(*parts: bytes) -> int:
    digest = hashlib.blake2b(b"".join(parts), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _part_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    for begin in range(0, len(rows), 20_000):
        columns = zip(*rows[begin : begin + 20_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["key", "doc_id", "version", "start", "n", "again", "bytes"],
        )


def keyed_parts(
    body: bytes, n: int, places: list[int], gram: int, length: int
) -> list[tuple[int, int, int]]:
    """key, first window, windows: the n windows of a string, cut where their key changes.

    places: where the minimizer occurs. A window's key is its first occurrence with
    the bytes before it, if there are CONTEXT of them in the window, or else behind it. So
    equal windows have equal keys, whatever string they are in.
    """
    context = min(CONTEXT, (length - gram) // 2)
    out: list[tuple[int, int, int]] = []
    done = 0
    for place in places:
        core = body[place : place + gram]
        behind = body[place + gram : place + gram + context]
        for end, sides in (
            (min(n, place - context + 1), (b"<", core, body[max(0, place - context) : place])),
            (min(n, place + 1), (b">", core, behind)),
        ):
            if end <= done:
                continue
            key = _key(*sides)
            if out and out[-1][0] == key:
                out[-1] = (key, out[-1][1], end - out[-1][1])
            else:
                out.append((key, done, end - done))
            done = end
    return out


def _cut_strings(length: int, gram: int) -> Callable:
    """The bytes of the strings asked for, in parts of one key each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(length, gram)
        for batch in batches:
            for part in steps(batch):
                asked = part.column("asked").to_pylist()
                ids, versions = part.column("doc_id").to_pylist(), part.column("version").to_pylist()
                bodies = texts(part.column("text")).cast(pa.binary()).to_pylist()
                strings = [
                    (i, x["start"], x["n"], x["m"], body[x["start"] : x["start"] + x["n"] + length - 1])
                    for i, (body, wanted) in enumerate(zip(bodies, asked, strict=True))
                    for x in wanted
                ]
                out: list[tuple] = []
                for begin in range(0, len(strings), 8000):
                    some = strings[begin : begin + 8000]
                    found = windows.occurrences([s[4] for s in some], [s[3] for s in some])
                    for (i, start, n, _, body), places in zip(some, found, strict=True):
                        for key, first, count in keyed_parts(body, n, places, gram, length):
                            cut = body[first : first + count + length - 1]
                            again = len(places) > 1
                            out.append((key, ids[i], versions[i], start + first, count, again, cut))
                yield from _part_rows(out)

    return run


def _single_windows(length: int) -> Callable:
    """Every window of the parts as a part of its own, dealt by all its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                for i in range(x["n"]):
                    window = x["bytes"][i : i + length]
                    start = x["start"] + i
                    out.append((_key(window), x["doc_id"], x["version"], start, 1, False, window))
                if len(out) >= 20_000:
                    yield from _part_rows(out)
                    out = []
            yield from _part_rows(out)

    return run


class ColumnFiles:
    """The columns of the transform between two rounds, each in a file read and written in sequence."""

    def __init__(self, folder: str):
        self.folder = folder
        self.files: dict[str, tuple[io.FileIO, int]] = {}

    def write(self, **columns: np.ndarray) -> None:
        for name, values in columns.items():
            if name not in self.files:
                self.files[name] = (open(os.path.join(self.folder, name), "w+b", buffering=0), 0)
            # Columns only grow, so the file is written over and never cut.
            file, _ = self.files[name]
            file.seek(0)
            rest = memoryview(values.astype(np.uint8, copy=False))
            while len(rest):
                rest = rest[file.write(rest) :]
            self.files[name] = (file, len(values))

    def read(self, name: str) -> np.ndarray:
        file, size = self.files[name]
        file.seek(0)
        return np.fromfile(file, np.uint8, size)

    def close(self) -> None:
        for file, _ in self.files.values():
            file.close()


def transform(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray, files: ColumnFiles) -> None:
    """Collection transform of the strings data[ends - sizes : ends], all at most 254 long.

    Leaves in the files, in the order of the suffixes, the symbol before each and its common
    prefix with the one above. Round t puts in the suffix of size t of every string that has
    one. The suffixes that begin with a symbol stand in the order of the places that the
    symbol has in `before`, so a stable sort of that column gives every new suffix its
    place and its neighbours; what it shares with a neighbour is one more than the least
    common prefix between their places. The column is sorted by runs of one symbol, of which it
    has far fewer than places.
    """
    count = len(ends)
    files.write(before=data[ends - 1], common=np.zeros(count))
    places, strings = np.arange(count), np.arange(count)
    for size in range(1, int(sizes.max(initial=0)) + 1):
        before, common = files.read("before"), files.read("common")
        longer = before[places] != START
        source, string = places[longer], strings[longer]
        symbol = before[source]

        edges = np.concatenate([[0], np.flatnonzero(before[1:] != before[:-1]) + 1, [len(before)]])
        head, long = edges[:-1], edges[1:] - edges[:-1]
        line = np.argsort(before[head], kind="stable")
        turn = np.empty(len(line), np.int64)
        turn[line] = np.arange(len(line))
        until = np.cumsum(long[line])
        run = np.searchsorted(head, source, side="right") - 1
        turn, inside = turn[run], source - head[run]
        at = count + until[turn] - long[run] + inside
        earlier, later = line[np.maximum(turn - 1, 0)], line[np.minimum(turn + 1, len(line) - 1)]
        above = np.where(inside > 0, source - 1, head[earlier] + long[earlier] - 1)
        below = np.where(inside + 1 < long[run], source + 1, head[later])
        # The first run of all and the last are their own neighbours.
        has_above = (above < source) & (before[above] == symbol)
        has_below = (below > source) & (before[below] == symbol)
        shared, shared_below = np.zeros(len(source), np.uint8), np.zeros(len(source), np.uint8)
        shared[has_above] = _least(common, above[has_above], source[has_above]) + 1
        shared_below[has_below] = _least(common, source[has_below], below[has_below]) + 1

        sorted_ = np.argsort(symbol, kind="stable")
        places, strings = at[sorted_], string[sorted_]
        old = np.ones(len(before) + len(places), bool)
        old[places] = False
        symbols = data[np.maximum(ends[strings] - size - 1, 0)]
        symbols[sizes[strings] == size] = START
        grown = _merged(old, places, common, shared[sorted_])
        # The suffix below, if it was there already; a new one has its own value from above.
        has_below, shared_below = has_below[sorted_], shared_below[sorted_]
        under = places[has_below] + 1
        there = old[under]
        grown[under[there]] = shared_below[has_below][there]
        files.write(before=_merged(old, places, before, symbols), common=grown)


def _followed(before: np.ndarray) -> np.ndarray:
    """The suffixes that another one continues to the left, in the order of those others."""
    order = np.argsort(before, kind="stable")
    return order[: len(order) - np.count_nonzero(before == START)]


def owners(before: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The string and the size of each suffix of a finished transform, by walking to the left."""
    order = _followed(before)
    left = np.full(len(before), -1, np.int64)
    left[order] = count + np.arange(len(order))
    string, size = np.empty(len(before), np.int64), np.empty(len(before), np.int64)
    at, names, step = np.arange(count), np.arange(count), 0
    while len(at):
        string[at], size[at] = names, step
        at, step = left[at], step + 1
        at, names = at[at >= 0], names[at >= 0]
    return string, size


def _merged(old: np.ndarray, places: np.ndarray, there: np.ndarray, more: np.ndarray) -> np.ndarray:
    out = np.empty(len(old), there.dtype)
    out[old] = there
    out[places] = more
    return out


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low + 1 : high + 1]) for each pair; quick if low or high ascends."""
    if not len(low):
        return np.empty(0, values.dtype)
    # From the last pair to the first, so that nothing is reduced from one pair to the next.
    bounds = np.stack([low[::-1] + 1, high[::-1] + 1], axis=1).ravel()
    # reduceat needs its last bound inside the array.
    return np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2][::-1]


def repeats(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """string, offset of every window that also starts earlier.

    rank: per string the place of its first byte in the order of the corpus; later windows of it follow.
    """
    with tempfile.TemporaryDirectory(prefix="transform-") as folder:
        files = ColumnFiles(folder)
        transform(data, ends, sizes, files)
        common = files.read("common")
        string, size = owners(files.read("before"), len(ends))
        files.close()
    # Groups of suffixes that share `length` bytes or more with the one above.
    group = np.cumsum(common < length)
    full = size >= length
    group, string, size = group[full], string[full], size[full]
    offset = sizes[string] - size
    place = rank[string] + offset
    order = np.lexsort((place, group))
    group = group[order]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    # A group's earliest place may be listed by two overlapping strings: all its rows are first.
    earliest = place[order][first][np.cumsum(first) - 1] if len(first) else place
    later = order[place[order] != earliest]
    return string[later], offset[later]


def _find_repeats(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        _, kind, counts = np.unique(
            table.column("key").to_numpy(), return_inverse=True, return_counts=True
        )
        # A part that no other shares its key with repeats nothing, unless it may repeat itself.
        shared = (counts[kind] > 1) | table.column("again").to_numpy()
        table = table.filter(pa.array(shared)).combine_chunks()
        if not table.num_rows:
            return
        body = table.column("bytes").combine_chunks().cast(pa.large_binary())
        if isinstance(body, pa.ChunkedArray):
            body = body.combine_chunks()
        offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset :][: len(body) + 1]
        data = np.frombuffer(body.buffers()[2], np.uint8)
        start = table.column("start").to_numpy()
        # Documents in the order of the corpus, null ids first; within one by start.
        doc = table.column("doc_id")
        keys = (
            table.column("version").to_numpy(),
            pc.fill_null(doc, 0).to_numpy(),
            pc.is_valid(doc).to_numpy(),
        )
        order = np.lexsort(keys)
        changed = np.zeros(len(order), np.int64)
        for key in keys:
            changed[1:] |= key[order][1:] != key[order][:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(changed)
        rank = number * (int(start.max()) + 256) + start
        string, offset = repeats(data, offsets[1:], np.diff(offsets), rank, length)
        # Neighbouring windows of a string as one run.
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        head = np.ones(len(string), bool)
        head[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
        begin = np.flatnonzero(head)
        runs = np.diff(np.append(begin, len(string)))
        rows = pa.array(string[begin])
        yield pa.RecordBatch.from_arrays(
            [
                doc.combine_chunks().take(rows) if isinstance(doc, pa.ChunkedArray) else doc.take(rows),
                table.column("version").combine_chunks().take(rows),
                pa.array(start[string[begin]] + offset[begin]),
                pa.array(runs.astype(np.int32)),
            ],
            names=["doc_id", "version", "start", "n"],
        )

    return run


def _same_doc(left: str = "", right: str = "_") -> Column:
    return F.col(f"{left}doc_id").eqNullSafe(F.col(f"{right}doc_id")) & (
        F.col(f"{left}version") == F.col(f"{right}version")
    )


def _is_first() -> Column:
    """Whether the row is the place its column `first` names."""
    return (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("version") == F.col("first.version"))
        & (F.col("start") == F.col("first.start"))
    )


def _per_doc(rows: DataFrame, name: str, *columns: Column | str) -> DataFrame:
    """The rows of each document as one array; as many as its text has strings at most."""
    return rows.groupBy(F.col("doc_id").alias("_doc_id"), F.col("version").alias("_version")).agg(
        F.collect_list(F.struct(*columns)).alias(name)
    )


def _versioned(docs: DataFrame) -> DataFrame:
    """The rows as `doc`, with doc_id, a version that tells texts of one id apart, and the text."""
    rows = record(docs).select(
        F.col("doc").dropFields("text").alias("doc"),
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        F.col("doc.text").alias("text"),
    )
    shared = rows.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    version = F.xxhash64("text") if shared else F.lit(0).cast("long")
    return rows.withColumn("version", version)


def repeated_windows(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, version, start, n: n windows from `start` on that also start earlier.

    rows: doc_id, version, text. Rows with one id and text are one document seen twice.
    """
    rows = rows.select("doc_id", "version", "text")
    counted = rows.select("text").mapInArrow(_count_minimizers(length, gram), "m long, n long")
    shared = counted.groupBy("m").agg(F.sum("n").alias("n")).filter("n > 1").select("m")
    listed = rows.mapInArrow(_list_strings(length, gram), STRINGS)
    listed = written(listed.join(shared.hint("shuffle_hash"), "m", "left_semi"))

    first = F.min(F.struct("doc_id", "version", "start"))
    strings = listed.groupBy("m", "h", "n").agg(
        first.alias("first"), F.bool_and("alone").alias("alone")
    )
    strings = written(strings)
    firsts = strings.select("m", "h", "n", "first").hint("shuffle_hash")
    copies = listed.join(firsts, ["m", "h", "n"]).filter(~_is_first())
    copies = copies.select("doc_id", "version", "start", "n")

    several = strings.groupBy("m").agg(
        F.count(F.lit(1)).alias("strings"), F.bool_and("alone").alias("alone")
    )
    several = several.filter("strings > 1 or not alone").select("m")
    asked = strings.drop("alone").join(several, "m").select("m", "n", "first.*")
    wanted = _per_doc(asked, "asked", "m", "start", "n").hint("shuffle_hash")
    parts = written(
        rows.join(wanted, _same_doc(), "inner")
        .select("doc_id", "version", "text", "asked")
        .mapInArrow(_cut_strings(length, gram), PARTS)
    )
    crowded = written(parts.groupBy("key").count().filter(F.col("count") > CROWD).select("key"))
    single = parts.join(crowded, "key", "left_semi").mapInArrow(_single_windows(length), PARTS)
    single = single.select("key", "bytes", "doc_id", "version", "start", "n")
    # However many equal windows there are: the earliest is found by partial aggregates, the others
    # by a join that can be split. Different windows repeat nothing, so the transform gets none.
    windows = single.groupBy("key", "bytes").agg(first.alias("first")).hint("shuffle_hash")
    again = single.join(windows, ["key", "bytes"]).filter(~_is_first())
    copies = copies.unionByName(again.select("doc_id", "version", "start", "n"))
    parts = parts.join(crowded, "key", "left_anti")
    total = parts.agg(F.sum(F.col("n") + length - 1)).first()[0] or 0
    found = parts.repartition(max(1, math.ceil(total / COLLECTION)), "key").mapInArrow(
        _find_repeats(length), "doc_id long, version long, start long, n int"
    )
    return copies.unionByName(found)


def _spans(windows: list[dict], length: int) -> list[tuple[int, int]]:
    """The byte ranges the windows cover, merged where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((w["start"], w["start"] + w["n"] + length - 1) for w in windows):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(body)]
    return b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _digest(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                bodies = texts(part.column("text")).cast(pa.binary()).to_pylist()
                spans = [_spans(w or [], length) for w in part.column("windows").to_pylist()]
                kept = [_kept(b, s) for b, s in zip(bodies, spans, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(b) for b in bodies], pa.int64()),
                        pa.array([len(b) - len(k) for b, k in zip(bodies, kept, strict=True)], pa.int64()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def _shorten(length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                bodies = part.column("text").cast(pa.binary()).to_pylist()
                spans = [_spans(w or [], length) for w in part.column("windows").to_pylist()]
                # A character cut in two at the edge of a span goes as a whole.
                kept = [
                    None if b is None else _kept(b, s).decode("utf-8", errors="ignore")
                    for b, s in zip(bodies, spans, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(kept, pa.string())], names=["doc", "text"]
                )

    return run


def _with_windows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    windows = _per_doc(repeated_windows(rows, length, gram), "windows", "start", "n")
    return rows.join(windows.hint("shuffle_hash"), _same_doc(), "left")


def cut_digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what stays.

    Null texts are empty. Texts shorter than `length` keep all. Rows with one doc_id and
    different texts are different documents in an order of their own; rows equal in both are
    one document and do not shorten each other.
    """
    rows = _versioned(docs.select("doc_id", "text"))
    found = _with_windows(rows, length, gram).select("doc_id", "text", "windows")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return found.mapInArrow(_digest(length), schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """All documents with the repeated bytes cut out of `text`; n_chars, if there, follows."""
    rows = _versioned(docs)
    found = _with_windows(rows, length, gram).select("doc", "text", "windows")
    schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType())])
    cut = found.mapInArrow(_shorten(length), schema)
    kinds = dict(docs.dtypes)

    def column(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.length("text").cast(kinds[name]).alias(name)
        return F.col("doc")[name].alias(name)

    return cut.select(*map(column, docs.columns))
