"""Finds the periodic runs of words in every text and collapses them to one period.

A suffix array of the words with its inverse (ISA) and common prefixes (LCP) is built for many
documents at once: the symbols of different documents differ, so their suffixes never mix.
The last square of a run of period q begins at an i with LCP(i, i + q) = q, a branching
tandem repeat. Every place b of the LCP array parts the suffixes around it, as far as they share
LCP[b] = l words, into those before b and those from b on. Each suffix i of the smaller
part asks whether ISA[i + l] or ISA[i - l] is in the other one; no tree is built. Such
squares are rotated to the left as far as the words repeat, which gives their runs; what has the
same ends is one run, and its least period counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import let, steps, texts, word_lists, words

MIN_LENGTH = 12
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def spans(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... counts[0] numbers in all, then those of begins[1], and so on."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begins - (ends - counts), counts)


def rank_levels(symbols: np.ndarray) -> list[np.ndarray]:
    """By k, the rank of each suffix by its first 2**k symbols; the last level is the ISA.

    Equal ranks mean equal symbols. A rank is the number of suffixes that are less, so one that
    no other shares is final, and only shared ones are sorted again. The last symbol of a
    document must be unlike all others.
    """
    order = np.argsort(symbols, kind="stable")
    in_order = symbols[order]
    first = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
    sizes = np.diff(np.append(first, len(symbols)))
    rank = np.empty(len(symbols), np.int64)
    rank[order] = np.repeat(first, sizes)
    levels = [rank]
    shared = order[np.repeat(sizes > 1, sizes)]
    step = 1
    while len(shared):
        key = rank[shared] * len(symbols) + rank[shared + step]
        by_key = np.argsort(key, kind="stable")
        shared, key = shared[by_key], key[by_key]
        old = rank[shared]
        place = np.arange(len(shared))
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), place, 0))
        new = np.append(True, key[1:] != key[:-1])
        begin = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[shared] = old + begin - group
        levels.append(rank)
        lonely = new & np.append(new[1:], True)
        shared = shared[~lonely]
        step *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], suffixes: np.ndarray) -> np.ndarray:
    """LCP[b]: symbols that the suffixes at b - 1 and b of the suffix array share; LCP[0] is 0."""
    one, other = suffixes[:-1], suffixes[1:]
    top = np.full(len(one), -1)
    some = np.arange(len(one))
    for k, rank in enumerate(levels):
        some = some[rank[one[some]] == rank[other[some]]]
        top[some] = k
    length = np.where(top >= 0, np.int64(1) << np.maximum(top, 0), 0)
    for k in range(len(levels) - 2, -1, -1):
        some = np.flatnonzero(top > k)
        at = length[some]
        same = levels[k][one[some] + at] == levels[k][other[some] + at]
        length[some[same]] += 1 << k
    return np.append(0, length)


def _parts(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Around each place: where suffixes begin that share as much, and the next place not above it."""
    size = len(lcp)
    inside = np.flatnonzero(np.append(lcp, 0) == 0)
    longest = int(np.diff(inside).max(initial=1))
    depth = max(1, longest.bit_length())
    padded = np.concatenate([np.zeros(1 << depth, lcp.dtype), lcp, np.zeros(1 << depth, lcp.dtype)])
    shift = 1 << depth
    least = [padded]
    for k in range(depth - 1):
        below = least[-1]
        least.append(np.minimum(below, np.append(below[1 << k :], np.zeros(1 << k, lcp.dtype))))
    own = lcp[at]
    left, right = at - 1 + shift, at + 1 + shift
    for k in range(depth - 1, -1, -1):
        left = left - np.where(least[k][left - (1 << k) + 1] >= own, 1 << k, 0)
        right = right + np.where(least[k][right] > own, 1 << k, 0)
    return left - shift, np.minimum(right - shift, size)


def branching_squares(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All (i, l) with LCP(i, i + l) = l: squares of 2 * l symbols that the next symbol ends."""
    isa = levels[-1]
    suffixes = np.empty(len(isa), np.int64)
    suffixes[isa] = np.arange(len(isa))
    lcp = common_prefixes(levels, suffixes)
    at = np.flatnonzero(lcp)
    if not len(at):
        return at, at
    left, right = _parts(lcp, at)
    before = at - left <= right - at
    count = np.where(before, at - left, right - at)
    asked = suffixes[spans(np.where(before, left, at), count)]
    low = np.repeat(np.where(before, at, left), count)
    high = np.repeat(np.where(before, right, at), count)
    depth = np.repeat(lcp[at], count)
    after = isa[asked + depth]
    hit = (after >= low) & (after < high)
    earlier = asked - depth
    ahead = isa[np.maximum(earlier, 0)]
    hit_ahead = (earlier >= 0) & (ahead >= low) & (ahead < high)
    return (
        np.concatenate([asked[hit], earlier[hit_ahead]]),
        np.concatenate([depth[hit], depth[hit_ahead]]),
    )


def find_runs(
    codes: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and least period of the runs in sequences that stand one after the other.

    codes: small integers, lengths[d] of them in sequence d. Runs have min_length symbols and two
    periods at least; they come by begin, then by period.
    """
    # Each sequence has symbols of its own, its end among them.
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    kinds = int(codes.max(initial=0)) + 2
    symbols = owner * kinds
    own = np.ones(len(owner), bool)
    own[np.cumsum(lengths + 1) - 1] = False
    symbols[own] += codes + 1
    if not len(symbols):
        return (symbols,) * 3
    levels = rank_levels(symbols)
    begin, period = branching_squares(levels)
    end = begin + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        back = begin - (1 << k)
        safe = np.maximum(back, 0)
        same = (back >= 0) & (levels[k][safe] == levels[k][safe + period])
        begin = np.where(same, back, begin)
    long = end - begin >= min_length
    begin, end, period = begin[long], end[long], period[long]
    order = np.lexsort((period, end, begin))
    begin, end, period = begin[order], end[order], period[order]
    first = np.append(True, (begin[1:] != begin[:-1]) | (end[1:] != end[:-1]))[: len(begin)]
    begin, end, period = begin[first], end[first], period[first]
    order = np.lexsort((period, begin))
    begin, end, period = begin[order], end[order], period[order]
    return begin - owner[begin], end - owner[begin], period


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(counts)), pa.int32())


def _collapse(min_length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                yield _step(part, min_length)

    return run


def _step(part: pa.RecordBatch, min_length: int) -> pa.RecordBatch:
    flat, rows = word_lists(texts(part.column("text")), lower=False)
    lengths = np.bincount(rows, minlength=part.num_rows)
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    begin, end, period = find_runs(codes, lengths, min_length)
    edges = np.bincount(begin + period, minlength=len(codes) + 1)
    edges -= np.bincount(end, minlength=len(codes) + 1)
    stays = np.cumsum(edges)[: len(codes)] == 0
    kept = pa.ListArray.from_arrays(
        _offsets(np.bincount(rows[stays], minlength=part.num_rows)), flat.filter(pa.array(stays))
    )
    owner = rows[begin] if len(begin) else begin
    offset = np.cumsum(lengths) - lengths
    runs = pa.StructArray.from_arrays(
        [
            pa.array(begin - offset[owner], pa.int64()),
            pa.array(end - begin, pa.int64()),
            pa.array(period, pa.int64()),
        ],
        names=["start", "length", "period"],
    )
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id"),
            pa.ListArray.from_arrays(_offsets(np.bincount(owner, minlength=part.num_rows)), runs),
            pc.binary_join(kept, " "),
        ],
        names=["doc_id", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start and period) and the collapsed text.

    A run is a stretch of words with a least period q, at least min_length words and 2 * q long, that no
    neighbouring word extends. The collapsed text holds the words, one blank between them, but for
    those that stand in a run after its first q words. A text is taken whole, however long.
    Null and empty texts have no runs and collapse to an empty text. Rows equal in all columns are
    rows of their own, as are those without a doc_id; other columns are left alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_collapse(min_length), f"doc_id long, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, every tenth document by crc32 of its id made periodic from some word on.

    With h the checksum, g = h div 10 and n words: from word a = g % n on the text goes round in the
    next p = 1 + (n - a) div (3 + g % 8) words. Rows without an id or words stay as they are.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    seed = F.expr("h div 10")

    def turned(found: Column) -> Column:
        n = F.size(found).cast("long")
        begin = F.pmod(seed, n)
        period = F.lit(1).cast("long") + F.floor((n - begin) / (F.lit(3) + F.pmod(seed, F.lit(8))))
        head = F.slice(found, F.lit(1), begin.cast("int"))
        round_ = F.slice(found, (begin + 1).cast("int"), period.cast("int"))
        times = F.ceil((n - begin) / period).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(round_, times)), F.lit(1), (n - begin).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(head, tail), " "))

    hit = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    text = F.col("text").cast("string")
    return (
        docs.select("doc_id", text.alias("text"))
        .withColumn("h", checksum)
        .select(
            "doc_id",
            F.when(hit, F.coalesce(let(words(F.col("text")), turned), F.col("text")))
            .otherwise(F.col("text"))
            .alias("text"),
        )
    )


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (of equal ones the first, then that of least period; nulls without
    a run), its exponent in thousandths, and checksums of the runs and of the collapsed text."""
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")),
        )
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.l").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.expr("(1000 * longest.l) div (-longest.p)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
