"""Near-duplicates by SimHash fingerprints, found around the anchors of a covering code.

The anchors are all pairs of codewords of the perfect binary Golay code, one for each of two
runs of 23 bits of the fingerprint; each run is within 3 bits of exactly one
codeword, so the anchors cover all fingerprints at a radius of 3 + 3. Two
fingerprints that differ in d bits have a point between them that is ceil(d/2) from each. The
anchor of that point is then within its radius plus ceil(d/2) of both, so a
fingerprint needs to be copied only to the anchors whose runs lie that much beyond the radius
in all, and both meet at one of them at least. At an anchor all bits are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import record, steps, texts
from basketry.llm.components import components
from basketry.session import written

WORDS = 4
MAX_BITS = 4
SEED = 42
RUN = 23
RADIUS = 3
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
# An anchor with more fingerprints is compared in cells of two parts of it each.
CELL_ROWS = 4096


def _fingerprint(text: bytes, size: int, bit_table: np.ndarray, offsets: np.ndarray) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
        np.uint64,
        len(starts),
    )
    # Eight histograms of bytes instead of 64 columns of bits.
    places = hashes.view(np.uint8).reshape(-1, 8) + offsets
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ bit_table
    bits = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little", signed=True)


def _fingerprints(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        table = table.astype(np.int64)
        offsets = np.arange(8, dtype=np.int64) * 256
        for batch in batches:
            for part in steps(batch):
                column = texts(part.column("text")).cast(pa.binary())
                prints = [_fingerprint(t, size, table, offsets) for t in column.to_pylist()]
                columns = [*part.columns, pa.array(prints, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = WORDS, keep_text: bool = True) -> DataFrame:
    """Every document as `doc` (without its text), `text` if kept, and its fingerprint `fp` as a long."""
    rows = record(docs).select(F.col("doc").dropFields("text").alias("doc"), "doc.text")
    schema = T.StructType([*rows.schema, T.StructField("fp", T.LongType())])
    rows = rows.mapInArrow(_fingerprints(size), schema)
    return rows if keep_text else rows.drop("text")


@cache
def _syndromes() -> np.ndarray:
    """The remainder of every 23-bit word by the generator: which coset it lies in."""
    out = np.arange(1 << RUN, dtype=np.uint32)
    for bit in range(RUN - 1, 10, -1):
        out ^= np.where((out >> bit) & 1, np.uint32(GENERATOR << (bit - 11)), np.uint32(0))
    return out.astype(np.uint16)


@cache
def _steps_beyond(reach: int) -> list[np.ndarray]:
    """Per excess 0..reach and coset: what to add to a word to get to its codewords that far.

    Excess 0: the codeword within the radius. Excess e: those at distance radius + e.
    Unused places hold -1.
    """
    syndromes = _syndromes()
    out = []
    for excess in range(reach + 1):
        weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
        patterns = np.array(
            [sum(1 << i for i in c) for w in weights for c in combinations(range(RUN), w)], np.int64
        )
        coset = syndromes[patterns]
        order = np.argsort(coset, kind="stable")
        coset, patterns = coset[order], patterns[order]
        begins = np.searchsorted(coset, np.arange(2048))
        rank = np.arange(len(coset)) - begins[coset]
        table = np.full((2048, rank.max() + 1), -1, np.int64)
        table[coset, rank] = patterns
        out.append(table)
    return out


def anchors(prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each copy of a fingerprint: its row and the anchor it goes to."""
    low = prints & ((1 << RUN) - 1)
    high = (prints >> RUN) & ((1 << RUN) - 1)
    tables, cosets = _steps_beyond(reach), _syndromes()
    rows, found = [], []
    for a in range(reach + 1):
        for b in range(reach + 1 - a):
            first, second = tables[a][cosets[low]], tables[b][cosets[high]]
            one = ((low[:, None] ^ first) << RUN)[:, :, None]
            two = (high[:, None] ^ second)[:, None, :]
            used = (first >= 0)[:, :, None] & (second >= 0)[:, None, :]
            row, *_ = np.nonzero(used)
            rows.append(row)
            found.append((one | two)[used])
    return np.concatenate(rows), np.concatenate(found)


def _replicas(reach: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False)
            for begin in range(0, len(prints), 2000):
                some = prints[begin : begin + 2000]
                rows, found = anchors(some, reach)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(some[rows])], names=["anchor", "fp"]
                )

    return run


class _Forest:
    """Union-find over the rows of a batch; the least row of a tree is its root."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        parent = self.parent
        apart = parent[left] != parent[right]
        for i, j in zip(left[apart].tolist(), right[apart].tolist(), strict=True):
            a, b = i, j
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        while apart.any() and not np.array_equal(parent, up := parent[parent]):
            parent[:] = up


def _stars(cell: np.ndarray, prints: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links of whole cells, reduced to one link per fingerprint of a linked group."""
    forest = _Forest(len(cell))
    at = np.arange(len(cell) - 1)
    offset = 1
    while len(at := at[at + offset < len(cell)]):
        at = at[cell[at] == cell[at + offset]]
        near = at[np.bitwise_count(prints[at] ^ prints[at + offset]) <= max_bits]
        forest.join(near, near + offset)
        offset += 1
    child = np.flatnonzero(forest.parent != np.arange(len(cell)))
    columns = [pa.array(prints[child].view(np.int64)), pa.array(prints[forest.parent[child]].view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _compare(max_bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, prints = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            more = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cell = np.concatenate([cell, batch.column("cell").to_numpy(zero_copy_only=False)])
            prints = np.concatenate([prints, more])
            # The last cell may go on in the next batch.
            done = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if done:
                yield _stars(cell[:done], prints[:done], max_bits)
                cell, prints = cell[done:], prints[done:]
        if len(cell):
            yield _stars(cell, prints, max_bits)

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """a, b: links between different fingerprints, as many as connect what is linked.

    prints: fp, each once. The copies of a fingerprint are dealt by anchor. An
    anchor with more than CELL_ROWS of them is cut into parts, and every two parts
    meet in a cell of their own.
    """
    copies = prints.mapInArrow(_replicas((max_bits + 1) // 2), "anchor long, fp long")
    crowded = (
        copies.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > CELL_ROWS)
        .select("anchor", F.ceil(F.col("n") * 2 / CELL_ROWS).cast("long").alias("parts"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    other = F.explode(F.expr("sequence(0L, parts - 1)"))
    dealt = copies.join(written(crowded), "anchor", "left")
    single = dealt.filter("parts is null").select(F.col("anchor").alias("cell"), "fp")
    # Negative, so never an anchor. Should two cells get one number, they are compared together.
    number = F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
    crowd = (
        dealt.filter("parts is not null")
        .select("anchor", "fp", own.alias("own"), other.alias("other"))
        .select((-F.abs(F.shiftright(number, 1)) - 1).alias("cell"), "fp")
    )
    cells = single.unionByName(crowd).repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(_compare(max_bits), "a long, b long").distinct()


def grouped(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """fp, component_id (the least doc_id reachable over links), head (the row of the one that stays).

    rows: row, doc_id, fp. Equal fingerprints are one node whatever their number.
    A component whose ids are all null has a null component_id.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head")
    nodes = written(rows.groupBy("fp").agg(first))
    roots = components(links(nodes.select("fp"), max_bits))
    nodes = nodes.join(roots.withColumnRenamed("a", "fp"), "fp", "left")
    nodes = nodes.select("fp", F.coalesce("b", "fp").alias("root"), "head")
    heads = nodes.groupBy("root").agg(F.min("head").alias("first"))
    return nodes.join(heads, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("head")
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """Written down with a number per row, which from then on names the row."""
    return written(
        rows.withColumn("row", F.monotonically_increasing_id()).withColumn("doc_id", F.col("doc.doc_id"))
    )


def near_duplicates(docs: DataFrame, size: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id of every document; repeated rows are rows of their own.

    Texts without words, null ones included, have fingerprint zero and are linked like others.
    """
    rows = _numbered(fingerprints(docs.select("doc_id", "text"), size, keep_text=False))
    groups = grouped(rows.select("row", "doc_id", "fp"), max_bits)
    return rows.select("doc_id", "fp").join(groups, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, size: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with the least doc_id, with all its columns."""
    rows = _numbered(fingerprints(docs, size))
    groups = grouped(rows.select("row", "doc_id", "fp"), max_bits)
    heads = groups.select(F.col("head").alias("row")).distinct()
    kept = rows.join(heads, "row", "left_semi")
    return kept.select(
        *(F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns)
    )
