"""Byte-level BPE: encodes texts by replaying all merges over a corpus block, and decodes ids.

The documents of a block are cut into pre-tokens, and of those each different one is taken once. Over
the bytes of all of them an index says at which places a pair of neighbouring tokens merges to the
token of a rank. The merges are then replayed in rank order: the places of a rank merge at
once, and only the pairs their neighbours now make are looked up and entered again.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import steps, texts
from basketry.llm.periodic_runs import spans

# Unicode's white space, which is the pattern's.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters only, so a pre-token by itself.
PLAIN = "^ ?[A-Za-zÀ-ÖØ-öø-ÿ]+$"
# Text of a block: what is replayed together.
BLOCK_BYTES = 8 << 20
# Text that is cut into stretches at a time: little enough for a processor's cache.
STEP_BYTES = 1 << 20


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that makes up a third."""

    def __init__(self, tokens: dict[bytes, int]):
        self.ranks = tokens
        self.size = max(tokens.values()) + 1
        self.by_byte = np.array([tokens[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * (self.size + 1) + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.tokens = pa.array(list(tokens), pa.binary())
        self.token_ranks = np.array(list(tokens.values()), np.int64)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, -1 if none. `size` is a token that pairs with nothing."""
        key = left.astype(np.int64) * (self.size + 1) + right
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return np.full(len(key), -1)
        return np.where(self.keys[at] == key, self.merged[at], -1)

    def by_least_rank(self, word: bytes) -> list[int]:
        """The definition: as long as there is one, the leftmost pair of least rank merges."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            found = [
                (rank, i)
                for i in range(len(parts) - 1)
                if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None
            ]
            if not found:
                return [self.ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a token in base64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    """The file's vocabulary; a worker that runs several tasks reads it once."""
    return Vocabulary(read_ranks(path))


class Replay:
    """The merges replayed in rank order over many words at once."""

    def __init__(self, vocabulary: Vocabulary, words: pa.BinaryArray):
        self.vocabulary = vocabulary
        self.words = words
        # A slot after each word, and one before the first, holds the token that pairs with nothing.
        body, sizes = _bytes(words)
        self.begins = np.cumsum(sizes + 1) - sizes
        taken = spans(self.begins, sizes)
        self.token = np.full(1 + int((sizes + 1).sum()), vocabulary.size, np.int32)
        self.token[taken] = vocabulary.by_byte[body]
        self.next = np.arange(1, len(self.token) + 1, dtype=np.int32)
        self.previous = np.arange(-1, len(self.token) - 1, dtype=np.int32)
        self.rank = np.full(len(self.token), -1, np.int32)
        self.index: dict[int, list[np.ndarray]] = {}
        self.again: set[int] = set()
        self._enter(taken.astype(np.int32), -1)

    def _enter(self, places: np.ndarray, current: int) -> None:
        """Looks up the pairs that begin at the places and enters them under their ranks."""
        ranks = self.vocabulary.of_pairs(self.token[places], self.token[self.next[places]])
        self.rank[places] = ranks
        self._check(places, ranks, current)
        fit = ranks > current
        places, ranks = places[fit], ranks[fit]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *edges.tolist(), len(ranks)] if len(ranks) else [0]
        for begin, end in zip(starts, starts[1:], strict=False):
            self.index.setdefault(int(ranks[begin]), []).append(places[begin:end])

    def _check(self, places: np.ndarray, ranks: np.ndarray, current: int) -> None:
        """Words with a pair that would have merged before the current rank go by the definition."""
        early = (ranks >= 0) & (ranks < current)
        if early.any():
            self.again.update(np.searchsorted(self.begins, places[early], side="right").tolist())

    def _merge(self, rank: int) -> None:
        entered = self.index.pop(rank)
        places = np.unique(np.concatenate(entered))
        places = places[self.rank[places] == rank]
        if len(places) > 1:
            overlap = self.next[places[:-1]] == places[1:]
            if overlap.any():
                # Of places that overlap the leftmost merges, then the next that is still free.
                turn = np.arange(len(places))
                begin = np.maximum.accumulate(np.where(np.append(False, overlap), 0, turn))
                places = places[(turn - begin) % 2 == 0]
        if not len(places):
            return
        gone = self.next[places]
        after = self.next[gone]
        meets = after[:-1][after[:-1] == places[1:]]
        if len(meets):
            # One by one, a merge would for a moment stand before what the next one is made of.
            self._check(meets, self.vocabulary.of_pairs(np.full(len(meets), rank, np.int32), self.token[meets]), rank)
        self.token[places] = rank
        self.rank[gone] = -1
        self.token[gone] = -1
        self.next[places] = after
        self.previous[after] = places
        touched = np.concatenate([self.previous[places], places])
        self._enter(touched, rank)

    def run(self) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in order, and how many each word has."""
        for rank in range(self.vocabulary.size):
            if rank in self.index:
                self._merge(rank)
        real = (self.token >= 0) & (self.token < self.vocabulary.size)
        counts = np.add.reduceat(real, self.begins) if len(self.begins) else np.zeros(0, np.int64)
        tokens = self.token[real]
        if not self.again:
            return tokens, counts.astype(np.int64)
        ends = np.cumsum(counts)
        lists = [tokens[e - c : e] for e, c in zip(ends, counts, strict=True)]
        for number in self.again:
            lists[number - 1] = np.array(self.vocabulary.by_least_rank(self.words[number - 1].as_py()))
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, one after the other, and how many each has."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    if values.buffers()[2] is None or not len(values):
        return np.zeros(0, np.uint8), np.diff(offsets).astype(np.int64)
    body = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return body, np.diff(offsets).astype(np.int64)


def encode_words(vocabulary: Vocabulary, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all words in order, and how many each word has. A word that is a token is that one."""
    found = pc.index_in(words, value_set=vocabulary.tokens)
    whole = vocabulary.token_ranks[pc.fill_null(found, 0).to_numpy()]
    known = pc.is_valid(found).to_numpy(zero_copy_only=False)
    open_ = np.flatnonzero(~known)
    tokens, counts = Replay(vocabulary, words.take(pa.array(open_))).run()
    lengths = np.ones(len(words), np.int64)
    lengths[open_] = counts
    ids = np.empty(int(lengths.sum()), np.int64)
    begins = np.cumsum(lengths) - lengths
    ids[begins[known]] = whole[known]
    ids[spans(begins[open_], counts)] = tokens
    return ids, lengths


# The white space beyond ASCII, as UTF-8 and by its first byte.
WIDE_SPACE = {
    0xC2: [b"\x85", b"\xa0"],
    0xE1: [b"\x9a\x80"],
    0xE2: [*(bytes([0x80, b]) for b in range(0x80, 0x8B)), b"\x80\xa8", b"\x80\xa9", b"\x80\xaf", b"\x81\x9f"],
    0xE3: [b"\x80\x80"],
}


def _space_bytes(body: np.ndarray) -> np.ndarray:
    """Of each byte whether it belongs to white space."""
    space = (body == 0x20) | ((body >= 0x09) & (body <= 0x0D))
    for lead, tails in WIDE_SPACE.items():
        places = np.flatnonzero(body == lead)
        width = len(tails[0])
        tail = sum(body[places + 1 + k].astype(np.int64) << (8 * (width - 1 - k)) for k in range(width))
        places = places[np.isin(tail, [int.from_bytes(t) for t in tails])]
        for k in range(width + 1):
            space[places + k] = True
    return space


def _stretches(bodies: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Stretches of the texts that pre-tokens never cross, and how many each text has.

    A stretch is a word with the one blank before it, the white space up to its last character
    before a word, or that character if it is not a blank.
    """
    body, sizes = _bytes(bodies)
    ends = np.cumsum(sizes)
    if not len(body):
        return pa.array([], pa.string()), np.zeros(len(bodies), np.int64)
    space = _space_bytes(body)
    first = np.zeros(len(body) + 1, bool)
    first[ends - sizes] = True
    after_space = np.append(False, space[:-1]) & ~first[:-1]
    after_blank = np.append(False, body[:-1] == 0x20)
    begins = first[:-1] | (space & ~after_space) | (~space & after_space & ~after_blank)
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:-1])
    for _ in range(2):  # back to the character's first byte
        last -= (body[last] & 0xC0) == 0x80
    begins[last] = True
    starts = np.flatnonzero(begins)
    edges = pa.py_buffer(np.append(starts, len(body)).astype(np.int32))
    cut = pa.StringArray.from_buffers(len(starts), edges, pa.py_buffer(body))
    return cut, np.diff(np.searchsorted(starts, np.append(0, ends)))


def pre_tokens(found: pa.StringArray, pattern: regex.Pattern) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different pre-tokens of the stretches, their numbers one after the other, and how many each stretch has."""
    plain = pc.match_substring_regex(found, PLAIN)
    others = found.filter(pc.invert(plain)).to_pylist()
    cut = [pattern.findall(s) for s in others]
    simple = plain.to_numpy(zero_copy_only=False)
    counts = np.ones(len(found), np.int64)
    counts[~simple] = [len(c) for c in cut]
    whole = found.filter(plain)
    coded = pa.concat_arrays([whole, pa.array([x for c in cut for x in c], pa.string())]).dictionary_encode()
    numbers = coded.indices.to_numpy()
    ordered = np.empty(len(numbers), np.int64)
    begins = np.cumsum(counts) - counts
    ordered[begins[simple]] = numbers[: len(whole)]
    ordered[spans(begins[~simple], counts[~simple])] = numbers[len(whole) :]
    return coded.dictionary, ordered, counts


def encode_texts(
    vocabulary: Vocabulary, pattern: regex.Pattern, parts: list[pa.StringArray]
) -> Iterator[pa.ListArray]:
    """The ids of each text, part by part; the different pre-tokens of all parts are encoded together."""
    cuts = [_stretches(bodies) for bodies in parts]
    per_part = [counts for _, counts in cuts]
    coded = pa.concat_arrays([found for found, _ in cuts]).dictionary_encode()
    del cuts
    codes = coded.indices.to_numpy()
    names, pieces, counts = pre_tokens(coded.dictionary, pattern)
    ids, lengths = encode_words(vocabulary, names.cast(pa.binary()))
    ids, lengths = _gathered(ids.astype(np.int32), lengths, pieces, counts)
    begin = 0
    for per_text in per_part:
        end = begin + int(per_text.sum())
        tokens, n_tokens = _gathered(ids, lengths, codes[begin:end], per_text)
        begin = end
        offsets = pa.array(np.append(0, np.cumsum(n_tokens)), pa.int32())
        yield pa.ListArray.from_arrays(offsets, pa.array(tokens))


def _gathered(
    flat: np.ndarray, lengths: np.ndarray, pick: np.ndarray, groups: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The lists (flat, by lengths) that are picked, one after the other, and the length of each group of picks."""
    begins = np.cumsum(lengths) - lengths
    each = lengths[pick] if len(pick) else np.zeros(0, np.int64)
    ends = np.append(0, np.cumsum(each))
    last = np.cumsum(groups)
    return flat[spans(begins[pick] if len(pick) else each, each)], ends[last] - ends[last - groups]


def own_spaces(pattern: str) -> str:
    """The pattern with Unicode's white space spelt out, as libraries differ in it."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]")


def _encode(path: str, pattern: str, block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        compiled = regex.compile(own_spaces(pattern))

        def encoded(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bodies = [texts(part.column("text")) for part in parts]
            for part, ids in zip(parts, encode_texts(vocabulary, compiled, bodies), strict=True):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

        block: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for part in steps(batch, most=STEP_BYTES):
                block.append(part)
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= block_bytes:
                    yield from encoded(block)
                    block, size = [], 0
        if block:
            yield from encoded(block)

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id and ids (array of int) of every row.

    path: a file of ranks, which the executors have. pattern: what cuts a text into pre-tokens; it must not
    join a blank stretch and the words behind it, as is usual. Null and empty texts have no ids. Strings of special
    tokens are ordinary text. Texts of any length are encoded whole, repeated rows each; null ids
    stay, and other columns are left alone.
    """
    return _texts(docs).mapInArrow(_encode(path, pattern, block_bytes), "doc_id long, ids array<int>")


def _decode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        table: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        flat = np.frombuffer(b"".join(table), np.uint8)
        lengths = np.array([len(t) for t in table], np.int64)
        for batch in batches:
            lists = batch.column("ids")
            counts = np.diff(lists.offsets.to_numpy())
            body, sizes = _gathered(flat, lengths, lists.flatten().to_numpy(), counts.astype(np.int64))
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
            whole = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lists), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, whole.cast(pa.binary())], names=["doc_id", "ids", "decoded"]
            )

    return run


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the bytes they stand for; no ids, and null ones, stand for no bytes."""
    filled = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return rows.select("doc_id", filled).mapInArrow(_decode(path), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids and decoded as `encode` and then `decode` give them, in one Python worker per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decode(path)(_encode(path, pattern, block_bytes)(batches))

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def round_trip_digest(rows: DataFrame) -> DataFrame:
    """doc_id, the number of ids, and checksums of the ids and of what they decode to."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
