from __future__ import annotations

import base64
import hashlib
import random

import corpus
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
from test_token_counts import odd_texts

from basketry.llm import byte_bpe as b

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("block", [1, 3000, b.BLOCK_BYTES])
def test_against_the_library(spark, block):
    data = corpus.rows() + [(1000 + i, x, None, None, 0) for i, x in enumerate(odd_texts())]
    data += [(5000, "x" * 30_000, None, None, 0), (5001, "<|endoftext|> a", None, None, 0)]
    own = library(b.read_ranks(PATH))
    want = []
    for r in data:
        ids = own.encode_ordinary(r[1] or "")
        sums = [",".join(map(str, ids)).encode(), (r[1] or "").encode()]
        want.append((r[0], len(ids), *(hashlib.sha256(s).hexdigest() for s in sums)))
    docs = corpus.clashing(corpus.table(spark, data))
    both = b.round_trip(docs, PATH, public_tokenizers.PATTERN, block)
    assert corpus.collected(b.round_trip_digest(both)) == sorted(want, key=repr)
    ids = b.encode(docs, PATH, public_tokenizers.PATTERN, block)
    assert corpus.collected(b.decode(ids, PATH)) == corpus.collected(both)


def test_every_character(tmp_path):
    """White space, letters and numbers of all planes are cut as the library cuts them."""
    own = library(b.read_ranks(PATH))
    texts = [f"a{chr(x)}b 1{chr(x)}{chr(x)} {chr(x)}x\n{chr(x)}" for x in [*range(1, 0xD800), *range(0xE000, 0x11000)]]
    pattern = regex.compile(b.own_spaces(public_tokenizers.PATTERN))
    (got,) = b.encode_texts(b.vocabulary_of(PATH), pattern, [pa.array(texts)])
    assert got.to_pylist() == own.encode_ordinary_batch(texts)


def test_any_ranks_go_by_the_definition():
    """Vocabularies no training would give: a longer token may rank before its parts."""
    rng = random.Random(4)
    seen_again = 0
    for _ in range(60):
        tokens = {bytes([i]) for i in range(256)}
        while len(tokens) < 256 + 40:
            tokens.add(bytes(rng.choices(b"abc", k=rng.randint(2, 6))))
        order = sorted(tokens, key=lambda t: (len(t) > 1, rng.random()))
        ranks = {t: i for i, t in enumerate(order)}
        vocabulary = b.Vocabulary(ranks)
        words = [bytes(rng.choices(b"abcz", k=rng.randint(1, 24))) for _ in range(60)] + [b"a" * 40]
        replay = b.Replay(vocabulary, pa.array(words, pa.binary()))
        tokens, counts = replay.run()
        seen_again += len(replay.again)
        want = [vocabulary.by_least_rank(w) for w in words]
        assert tokens.tolist() == [x for w in want for x in w]
        assert counts.tolist() == [len(w) for w in want]
    assert seen_again


def test_file_of_ranks(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(bytes([i])) + b" %d\n" % i for i in range(256)) + b"\n")
    assert b.read_ranks(str(path))[b"\x07"] == 7


def test_nothing(spark):
    assert b.round_trip_digest(b.decode(b.encode(corpus.empty(spark), PATH, public_tokenizers.PATTERN), PATH)).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [tuple(r) for r in b.decode(nulls, PATH).collect()] == [(1, [], b"")]
