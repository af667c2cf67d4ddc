from __future__ import annotations

import random

import corpus
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketry.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPACES = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200C), 0x2028, 0x202F, 0x3000, 0xFEFF]]
OTHERS = ["a", "é", "1", "²", "'s", "'ll", "'", "!", "<|endoftext|>", "<|", "日本", "ñ", "́", "-", "٠", "ª", "the"]


def odd_texts(seed=0, count=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(SPACES if rng.random() < 0.45 else OTHERS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


@pytest.mark.parametrize("remembered", [3, 1_000_000])
def test_against_the_library(spark, monkeypatch, remembered):
    monkeypatch.setattr(t, "REMEMBERED", remembered)
    monkeypatch.setattr(t, "STEP_ROWS", 100)
    data = corpus.rows() + [(1000 + i, x, None, None, 0) for i, x in enumerate(odd_texts())]
    data += [(5000, "x" * 30_000, None, None, 0), (5001, "<|endoftext|>" * 3 + " a", None, None, 0)]
    library = Tokenizer.from_file(PATH)
    expected = [
        (r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in data
    ]
    got = t.token_counts(corpus.clashing(corpus.table(spark, data)), PATH)
    assert corpus.collected(got) == sorted(expected, key=repr)


def test_no_documents(spark):
    assert t.token_counts(corpus.empty(spark), PATH).collect() == []
