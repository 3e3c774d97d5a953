import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_helpers import brute
from pixwave.llm import token_counts as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "1", "23", "!", ",", "<|endoftext|>", "\xa0", " ", "　", "​",
            "\x1c", "\x85", "﻿", "日本", "🙂", " the", "\r\n", "\x0b", "\x0c", "_", "٣", "Ⅷ", "́", "᠎", "\x00", "'", " '", "’s"]


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


def odd_texts(n=400):
    r = random.Random(1)
    plain = ALPHABET[:14] + ALPHABET[23:24] * 3
    pick = lambda a: "".join(r.choice(a) for _ in range(r.randint(0, 30)))
    return [pick(ALPHABET) for _ in range(n)] + [pick(plain) for _ in range(n)] + ["long " * 50_000, "z" * 3000]


@pytest.mark.parametrize("block_bytes", [200, 1 << 23])
def test_counts_are_those_of_the_library(spark, spec, block_bytes):
    df = brute.messy(spark, odd_texts()).repartition(3)
    got = C.token_counts(df, spec, keep=["doc_id", "text", "lang"], buckets=7, block_bytes=block_bytes).collect()
    library = Tokenizer.from_str(spec)
    assert len(got) == df.count()
    for r in got:
        t = r.text or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 512)
    assert sum(r.doc_id is None for r in got) == 1


def test_empty_table(spark, spec):
    out = C.token_counts(brute.empty(spark), spec)
    assert out.count() == 0 and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_refuses_what_it_cannot_count(spark, spec):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        with pytest.raises(ValueError):
            C.token_counts(brute.empty(spark), f.read())
    with pytest.raises(ValueError):
        C.token_counts(brute.empty(spark).withColumnRenamed("lang", "n_tokens"), spec, keep=["n_tokens"])
