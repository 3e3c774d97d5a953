import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import brute
from pixwave.llm import substring_dedup as S
from pixwave.llm import words as W

import numpy as np


def shared_texts(seed=3, length=35):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "日本", "a,b"]
    text = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, short = text(length + 6), text(length - 1)
    docs = [text(r.randint(0, 120)) for _ in range(12)]
    for d in (1, 4, 7, 9):
        at = r.randint(0, len(docs[d]))
        docs[d][at:at] = passage[r.randint(0, 3):]
    docs[2] += short
    docs[3] += short
    docs[5] = docs[5] + docs[5]
    docs.append(list(docs[4]))  # an exact copy
    docs.append(["x"] * 90)  # windows that overlap their own copies
    joins = [" ", "\n", "\t ", "  "]
    return ["".join(w + r.choice(joins) for w in d) for d in docs]


def check(rows, texts, length):
    want = []
    for w, gone in brute.kept_words(texts, length):
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    assert rows == want


@pytest.mark.parametrize("block_bytes,length,period,cover", [(300, 35, 21, (3, 6, 7, 12, 14)), (1 << 20, 35, 21, (3, 6, 7, 12, 14)),
                                                              (100, 20, 13, (0, 1, 3, 9)), (700, 8, 7, (1, 2, 4))])
def test_brute_force(spark, block_bytes, length, period, cover):
    texts = shared_texts(length=length)
    df = brute.messy(spark, texts).repartition(3)
    out = S.substring_dedup(df, length=length, period=period, cover=cover, block_bytes=block_bytes, buckets=5)
    got = out.collect()
    given_rows = df.select("doc_id", "text").collect()
    assert len(got) == len(given_rows)
    assert set(out.columns) == set(df.columns) | {"n_removed", "kept_sha256", "kept_text"}
    texts = [r.text for r in got]
    assert sorted(str(t) for t in texts) == sorted(str(r.text) for r in given_rows)
    check([(r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got], texts, length)


def test_other_columns_and_stage(spark):
    texts = shared_texts()
    df = brute.messy(spark, texts)
    out = S.pipeline_stage(spark, df, None)
    assert out.columns == df.columns and out.count() == df.count()
    rows = {(r.doc_id, r.lang, r["odd name"], r.text) for r in out.collect()}
    assert (len(texts), None, None, None) in rows  # a null text stays null
    assert any(r[0] == 6 and r[2] == "o" for r in rows)


def test_empty_table(spark):
    out = S.substring_dedup(brute.empty(spark))
    assert out.count() == 0 and "kept_sha256" in out.columns


def test_very_long_text(spark):
    r = random.Random(1)
    body = " ".join(str(r.randint(0, 10**9)) for _ in range(150_000))  # over a segment, beside one word of a megabyte
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [body + " " + passage, passage, "y" * (1 << 20) + " z", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.n_words, x.n_removed) for x in S.substring_dedup(df, keep_text=False).collect()}
    assert got == {0: (150_040, 40), 1: (40, 40), 2: (2, 0), 3: (0, 0)}


def test_cover_is_checked(spark):
    with pytest.raises(ValueError):
        S.substring_dedup(brute.empty(spark), period=21, cover=(0, 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\xa0é", max_size=30), min_size=1, max_size=5))
def test_words_are_those_of_the_pattern(texts):
    data = [t.encode() for t in texts]
    hashes, begin = W.hash_words(data, b"some key")
    expect = [w for t in data for w in brute.WORD.findall(t)]
    assert np.diff(begin).tolist() == [len(brute.WORD.findall(t)) for t in data]
    same = {}
    for w, h in zip(expect, map(tuple, hashes.tolist())):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)


@pytest.mark.parametrize("size", [32, 64, 1024, 2048, 4096])
def test_words_that_powers_of_a_base_can_not_tell_apart(spark, size):
    # letters in the order of the parity of the ones of their place, and the other way round
    order = [bin(i).count("1") % 2 for i in range(size)]
    odd, other = ("".join(pair[x] for x in order) for pair in ("ab", "ba"))
    same = " ".join(f"w{i}" for i in range(34))
    df = spark.createDataFrame([(1, f"{odd} {same}"), (2, f"{other} {same}")], "doc_id long, text string")
    assert [r.n_removed for r in S.substring_dedup(df).collect()] == [0, 0]
    again = df.union(spark.createDataFrame([(3, f"x {odd} {same}")], "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in S.substring_dedup(again).collect()} == {1: 35, 2: 0, 3: 35}


def test_hashes_follow_bytes_alone():
    r = np.random.default_rng(7)
    words = [bytes(r.choice(list(b"abAB\xc3"), n).astype(np.uint8)) for n in [*range(1, 80), *range(1, 80), 500, 500] for _ in range(4)]
    data = np.frombuffer(b" ".join([*words, *words[::-1]]), np.uint8)
    h = W.span_hashes(data, *W.spans(data), b"k", 2)
    assert (h[:len(words)] == h[len(words):][::-1]).all()
    for side in (0, 1):
        assert len(set(h[:, side].tolist())) == len(set(words))
    assert not set(h[:, 0].tolist()) & set(W.span_hashes(data, *W.spans(data), b"l").tolist())
