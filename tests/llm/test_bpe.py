import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import brute
from pixwave.llm import bpe, parts
from test_tokens import odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def spec():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(spec):
    return Tokenizer.from_str(spec)


def naive_merge(codec, word):
    """Merge the pair of least rank, leftmost first, until none is left."""
    symbols = [codec.first[b] for b in word]
    while True:
        found = [(codec.rank[a << 32 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 32 | b in codec.rank]
        if not found:
            return symbols
        r, i = min(found)
        symbols[i:i + 2] = [codec.made[r]]


def test_merges_are_those_of_a_plain_search(spec):
    codec, r = bpe.codec(spec), random.Random(3)
    for _ in range(300):
        word = bytes(r.choice(b" theinganoder\xc3\xa9\xf0") for _ in range(r.randint(1, 40)))
        assert codec.merge(word) == naive_merge(codec, word)


@pytest.mark.parametrize("kept", [3, 200_000])
def test_ids_are_those_of_the_library(spec, library, kept):
    codec = bpe.Codec(spec)
    codec.units.kept = kept
    texts = odd_texts() + ["<|endoftext|>", " <|endoftext|>  x", "a<|endoftext|><|endoftext|> b", "", "it's we'LL don't 'tis", "x" * 20_000, "é" * 5000]
    ids = codec.encode(texts)
    assert codec.encode(texts) == ids  # from what is kept
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [w.ids for w in want]
    assert codec.decode([np.frombuffer(i, "<u4") for i in ids]).to_pylist() == [library.decode(w.ids, skip_special_tokens=False) for w in want] == texts


def test_any_text(spec, library):
    own = bpe.codec(spec)

    @given(st.text(max_size=60))
    @settings(max_examples=300, deadline=None)
    def holds(text):
        ids = np.frombuffer(own.encode([text])[0], "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.decode([ids]).to_pylist() == [text]

    holds()


def test_decoding_of_any_ids(spec, library):
    r = random.Random(5)
    lists = [[r.randrange(50257) for _ in range(r.randint(0, 30))] for _ in range(300)] + [[50256, 50300, 1]]
    assert bpe.codec(spec).decode([np.array(i) for i in lists]).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in lists]


def test_tables(spark, spec, library):
    df = brute.messy(spark, odd_texts(60)).repartition(3)
    plain = bpe.encode(df.withColumnRenamed("odd name", "odd_name"), spec, keep=["doc_id", "text", "n_words", "odd_name"], batch_bytes=300)
    done = bpe.decode(plain, spec).collect()
    assert len(done) == df.count() and sum(r.doc_id is None for r in done) == 1
    for r in done:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded == (r.text or "")
    packed = bpe.decode(bpe.encode(df, spec, keep=["text"], packed=True), spec, batch_bytes=50).collect()
    assert sorted((r.text or "", bytes(r.ids)) for r in packed) == sorted((r.text or "", np.array(r.ids, "<u4").tobytes()) for r in done)


def test_null_and_empty_ids(spark, spec):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [50256, None]), (4, [-1, 99999])], "decoded_id int, ids array<int>")
    assert [(r.decoded_id, r.decoded) for r in bpe.decode(rows, spec).collect()] == [(1, None), (2, ""), (3, "<|endoftext|>"), (4, "")]


def test_decoding_takes_each_column_once(spark, spec):
    rows = spark.createDataFrame([(1, [31373], [1]), (2, [], [2])], "a int, `ids` array<int>, `odd.name` array<int>")
    for ids in ("ids", "odd.name"):
        out = bpe.decode(rows, spec, ids=ids)
        taken = out._jdf.queryExecution().optimizedPlan().children().head().output().size()
        assert taken == len(rows.columns)
        assert [len(r.decoded) > 0 for r in out.orderBy("a").collect()] == [True, ids == "odd.name"]


def test_encoder_keeps_no_second_vocabulary(spec):
    own = bpe.Codec(spec)
    assert type(own.cut.__self__).__name__ == "ByteLevel" and bpe.BATCH_BYTES <= 1 << 20
    texts = odd_texts() + ["it's  we'LL\u00a0x\n\n y", "\u4e2d\u6587 \U0001f600!!"]
    cut = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
    assert [own.cut(t) for t in texts if t] == [cut(t) for t in texts if t]


def test_empty_table_and_refusals(spark, spec):
    out = bpe.decode(bpe.encode(brute.empty(spark), spec), spec)
    assert out.count() == 0 and out.columns == ["doc_id", "ids", "n_tokens", "decoded"]
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.Codec(f.read())
    with pytest.raises(ValueError):
        bpe.encode(brute.empty(spark).withColumnRenamed("lang", "Ids"), spec, keep=["Ids"])
    with pytest.raises(ValueError):
        bpe.decode(brute.empty(spark).withColumnRenamed("lang", "decoded"), spec, ids="doc_id")


def test_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in bpe.op13_query(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id][1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_parts_join_to_their_text():
    texts = [t for t in odd_texts(100)] + ["", " ", "a b", " a", "a ", "a  b c"]
    names, number, begin = parts.numbered(texts)
    names = names.to_pylist()
    for i, t in enumerate(texts):
        assert " ".join(names[k] for k in number[begin[i]:begin[i + 1]]) == t
        assert split_or_whole(t) == [names[k] for k in number[begin[i]:begin[i + 1]]]


def split_or_whole(text):
    return text.split(" ") if parts.is_plain(text) and text else parts.split_parts(text)
