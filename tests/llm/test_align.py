import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import brute
from pixwave.llm import align
from test_tokens import odd_texts

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    SPEC = f.read()
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    MODEL = f.read()
A = Tokenizer.from_str(SPEC)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
CODE = {c: b for b, c in enumerate(align.byte_characters())}
EXTRA = ["▁", "a ▁ b", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "naïve café\nÉté. Öl", "x\n\ny \n z", "日本語 テキスト", "🙂🙃 👩‍👩‍👧", "don't we'll\nIt's",
         "tab\there", "a\0b", "ends ", " begins", "\n", "Ünïcödé,\nß.", "п р и вет мир.\nДа", "a" * 3000, "é" * 2000, "one two " * 4000]


def whole(text):
    """Ids and byte ends of both sides by encoding the whole text, or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False)
    b = B.encode(text, return_type=str)
    bytes_a = [bytes(CODE[c] for c in t) for t in a.tokens]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in b]
    raw = (" " + text).encode()
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return None
    return a.ids, np.cumsum([*map(len, bytes_a)]).tolist(), B.encode(text), np.cumsum([*map(len, bytes_b)]).tolist()


def brute_force(texts):
    """Per text: n_a, n_b, groups, links."""
    out = []
    for t in texts:
        found = whole(t)
        if found is None:
            out.append((0, 0, "", []))
            continue
        ia, ea, ib, eb = found
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            k, m = i, j
            while k < len(ea) and ea[k] <= cut:
                k += 1
            while m < len(eb) and eb[m] <= cut:
                m += 1
            groups.append(",".join(map(str, ia[i:k])) + "|" + ",".join(map(str, ib[j:m])))
            links += [(x, y) for x, e in zip(ia[i:k], ea[i:k]) for y, g in zip(ib[j:m], eb[j:m]) if e == g]
            i, j = k, m
        out.append((len(ia), len(ib), ";".join(groups), links))
    return out


def expected(texts):
    found = brute_force(texts)
    count = Counter(x for _, _, _, links in found for x in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(na, nb, g.count(";") + 1 if g else 0, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), g) for na, nb, g, links in found]


def digest(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


@pytest.mark.parametrize("kept", [5, 200_000])
def test_groups_are_those_of_whole_texts(kept):
    tool = align.Aligner(SPEC, MODEL)
    tool.units.kept = kept
    texts = odd_texts(150) + EXTRA
    for _ in range(2):  # the second time from what is kept
        assert [g.decode() for g in tool.groups(*tool.texts(texts))] == [w[2] for w in brute_force(texts)]


def test_any_text():
    tool, r = align.Aligner(SPEC, MODEL), random.Random(2)
    pool = ["the", "é", "\n", ".", " ", "Ab", "'s", "1", "_", "-", "ö", "日", "\t", "\x85", "|"]

    @given(st.one_of(st.text(max_size=40), st.builds(lambda n: "".join(r.choice(pool) for _ in range(n)), st.integers(0, 25))))
    @settings(max_examples=400, deadline=None)
    def holds(text):
        assert tool.groups(*tool.texts([text, "x " + text])) == [w[2].encode() for w in brute_force([text, "x " + text])]

    holds()


def test_refined_ends():
    # one exact token, two that share a three-byte character, then an exact one
    lengths, begin, end = (np.array(x) for x in ([2, 1, 2, 3], [0, 2, 2, 5], [2, 5, 5, 8]))
    assert align.refined(lengths, begin, end).tolist() == [2, 3, 5, 8]


@pytest.mark.parametrize("block_bytes", [300, 1 << 23])
def test_tables(spark, block_bytes):
    df = brute.messy(spark, odd_texts(80) + EXTRA).repartition(3)
    got = align.align_tokens(df, SPEC, MODEL, keep=["doc_id", "text", "size", "block", "rank"], groups=True, block_bytes=block_bytes).collect()
    want = {t: w for t, w in zip([r.text for r in got], expected([r.text for r in got]))}
    assert len(got) == df.count() and sum(r.doc_id is None for r in got) == 1
    for r in got:
        w = want[r.text]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == w and r.groups_sha256 == digest(w[6])


def test_empty_table_and_refusals(spark):
    out = align.align_tokens(brute.empty(spark), SPEC, MODEL)
    assert out.count() == 0 and out.columns == ["doc_id", *align.COUNTS, "groups_sha256"]
    nothing = align.align_tokens(spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string"), SPEC, MODEL).collect()
    assert sorted(tuple(r) for r in nothing) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
    with pytest.raises(ValueError):
        align.align_tokens(brute.empty(spark).withColumnRenamed("lang", "N_best"), SPEC, MODEL, keep=["N_best"])
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        align.Aligner(f.read(), MODEL)


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in align.op12_query(spark, sf_dir).collect()}
    assert got == {d.doc_id: (*w[:6], digest(w[6])) for d, w in zip(docs, expected([d.text for d in docs]))}
