import random

import numpy as np
import pytest
import xxhash

from llm_helpers import brute
from pixwave.llm import simhash_dedup as S
from pixwave.llm.components import components


def plain_fingerprint(text, shingle):
    words = brute.words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    pieces = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(seed=5):
    r = random.Random(seed)
    out = []
    for _ in range(8):
        base = [r.choice("abcdefghijklmnop") * r.randint(1, 4) for _ in range(200)]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(200)] = r.choice(["X", "y", "É"])
            out.append(" ".join(copy))
    return out + ["one two", "ONE two", "one two three four", ""]


@pytest.mark.parametrize("crowd", [2048, 2])
def test_brute_force(spark, crowd):
    df = brute.messy(spark, near_texts())
    got = S.simhash_groups(df, crowd=crowd).collect()
    rows = df.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    prints = [plain_fingerprint(r.text, 4) for r in rows]
    root = brute.components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for r, g in zip(rows, root):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), f, str(least.get(g))) for r, f, g in zip(rows, prints, root))
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == want


def test_survivors(spark):
    df = brute.messy(spark, near_texts())
    out = S.pipeline_stage(spark, df, None)
    assert out.columns == df.columns
    rows = df.select("doc_id", "text").collect()
    root = brute.components([plain_fingerprint(r.text, 4) for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    best = {}
    for r, g in zip(rows, root):
        key = (r.doc_id is None, r.doc_id)
        if g not in best or key < best[g]:
            best[g] = key
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for _, i in best.values())


def test_empty_table(spark):
    assert S.simhash_groups(brute.empty(spark)).count() == 0
    assert S.survivors(brute.empty(spark)).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_difference(radius):
    r = np.random.default_rng(radius)
    masks = [S.kept_bits((v,), radius) for v in range(1, 1 << radius + 1)]
    for _ in range(3000):
        diff = sum(1 << int(b) for b in r.choice(64, radius, replace=False))
        assert any(not m & diff for m in masks)
    second = [[S.kept_bits((v, w), radius) for w in range(1, 1 << radius + 1)] for v in range(1, 1 << radius + 1)]
    for _ in range(500):
        diff = sum(1 << int(b) for b in r.choice(64, radius, replace=False))
        for v, m in enumerate(masks):
            assert m & diff or any(not k & diff for k in second[v])


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(str(i * i) for i in range(3000)).encode()
    whole = S.fingerprint_of(text, 4)
    monkeypatch.setattr(S, "_PART", 100)
    assert S.fingerprint_of(text, 4) == whole == plain_fingerprint(text.decode(), 4)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (3, None), (200, 199), (200, 199)]
    r = random.Random(2)
    r.shuffle(links)
    got = dict(tuple(x) for x in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 199, 199: 199}
