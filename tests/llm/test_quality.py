import itertools
import zlib

import numpy as np
import pytest

from llm_helpers import brute
from pixwave.llm import quality_crf as Q


def test_marginals_are_those_of_all_labellings():
    r = np.random.default_rng(0)
    sizes = [3, 1, 0, 5]
    begin = np.cumsum([0, *sizes])
    good, a = r.normal(size=sum(sizes)) * 2, r.normal(size=(2, 2))
    p, pairs = Q.marginals(good, a, begin)
    want_pairs = np.zeros((2, 2))
    for b, e in zip(begin, begin[1:]):
        if b == e:
            continue
        weights, states = [], list(itertools.product((0, 1), repeat=e - b))
        for s in states:
            weights.append(np.exp(sum(good[b + i] for i, x in enumerate(s) if x) + sum(a[x, y] for x, y in zip(s, s[1:]))))
        weights = np.array(weights) / sum(weights)
        for i in range(e - b):
            assert np.isclose(p[b + i], sum(w for w, s in zip(weights, states) if s[i]))
        for w, s in zip(weights, states):
            for x, y in zip(s, s[1:]):
                want_pairs[x, y] += w
    assert np.allclose(pairs, want_pairs)


def test_features_of_a_line_and_its_neighbours():
    texts = [b"One two two !!\n\n ABC 12\nx", b"", b"last line", b"\n \n"]
    own, sizes, begin = Q.line_features(texts)
    assert begin.tolist() == [0, 3, 3, 4, 4] and sizes.tolist() == [14, 6, 1, 9]
    assert np.isclose(own[0, 7], 1 / 4) and np.isclose(own[0, 8], 3 / 4) and np.isclose(own[1, 3], 3 / 6) and np.isclose(own[1, 4], 2 / 6)
    x = Q.with_neighbours(own, begin)
    assert (x[0, Q.OWN:2 * Q.OWN] == 0).all() and (x[1, Q.OWN:2 * Q.OWN] == own[0]).all() and (x[1, 2 * Q.OWN:3 * Q.OWN] == own[2]).all()
    assert (x[2, 2 * Q.OWN:3 * Q.OWN] == 0).all() and (x[3, Q.OWN:3 * Q.OWN] == 0).all()


def test_long_texts_are_read_in_parts(monkeypatch):
    texts = [("\n".join(f"line {i} of many" for i in range(500))).encode(), b"short"]
    whole = Q.line_features(texts)
    monkeypatch.setattr(Q.W, "SEGMENT", 100)
    parts = Q.line_features(texts)
    assert all(np.allclose(a, b) for a, b in zip(whole, parts))


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in Q.op4_query(spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    unseen = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in unseen]) >= 0.95
    good, bad = ([r.score for r, q in unseen if q == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, text string, score string")


def test_messy_rows(spark):
    texts = [("Plain words in a line that goes on for a while.\n" * 3) if i % 2 else "#### %%%% && !! " * 20 for i in range(60)]
    df = brute.messy(spark, texts)
    given = labels(spark, [(i, i % 2, None, None) for i in range(60)] + [(None, 1, None, None), (3, None, None, None), (4, 0, "x", "y"), (9999, 1, None, None)])
    out = Q.scored(df, given)
    assert set(out.columns) == set(df.columns) | {"held_out", "predicted"}
    rows = out.collect()
    assert len(rows) == df.count()
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.predicted for r in rows if r.text in texts}
    assert all(by[i] == i % 2 for i in range(60))
    blank = [r.score for r in rows if not (r.text or "").strip()]
    assert len(blank) == 3 and len(set(blank)) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]


@pytest.mark.parametrize("quality", [None, 0, 1])
def test_no_or_one_kind_of_label(spark, quality):
    df = brute.messy(spark, ["a b c", "d"])
    given = labels(spark, [(i, quality, None, None) for i in range(2)])
    rows = Q.scored(df, given).collect()
    assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
    assert Q.scored(brute.empty(spark), given).count() == 0
    assert Q.scored(df, given.limit(0)).where("abs(score - 0.5) > 1e-9").count() == 0


def test_the_fit_reads_whole_texts(spark):
    alike = "One plain line of words that all documents begin with.\n" * 60
    tail = {1: "Another plain line of words that goes on for a while.\n" * 200, 0: "#### %%%% && !! 0000 ////\n" * 200}
    rows = [(i, alike + tail[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    given = labels(spark, [(i, i % 2, None, None) for i in range(200)])
    assert all(r.predicted == r.doc_id % 2 for r in Q.scored(df, given).collect())
