import numpy as np
import pytest

from pixwave.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int, part int, score string"


def frame(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(c) for c in v], None, 1, "s") for i, v in zip(range(len(x)) if ids is None else ids, x)], SCHEMA)


def brute(ids, x, query_ids, k):
    out = {}
    for q in query_ids:
        v = x[list(ids).index(q)]
        score = A.exact_scores(np.repeat(v[None], len(x), 0), x)
        order = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
        out[q] = [(i, -s) for s, i in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("clustered", [True, False])
def test_recall_and_scores(spark, clustered):
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 16))
    if clustered:
        x = r.normal(size=(30, 16))[r.integers(0, 30, 3000)] * 3 + x * 0.4
    x = x.astype(np.float32).astype(float)
    df = frame(spark, x)
    got = found(A.nearest(df, df.where("vec_id % 20 = 0"), 20, parts=16, sample=1000, block=100).collect())
    want = brute(range(3000), x, range(0, 3000, 20), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    exact = {q: dict(v) for q, v in brute(range(3000), x, list(want)[:5], 2999).items()}
    assert all(exact[q][i] == s for q in exact for i, s in got[q])


def test_given_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = df.collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got = found(A.op3_query(spark, sf_dir).collect())
    want = brute(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9


def test_ties_and_rows_that_take_no_part(spark):
    x = [[1.0, 0.0]] * 30 + [[0.0, 1.0]] * 5
    df = frame(spark, x).union(spark.createDataFrame(
        [(100, None, None, None, None), (101, [0.0, 0.0], 1, 1, ""), (102, [float("nan"), 1.0], 1, 1, ""), (103, [float("inf"), 1.0], 1, 1, ""),
         (104, [None, 1.0], 1, 1, ""), (None, [1.0, 0.0], 1, 1, ""), (120, [1.0, 2.0, 3.0], 1, 1, ""), (3, [1.0, 0.0], None, 1, "")], SCHEMA))
    got = found(A.nearest(df, df.where("vec_id % 20 = 0"), 20).collect())
    assert set(got) == {0, 20}
    ones = sorted([*range(30), 3])  # a repeated row is a candidate too
    assert [i for i, _ in got[0]] == [i for i in ones if i != 0][:20]
    assert [i for i, _ in got[20]] == [i for i in ones if i != 20][:20]


def test_few_and_no_candidates(spark):
    df = frame(spark, [[1.0, 2.0], [3.0, 1.0], [-1.0, 0.5]], [0, 1, 2])
    got = found(A.nearest(df, df.where("vec_id % 20 = 0"), 20).collect())
    assert got == {0: [(1, 5.0), (2, 0.0)]}
    one = frame(spark, [[1.0, 2.0]], [0])
    assert A.nearest(one, one, 20).count() == 0
    assert A.nearest(df.limit(0), df.limit(0), 20).count() == 0


def test_parts_are_balanced_and_cut_few_edges():
    r = np.random.default_rng(1)
    x = r.normal(size=(8, 12))[np.repeat(np.arange(8), 100)] * 4 + r.normal(size=(800, 12)) * 0.3
    near = A.nearest_in_sample(x / np.linalg.norm(x, axis=1, keepdims=True), 10)
    part = A.balanced_parts(near, 8)
    assert np.bincount(part).tolist() == [100] * 8
    assert (part[near] == part[:, None]).mean() > 0.8
