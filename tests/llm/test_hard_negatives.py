import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, block int, id string, v long, score string, `rank` int"


def brute(rows, positives=5, negatives=10, every=100):
    """(anchor, positive, rank, negative, scores) over plain lists, each row by itself."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for n, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        found = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m) for m, (j, w, _) in enumerate(kept) if m != n))
        same = [f for f in found if kept[f[3]][2] == label][:positives]
        for p in same:
            inside = [f for f in found if kept[f[3]][2] != label and -30 * p[0] <= -100 * f[0] <= -90 * p[0]][:negatives]
            out += [(i, kept[p[3]][0], r, kept[f[3]][0], -p[0], -f[0]) for r, f in enumerate(inside, 1)]
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "a", 2, "b", 3) for i, v, label in rows], SCHEMA)


def run(df, **options):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return Counter(tuple(r) for r in H.hard_negatives(df.withColumn("label", moved), F.col("vec_id") % 100 == 0, **options).collect())


@pytest.mark.parametrize("block", [7, 200, 8192])
@pytest.mark.parametrize("kind", ["clustered", "few values", "random"])
def test_all_rows_are_those_of_brute_force(spark, block, kind, monkeypatch):
    monkeypatch.setattr(H, "SHELF", 2)
    monkeypatch.setattr(H, "BUNDLE", 3)
    r = np.random.default_rng(5)
    n = 700
    x = r.normal(size=(n, 12))
    if kind == "clustered":
        x = r.normal(size=(6, 12))[r.integers(0, 6, n)] * 2 + x * 0.2
    if kind == "few values":
        x = r.integers(-1, 3, size=(n, 12)).astype(float)
    rows = [(int(i), [float(c) for c in v], int(label)) for i, v, label in zip(range(n), x, r.integers(0, 4, n))]
    assert run(frame(spark, rows).repartition(4), block=block) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], rng.randrange(3)) for i in range(120)]
    rows += [rows[0], rows[0], rows[50], (100, [0.5] * 6, 1), (100, [0.25] * 6, 2), (None, [0.5] * 6, 1), (None, [0.4] * 6, 0), (300, [], 1), (400, [0.0] * 6, 1),
             (500, [1.0, 2.0], 0), (600, None, 1), (700, [1.0] * 6, None), (800, [None] + [1.0] * 5, 1), (900, [float("nan")] * 6, 1), (1000, [float("inf")] * 6, 1),
             (-100, [0.1] * 6, 2), (1100, [-1.0] * 6, 77)]
    assert run(frame(spark, rows).repartition(3), block=20) == brute(rows)


def test_large_components_count_as_the_limit(spark):
    limit = H.component_limit(2)
    rows = [(100, [1e200, 0.0], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.0], 2), (3, [0.0, -1e300], 2)]
    got = run(frame(spark, rows))
    assert got == Counter([(100, 1, 1, 2, limit * 256, limit * 128)])
    assert all(H.component_limit(d) ** 2 * d <= 1 << 53 for d in (1, 2, 3, 64, 65, 1000, 4096))


def test_few_and_no_rows(spark):
    assert not run(frame(spark, [])) and not run(frame(spark, [(0, [1.0], 1)])) and not run(frame(spark, [(0, [], 1), (1, [], None)]))
    # windows that hold a score at both of their ends
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [0.3, 0.0], 2), (4, [0.91, 0.0], 2), (5, [0.29, 0.0], 2)]
    assert run(frame(spark, rows)) == brute(rows)
    assert H.hard_negatives(frame(spark, rows), F.lit(False)).count() == 0


def test_bounds_never_lose_a_row():
    r = np.random.default_rng(8)
    for _ in range(60):
        q, x = r.integers(-50, 50, 16).astype(float), r.integers(-50, 50, (16, 80)).astype(float)
        bitmap = r.random(80) < 0.8
        exact = q @ x
        rows, s = H.scan(q, x, bitmap, H.among_first(4), step=3)
        assert (s == exact[rows]).all()
        best = np.sort(exact[bitmap])[-4:]
        assert set(np.flatnonzero(bitmap & (exact >= best[0]))) <= set(rows)
        low, high = np.array([100., -2000., 5000.]), np.array([900., 0., 6000.])
        rows, s = H.scan(q, x, bitmap, H.in_windows(low, high, 4), step=3)
        for a, b in zip(low, high):
            inside = exact[bitmap & (exact >= a) & (exact <= b)]
            if len(inside):
                assert set(np.flatnonzero(bitmap & (exact >= np.sort(inside)[-4:][0]) & (exact <= b))) <= set(rows)


def test_the_scan_drops_rows_before_it_has_read_all_columns():
    r = np.random.default_rng(2)
    x = r.normal(size=(64, 5000)) * np.linspace(3, 0.05, 64)[:, None]
    seen = []
    shrink = H.among_first(5)
    H.scan(np.linspace(3, 0.05, 64), x, np.ones(5000, bool), lambda a, b: seen.append(len(a)) or shrink(a, b))
    assert seen[0] == 5000 and seen[-1] < 500


def test_query_against_its_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = Counter(duckdb.sql(H.OP11_SQL).fetchall())
    got = H.op11_query(spark, sf_dir)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert want and Counter(tuple(r) for r in got.collect()) == want
