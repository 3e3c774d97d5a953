import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.functions import text, vectors
from pixwave.operators import metrics, series


def one(df):
    return df.first()[0]


def test_large_logits_stay_finite(spark):
    df = spark.createDataFrame([([1e3, -1e3, 999.0], 0, [1.0, 0.0, 0.0])], "logits array<double>, label int, target array<double>")
    assert abs(one(metrics.cross_entropy(df)) - math.log(1 + math.exp(-1))) < 1e-9
    assert abs(one(metrics.cross_entropy(df, "target", onehot=True)) - math.log(1 + math.exp(-1))) < 1e-9
    assert abs(sum(metrics.softmax_probs(df).first().probabilities) - 1) < 1e-12


def test_argmax_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([-1.0, -1.0, -2.0],)], "logits array<double>")
    assert [r.prediction for r in metrics.argmax_decode(df).collect()] == [1, 0]


def test_class_index_rejects_soft_labels(spark):
    df = spark.createDataFrame([([0.0, 1.0],)], "t array<double>")
    assert one(df.select(vectors.class_index("t"))) == 1
    with pytest.raises(Exception, match="not a one-hot"):
        spark.createDataFrame([([0.5, 0.5],)], "t array<double>").select(vectors.class_index("t")).collect()


def test_histogram_edges_and_constant_tags(spark):
    rows = [("a", float(i)) for i in range(11)] + [("c", 5.0)] * 3 + [("a", float("nan"))]
    df = spark.createDataFrame(rows, "tag string, v double")
    out = {(r.tag, r.bucket): r.n for r in metrics.histogram(df, "tag", "v", 5).collect()}
    assert out == {("a", 0): 2, ("a", 1): 2, ("a", 2): 2, ("a", 3): 2, ("a", 4): 3, ("c", 0): 3}


def test_checks(spark):
    df = spark.createDataFrame([(1, [1, 2], 1, 2, 1), (None, [1], 1, 1, 3)],
                               "label int, pixels array<int>, height int, width int, depth int")
    facts = metrics.validate_examples(df).first()
    assert (facts.num_images, facts.num_labels, facts.bad_shape, facts.not_depth_1) == (2, 1, 1, 1)
    with pytest.raises(ValueError):
        metrics.check_examples(df)
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "loss double")
    assert one(metrics.nan_guard(nan, "loss")) == 1
    with pytest.raises(ArithmeticError):
        metrics.stop_on_nan(nan, "loss")


def test_total_loss_with_and_without_decay(spark):
    df = spark.createDataFrame([([0.0, 0.0], 1)], "logits array<double>, label int")
    w = spark.createDataFrame([("w1", [1.0, 2.0]), ("w2", [3.0]), ("b", [9.0])], "tensor string, values array<double>")
    assert abs(one(metrics.total_loss(df, w, {"w1": 0.1, "w2": 0.01})) - (math.log(2) + 0.25 + 0.045)) < 1e-12
    assert abs(one(metrics.total_loss(df, w, {})) - math.log(2)) < 1e-12


def test_tags_and_rates(spark):
    df = spark.createDataFrame([("tower_12/a/tower_/b", 136718)], "tag string, step long")
    row = metrics.lr_schedule(metrics.clean_metric_tag(df)).first()
    assert row.tag == "a/b" and abs(row.learning_rate - 0.01) < 1e-15
    assert one(spark.range(1).select(text.learning_rate(F.lit(136717)))) == 0.1


def long_series(spark, n, seed=0):
    x = np.random.default_rng(seed).normal(5, 3, n)
    rows = [(k, i, float(v * (k + 1))) for k in range(2) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "s int, step long, v double").repartition(5)


def test_averages_run_over_cells_and_groups(spark, monkeypatch):
    monkeypatch.setattr(series, "CELL", 7)
    monkeypatch.setattr(series, "FAN", 3)
    x, df = long_series(spark, 100)
    rows = {(r.s, r.step): r.ema for r in series.ema_losses(df, "s", "step", "v").collect()}
    y = 0.0
    for t, v in enumerate(x):
        y = 0.9 * y + 0.1 * v
        for k in (0, 1):
            assert abs(rows[k, t] - (k + 1) * y / (1 - 0.9 ** (t + 1))) < 1e-9
    rows = {(r.s, r.step): r.ema for r in series.ema_variables(df, "s", "step", "v", 0.99).collect()}
    y = x[0]
    for t, v in enumerate(x):
        d = min(0.99, (1 + t) / (10 + t))
        y = d * y + (1 - d) * v
        assert abs(rows[0, t] - y) < 1e-9


def test_small_decay_does_not_underflow(spark):
    x, df = long_series(spark, 3000)
    last = series.ema_losses(df, "s", "step", "v", 0.01).filter("s = 0 and step = 2999").first().ema
    y = 0.0
    for v in x:
        y = 0.01 * y + 0.99 * v
    assert abs(last - y) < 1e-9


def test_throughput_over_cells(spark):
    start = datetime(2024, 1, 1)
    rows = [("r", i, start + timedelta(milliseconds=10 * i * i), 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "run string, step long, ts timestamp_ntz, loss double").repartition(4)
    out = series.throughput(df, batch=100, cell=8)
    got = {r.step: r.sec_per_batch for r in out.collect()}
    assert got[0] is None and all(abs(got[i] - 0.01 * (2 * i - 1)) < 1e-9 for i in range(1, 50))
    lines = [r.line for r in series.log_lines(out).orderBy("step").collect()]
    assert len(lines) == 5 and lines[1].endswith("step 10, loss = 1.00 (526.3 examples/sec; 0.190 sec/batch)")
    assert lines[0].endswith("step 0, loss = 1.00 (NaN examples/sec; NaN sec/batch)")


def test_null_runs_and_tags_are_series(spark):
    start = datetime(2024, 1, 1)
    rows = [(r, i, start + timedelta(seconds=i * k), float(i)) for k, r in ((1, None), (2, "a")) for i in range(20)]
    df = spark.createDataFrame(rows, "run string, step long, ts timestamp_ntz, loss double").repartition(3)
    out = series.throughput(df, cell=4).collect()
    assert len(out) == 40 and {r.sec_per_batch for r in out if r.run is None and r.step} == {1.0}
    assert len(series.throughput(df.union(df.limit(1).withColumn("step", F.lit(None).cast("long")))).collect()) == 41
    emas = series.ema_losses(df, "run", "step", "loss").collect()
    by = {(r.run, r.step): r.ema for r in emas}
    assert len(by) == 40 and all(by[None, i] == by["a", i] and by["a", i] is not None for i in range(20))
    assert all(r.ema is not None for r in series.ema_variables(df, "run", "step", "loss").collect())
    counts = metrics.histogram(df, "run", "loss", 4).collect()
    assert sorted((str(r.run), r.n) for r in counts) == sorted((s, 5) for s in ("None", "a") for _ in range(4))


def test_softmax_of_many_classes_is_linear(spark):
    import time
    def seconds(n):
        df = spark.range(2000).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.sin(i + F.col("id"))).alias("logits")).cache()
        df.count()
        t = time.time()
        metrics.softmax_probs(df).select(F.sum(F.get("probabilities", F.lit(0)))).first()
        return time.time() - t
    seconds(10)
    assert seconds(1000) < 20 * max(seconds(50), 0.3)
