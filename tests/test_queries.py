"""Every registered query against its SQL, and its plan."""

import pytest
from check_oracle import check, connect

import __spark_entry__ as registered

QUERIES, ORACLE = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    message, _ = check(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
    assert not message


def test_idx_images_keep_their_labels_over_many_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from pixwave.plans.fixtures import img8
    from pixwave.plans.queries import cells
    value = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (F.xxhash64("id", i) % 1000 / 1001).cast("float"))
    rows = spark.range(9_000).select(F.col("id").alias("vec_id"), value.alias("embedding"), (F.xxhash64("id") % 5 + 5).cast("int").alias("label"))
    rows.repartition(6, F.xxhash64("vec_id")).write.parquet(f"{tmp_path}/embeddings.parquet")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")  # ranges are sampled: two passes would cut them at other rows
    try:
        got = QUERIES["read_idx"](spark, str(tmp_path)).cache()
    finally:
        spark.conf.unset(conf)
    want = cells(img8(spark, str(tmp_path)), ["example_id", "label"])
    assert got.count() == 64 * 9_000 and got.exceptAll(want).isEmpty()
    got.unpersist()


def test_entry(spark):
    assert registered.entry(spark).count() == 1


def empty_window_inputs(plan: str) -> list[str]:
    """The node each single-partition exchange reads, aggregates excepted."""
    lines = [line.lstrip(" :+-*0123456789()") for line in plan.splitlines()]
    return [lines[i + 1] for i, line in enumerate(lines)
            if line.startswith("Exchange SinglePartition") and not lines[i + 1].startswith("HashAggregate")]


@pytest.mark.parametrize("name", ["global_index", "assign_batches", "zip_by_position", "split_validation",
                                  "bootstrap_batches", "ema_losses", "throughput", "extract_clips", "spectrogram",
                                  "spectrogram_pieces", "histogram", "train_softmax_step", "total_loss"])
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert empty_window_inputs(plan) == []


def test_plan_check_sees_a_window_over_a_table(spark, sf_dir):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    whole = events.select(F.row_number().over(Window.orderBy("event_id")))
    assert empty_window_inputs(whole._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("name", ["distorted_inputs", "eval_inputs", "score_cnn", "predict_batches", "evaluate_model",
                                  "tensor_summary", "softmax_probs"])
def test_one_python_pass(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange hashpartitioning" not in plan.split("ArrowEvalPython")[1]
