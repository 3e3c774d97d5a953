import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.functions.hashing import hash_key
from pixwave.operators import images, layers, metrics, scoring, series, state, training
from pixwave.plans.fixtures import img8
from pixwave.sources import sinks
from pixwave.streaming import learning


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return images.rescale_pixels(img8(spark, sf_dir)).cache()


def same(a, b, tol=0.0):
    return a.keys() == b.keys() and all(np.abs(a[k] - b[k]).max() <= tol for k in a)


MLP = layers.mlp_model(64, 16)


def test_result_does_not_depend_on_partitions(spark, rows):
    out = [training.train_parallel(rows.repartition(n), MLP, "adam", 20, 2, 5, 3, lr=0.01) for n in (1, 4, 13)]
    assert same(out[0].state, out[1].state) and same(out[0].state, out[2].state)
    assert out[0].metrics == out[1].metrics and out[0].step == out[1].step


def test_loss_falls_and_accuracy_beats_the_prior(spark, sf_dir):
    rows = images.standardize_image(img8(spark, sf_dir))
    trained = training.train_parallel(rows, layers.softmax_model(64), "sgd", 25, 12, 4, 0, lr=0.1)
    loss = [v for _, _, tag, v in trained.metrics if tag == "loss"]
    assert loss[-1] < loss[0]
    prior = max(r["count"] for r in rows.groupBy("label").count().collect()) / rows.count()
    assert scoring.evaluate_model(rows, layers.softmax_model(64), trained.params, trained.step).first().accuracy > prior


def test_whole_shard_batches_are_gradient_descent(spark, rows):
    """With one step per shard and round, averaging by rows is a full gradient step."""
    trained = training.train_parallel(rows, layers.softmax_model(64), "sgd", 10**6, 3, 4, 0, lr=0.5, dtype=np.float64)
    data = rows.orderBy("example_id").collect()
    x, y = np.array([r.pixels for r in data]), np.array([r.label for r in data])
    params = layers.init_params(layers.softmax_model(64))
    for _ in range(3):
        _, _, grads = layers.gradients(layers.softmax_model(64), params, x, y)
        params = {k: v - 0.5 * grads[k] for k, v in params.items()}
    assert same(trained.params, params, 1e-12) and trained.step == 3
    step = training.train_softmax_step(rows, layers.init_params(layers.softmax_model(64)), 0.5)
    one = training.train_parallel(rows, layers.softmax_model(64), "sgd", 10**6, 1, 1, 0, lr=0.5, dtype=np.float64)
    for r in step.collect():
        want = one.params[r.tensor][r.row, r.col] if r.tensor == "w0" else one.params["b0"][r.col]
        assert abs(r.value - want) < 1e-12


def test_resumed_run_equals_uninterrupted_run(spark, rows, tmp_path):
    options = dict(optimizer="adam", batch=30, shards=3, seed=4, lr=0.01, ema=0.9999)
    whole = training.train_parallel(rows, MLP, rounds=3, **options)
    path = str(tmp_path / "m")
    training.train_parallel(rows, MLP, rounds=2, callbacks=[training.save_each_round(spark, path, "mlp")], **options)
    again = training.train_parallel(rows, MLP, rounds=3, start=training.resume(spark, path, "mlp"), **options)
    assert same(whole.state, again.state) and whole.step == again.step
    assert whole.averaged.keys() == whole.params.keys()
    with pytest.raises(Exception):
        training.resume(spark, path, "other")


def test_steps_callbacks_and_errors(spark, rows):
    trained = training.train_parallel(rows, MLP, batch=10, rounds=5, shards=2, steps=7, lr=0.01)
    assert trained.step == 7
    stopped = training.train_parallel(rows, MLP, batch=50, rounds=5, shards=2, lr=0.01, callbacks=[lambda t: t.round == 2])
    assert stopped.round == 2
    with pytest.raises(ArithmeticError):
        training.train_parallel(rows.withColumn("pixels", F.transform("pixels", lambda x: x * 1e300)), MLP, shards=2)
    with pytest.raises(ValueError):
        training.train_parallel(rows, MLP, "other")
    frame = training.metrics_frame(spark, trained)
    assert {r.tag for r in frame.collect()} == {"loss", "accuracy", "learning_rate"}
    log = training.step_log(training.step_events(spark, trained))
    assert {(r.run, r.step) for r in log.collect()} == {(s, k) for s in range(2) for k in range(7)}
    emas = series.ema_losses(log, "run", "step", "loss")
    assert emas.count() == 14 and emas.where("ema is null or loss is null").count() == 0
    assert metrics.every_n_steps(log, 5).count() == 4
    assert training.decayed_rate(0.1)(136718) == pytest.approx(0.01)


def test_cnn_round_with_distortion(spark, rows):
    model = dict(name="cnn", shape=(6, 6, 1), layers=[
        layers.conv(3, 3, 4), layers.pool(2, 2), layers.lrn(), layers.dense(10, "identity")])
    prepare = lambda df, epoch: images.distorted_inputs(df, 1, epoch, 6, 6)
    a = training.train_parallel(rows, model, "adam", 20, 2, 4, lr=0.01, prepare=prepare)
    b = training.train_parallel(rows.repartition(3), model, "adam", 20, 2, 4, lr=0.01, prepare=prepare)
    assert same(a.state, b.state)
    scored = scoring.predict_batches(images.eval_inputs(rows, 6, 6), model, a.params)
    assert scored.filter(F.size("logits") == 10).count() == rows.count()


def test_evaluation_and_weight_telemetry(spark, rows):
    seen = []
    trained = training.train_parallel(rows, MLP, "adam", 50, 2, 2, lr=0.01,
                                      callbacks=[training.evaluate_each_round(rows.limit(100), MLP, seen)])
    assert [r[0] for r in seen] == [1, 2] and seen[-1][1] == trained.step
    values = training.weight_values(training.weights_frame(spark, trained.params, "mlp", trained.step))
    stats = {r.tensor: r for r in metrics.tensor_summary(values, "tensor", "value").collect()}
    assert abs(stats["w0"].stddev - trained.params["w0"].std()) < 1e-6
    assert metrics.histogram(values, "tensor", "value", 10).agg(F.sum("n")).first()[0] == sum(
        v.size for v in trained.params.values())


def test_rounds_shuffle_weights_only(spark, rows):
    laid = training.lay_out(rows.select("example_id", "pixels", "label"), 4, "example_id")
    ordered = laid.sortWithinPartitions("__shard", "example_id")
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert laid.withColumn("p", F.spark_partition_id()).filter("p <> __shard").count() == 0


def test_tasks_may_hold_several_shards(spark, rows, monkeypatch):
    options = dict(optimizer="sgd", batch=20, rounds=2, shards=4, seed=3, lr=0.1)
    apart = training.train_parallel(rows, MLP, **options)
    lay_out = training.lay_out
    monkeypatch.setattr(training, "lay_out", lambda *a: lay_out(*a).coalesce(2))
    assert same(apart.state, training.train_parallel(rows, MLP, **options).state)


def test_activation_summary_does_not_cancel(spark, rows):
    model = dict(name="m", shape=(64,), layers=[layers.dense(3, "identity")])
    params = {"w0": np.zeros((64, 3)), "b0": np.array([1e9, 1e9 + 1, 1e9 + 2])}
    out = scoring.activation_summary(rows.repartition(5), model, params).collect()
    assert len(out) == 1 and abs(out[0].stddev - np.sqrt(2 / 3)) < 1e-6 and out[0].mean == 1e9 + 1 and out[0].sparsity == 0


def test_model_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_MODEL_BYTES", 100)
    with pytest.raises(ValueError, match="does not fit"):
        scoring.broadcast_params(spark, {"w": np.zeros(100)})


def test_weights_round_trip(spark):
    state = {"w0": np.arange(10000.0).reshape(100, 100), "b0": np.array([1.5]), "s": np.array(2.0).reshape(())}
    frame = training.weights_frame(spark, state, "m", 3)
    assert same(training.collect_state(frame), state) and frame.first().parts == 5


def test_stream_score_equals_batch(spark, rows, tmp_path):
    model, params = MLP, layers.init_params(MLP)
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    learning.stream_score(spark, str(tmp_path / "in"), str(tmp_path / "out"), model, params,
                          checkpoint=str(tmp_path / "state"), files_per_trigger=2)
    got = {r.example_id: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {r.example_id: r.prediction for r in scoring.predict_batches(rows, model, params).collect()}
    assert got == want


def test_stream_train_equals_rounds_and_replay_changes_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "w")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    options = dict(size=30, shards=3, lr=0.1, seed=2)
    learning.stream_train(spark, str(tmp_path / "in"), MLP, None, path, checkpoint=str(tmp_path / "state"),
                          files_per_trigger=10, **options)
    def weights():
        trained, notes = training.saved_state(spark, path, "mlp")
        return trained.state, notes["step"][0]

    state, steps = weights()
    one = training.train_parallel(rows, MLP, "sgd", 30, 1, 3, 2, lr=0.1)
    assert same(state, one.state) and steps == one.step
    learning.train_on_batch(spark, rows, 0, path, MLP, stream=str(tmp_path / "state"), **options)
    assert same(weights()[0], state)
    learning.train_on_batch(spark, rows, 1, path, MLP, stream="other", steps=1, **options)
    assert sinks.restore_weights(spark, path, "mlp").first().step == 1


def test_a_second_feed_with_its_own_checkpoint_goes_on(spark, rows, tmp_path):
    """Two feeds with two checkpoints equal one run over both, and a replay of either changes nothing."""
    options = dict(size=1 << 16, shards=3, lr=0.1, seed=2)
    halves = [rows.filter(F.col("example_id") % 2 == k) for k in (0, 1)]

    def weights(path):
        return training.saved_state(spark, path, "mlp")[0].state

    for name, streams in (("two", ("a", "b")), ("one", ("a", "a"))):
        for k, (half, stream) in enumerate(zip(halves, streams)):
            learning.train_on_batch(spark, half, k if name == "one" else 0, str(tmp_path / name), MLP, stream=stream, **options)
    assert same(weights(str(tmp_path / "two")), weights(str(tmp_path / "one")))
    before = weights(str(tmp_path / "two"))
    for stream, half in (("a", halves[0]), ("b", halves[1])):
        learning.train_on_batch(spark, half, 0, str(tmp_path / "two"), MLP, stream=stream, **options)
    assert same(weights(str(tmp_path / "two")), before)
    for k, half in enumerate(halves):
        half.repartition(2).write.parquet(str(tmp_path / f"in{k}"))
        learning.stream_train(spark, str(tmp_path / f"in{k}"), MLP, None, str(tmp_path / "fed"), checkpoint=str(tmp_path / f"state{k}"), **options)
    assert same(weights(str(tmp_path / "fed")), before)


def test_sums_follow_a_tree_whatever_shards_share_a_task(spark, rows):
    """The same weights for any number of shards to a task, also where shards are empty; what is shuffled falls with it."""
    few = rows.where("example_id < 90")
    options = dict(optimizer="adam", batch=4, rounds=2, shards=23, seed=1, lr=0.01)
    runs = [training.train_parallel(few.repartition(3), MLP, per_task=k, **options) for k in (1, 2, 8, 32)]
    assert all(same(runs[0].state, r.state) and r.metrics == runs[0].metrics for r in runs[1:])
    sent = []
    for per_task in (1, 8):
        laid = training.lay_out(few.select("example_id", "pixels", "label"), 23, "example_id", per_task)
        body = training._shard_trainer(MLP, runs[0].table, "adam", 4, lambda step: 0.01, 1, 0, 0, 0, None, None, per_task, np.dtype("float32"))
        parts = laid.sortWithinPartitions("__shard").select("pixels", F.col("label").cast("int").alias("label"), "__shard").mapInArrow(
            body, training._parts_schema(np.float32)).cache()
        sent.append(parts.where("tensor = 'w0'").count())
        assert parts.where("tensor = '#shard'").count() == parts.where("tensor = '#shard'").select("chunk").distinct().count() > 15
    assert sent[0] > 15 and sent[1] == 3


def test_fold_is_the_same_for_any_grouping():
    r = np.random.default_rng(3)
    for _ in range(200):
        values = {int(p): r.normal() * 10.0 ** r.integers(-8, 8) for p in r.choice(70, r.integers(1, 40), replace=False)}

        def whole(low, size):
            if size == 1:
                return values.get(low)
            a, b = whole(low, size // 2), whole(low + size // 2, size // 2)
            return b if a is None else a if b is None else a + b

        for per_task in (1, 2, 4, 16, 128):
            top = state.Fold(lambda a, b: a + b)
            for block in sorted({p // per_task for p in values}):
                inner = state.Fold(lambda a, b: a + b)
                for p in sorted(q for q in values if q // per_task == block):
                    inner.push(p, values[p])
                top.push(inner.items[0][0], inner.total())
            assert top.total() == whole(0, 128)


@pytest.mark.parametrize("skip", [0, 2])
def test_several_steps_a_shard_are_those_of_plain_loops(spark, rows, skip):
    """Two rounds of mini-batches on three shards, averaged by rows, against loops over lists."""
    model, batch, shards, seed = layers.softmax_model(64), 37, 3, 5
    first = training.start_training(spark, model, "sgd", 0, None, np.float64)
    laid = training.lay_out(rows.select("example_id", "pixels", "label"), shards, "example_id")
    ordered = laid.withColumn("k", hash_key(seed, 0, "round", "example_id")).orderBy("__shard", "k", "example_id").collect()
    got = training.train_round(laid, model, first, optimizer="sgd", batch=batch, rate=lambda step: 0.5 / (1 + step), seed=seed, ident="example_id",
                               skip=skip, dtype=np.float64)
    total, n, steps = {}, 0, []
    for shard in range(shards):
        mine = [r for r in ordered if r["__shard"] == shard]
        params = layers.init_params(model)
        used = 0
        for i, at in enumerate(range(0, len(mine), batch)):
            if i < skip:
                continue
            part = mine[at:at + batch]
            loss, hits, grads = layers.gradients(model, params, np.array([r.pixels for r in part]), np.array([r.label for r in part]))
            params = {k: v - 0.5 / (1 + i - skip) * grads[k] for k, v in params.items()}
            used += len(part)
            steps.append((shard, i - skip + 1, len(part), loss, hits))
        total = {k: total.get(k, 0) + v * used for k, v in params.items()}
        n += used
    assert same(got.params, {k: v / n for k, v in total.items()}, 1e-12) and max(s[1] for s in steps) == got.step > 2
    events = sorted((e.shard, e.step, e.n, e.loss, e.accuracy) for e in training.step_events(spark, got).collect())
    assert len(events) == len(steps) and all(a[:3] == b[:3] and np.allclose(a[3:], b[3:]) for a, b in zip(events, sorted(steps)))


def test_number_of_shards_grows_with_the_rows(spark, rows):
    assert training.shards_for(10, 100) == 1 and training.shards_for(10 ** 9, 100) == 10 ** 9 // 6400
    assert training.shards_per_task(spark, 1) == 1 and training.shards_per_task(spark, 1000) >= 1000 / (2 * spark.sparkContext.defaultParallelism)
    a = training.train_parallel(rows, MLP, batch=2, rounds=1, lr=0.01)
    assert training.step_events(spark, a).select("shard").distinct().count() == training.shards_for(rows.count(), 2) > 1


def test_weights_do_not_pass_through_the_driver(spark, rows, tmp_path, monkeypatch):
    """Training, saving, resuming, going on and scoring read no row of a tensor on the driver."""
    driver, read = os.getpid(), state.read_folder

    def forbidden(*args):
        if os.getpid() == driver:
            raise AssertionError("a tensor is read on the driver")
        return read(*args)

    monkeypatch.setattr(training, "collect_state", forbidden)
    monkeypatch.setattr(state, "read_folder", forbidden)
    path = str(tmp_path / "m")
    options = dict(optimizer="adam", batch=30, shards=3, seed=4, lr=0.01, ema=0.9)
    training.train_parallel(rows, MLP, rounds=2, callbacks=[training.save_each_round(spark, path, "mlp")], **options)
    again = training.train_parallel(rows, MLP, rounds=3, start=training.resume(spark, path, "mlp"), **options)
    for averaged in (False, True):
        assert scoring.evaluate_model(rows, MLP, again.weights(averaged), again.step).first().n > 0
    assert again.table.size(spark) == 4 * 4 * sum(v.size for v in layers.init_params(MLP).values())  # tensors, two moments, averages


def test_progress_of_a_real_training(spark, rows):
    trained = training.train_parallel(rows, MLP, "sgd", 10, 2, 3, lr=0.01)
    log = training.step_log(training.step_events(spark, trained))
    timed = series.throughput(log, batch=10)
    assert timed.where("step > 0 and (sec_per_batch is null or sec_per_batch <= 0)").count() == 0
    lines = series.log_lines(timed, 5)
    assert lines.count() == log.where("step % 5 = 0").count() > 0 and lines.where("line is null").count() == 0
    events = training.step_events(spark, trained)
    assert events.where("seconds <= 0 or ts is null or learning_rate <> 0.01").count() == 0
    assert events.agg(F.sum("n")).first()[0] == 2 * rows.count()


def test_numbers_of_notes():
    for n in (0, 1, 65535, 65536, 2 ** 24 + 1, 2 ** 53 + 1):
        assert state.number(np.array(state.digits(n), np.float32)) == n


def test_a_feed_stops_at_the_steps_and_goes_on_later(spark, rows, tmp_path):
    """Micro-batches of one file each; the steps end inside the second, and a call with more learns the rest."""
    for k in range(4):
        rows.where(F.col("example_id") % 4 == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    options = dict(checkpoint=str(tmp_path / "state"), files_per_trigger=1, size=20, shards=2, lr=0.1)

    def now(path):
        trained, notes = training.saved_state(spark, str(tmp_path / path), "mlp")
        return trained.state, notes

    whole = rows.count() // 4
    per_batch = -(-max(r["count"] for r in training.lay_out(rows.where("example_id % 4 = 0"), 2, "example_id").groupBy("__shard").count().collect()) // 20)
    learning.stream_train(spark, str(tmp_path / "in"), MLP, per_batch + 2, str(tmp_path / "w"), **options)
    state_then, notes = now("w")
    (key,) = (k for k in notes if k.startswith("stream "))
    assert notes["step"] == [per_batch + 2] and notes[key][:3] == [1, 2, 0]
    learning.stream_train(spark, str(tmp_path / "in"), MLP, per_batch + 2, str(tmp_path / "w"), **options)  # no more steps: nothing changes
    assert same(now("w")[0], state_then)
    seen = []
    learning.stream_train(spark, str(tmp_path / "in"), MLP, None, str(tmp_path / "w"), on_batch=seen.append, **options)
    notes = now("w")[1]
    assert seen == [1, 2, 3] and notes[key][0] == 3 and notes[key][2] == 1
    steps = [r.step for r in spark.read.parquet(str(tmp_path / "w" / "_steps")).collect()]
    # every row is learned once: batch 0, two steps of batch 1, the rest of it, and two batches more
    assert sorted(steps) == [1, 2, 3, 4, 5] and whole > 0 and notes["step"][0] >= 4 * (whole // 2 // 20)


def test_gradient_histograms_equal_those_of_exported_gradients(spark, rows):
    """Counts that shards add up while they learn, against the table function over all gradients of plain loops."""
    model, batch, shards, seed = layers.mlp_model(64, 5), 60, 3, 2
    model["layers"] = [layer for layer in model["layers"] if layer["kind"] != "dropout"]
    trained = training.train_parallel(rows, model, "sgd", batch, 1, shards, seed, lr=0.1, dtype=np.float64, count_gradients=True)
    ordered = (training.lay_out(rows.select("example_id", "pixels", "label"), shards, "example_id")
               .withColumn("k", hash_key(seed, 0, "round", "example_id")).orderBy("__shard", "k", "example_id").collect())
    exported = []
    for shard in range(shards):
        mine, params = [r for r in ordered if r["__shard"] == shard], training.initial_state(model, "sgd", seed, None, np.float64)
        for at in range(0, len(mine), batch):
            part = mine[at:at + batch]
            _, _, grads = layers.gradients(model, params, np.array([r.pixels for r in part]), np.array([r.label for r in part]))
            exported += [(k, float(x)) for k, g in grads.items() for x in g.ravel()]
            params = {k: v - 0.1 * grads[k] for k, v in params.items()}
    want = metrics.exponent_histogram(spark.createDataFrame(exported, "tensor string, value double"), "tensor", "value")
    got = training.gradient_histogram(spark, trained)
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(tuple(r) for r in want.collect()) and got.where("round <> 0").count() == 0


def test_exponent_buckets(spark):
    r = np.random.default_rng(0)
    values = [0.0, -0.0, 1.0, -1.0, 2.0, np.nextafter(2.0, 0), np.nextafter(1.0, 0), 5e-324, -1e308, 3.0, float("nan"), float("inf"), None,
              *(2.0 ** k for k in range(-60, 60, 7)), *(np.nextafter(2.0 ** k, 0) for k in range(-60, 60, 7)), *r.normal(size=200)]
    df = spark.createDataFrame([("t", None if v is None else float(v)) for v in values], "tag string, v double")
    rows = {x.bucket: x for x in metrics.exponent_histogram(df, "tag", "v").collect()}
    finite = np.array([v for v in values if v is not None and np.isfinite(v)])
    assert {b: x.n for b, x in rows.items()} == training.exponent_counts(finite)
    for b, x in rows.items():
        mine = finite[(finite >= x.lower) & (finite < x.upper)] if b > 0 else finite[(finite > x.lower) & (finite <= x.upper)] if b < 0 else finite[finite == 0]
        assert len(mine) == x.n
