"""Training: one distributed gradient step, and parameter averaging in rounds.

A round is a narrow pass: every shard reads the weights from the written table of the last
round, takes mini-batch steps on its own rows, and the resulting weights are averaged by (tensor,
chunk) into the next table. A task adds up its shards before anything is shuffled, in
the order of a fixed tree over the shards, so that the result does not depend on how many shards a
task holds. Shards are a function of the example id and of the number of shards, not of the cluster, and
all draws are functions of (seed, round, shard, step), so a retried or moved
task gives the same result. Weights never pass through the driver.
"""

import contextlib
import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_key
from ..session import shared_dir
from ..sources.files import filesystem, qualified
from ..sources.sinks import WEIGHTS_SCHEMA, checkpoint_weights, restore_weights, write_metrics
from . import scoring
from .layers import Params, apply_gradients, gradients, softmax_loss
from .metrics import LEAST_EXPONENT, exponent_bounds
from .scoring import broadcast_params, evaluate_model, matrix
from .state import (Fold, StateTable, Weights, averages, initial_state, model_tensors, notes_frame, read_notes, value_type, weight_chunks,
                    write_table)

LOCAL_STEPS = 64  # mini-batches of a shard and round, where the number of shards is not given
LOG = ("ts", "seconds", "n", "loss", "accuracy", "learning_rate")  # of each step
METRICS_SCHEMA = "round int, step long, tag string, value double"
GRADIENTS_SCHEMA = "round int, tensor string, bucket int, n long"
EVENTS_SCHEMA = "round int, shard int, step long, ts timestamp, seconds double, n long, loss double, accuracy double, learning_rate double"


# ---- weights as rows -----------------------------------------------------

def weights_frame(spark: SparkSession, state: Params, model: str, step: int) -> DataFrame:
    """Weight rows (model, step, tensor, shape, chunk, parts, values) of one model."""
    names, shapes, chunks, values = zip(*weight_chunks(state))
    n = len(names)
    table = pa.table({
        "model": pa.array([model] * n), "step": pa.array([step] * n, pa.int64()), "tensor": pa.array(names),
        "shape": pa.array(shapes, pa.list_(pa.int32())), "chunk": pa.array(chunks, pa.int32()), "parts": pa.array([n] * n, pa.int32()),
        "values": pa.array([np.asarray(v, np.float64) for v in values], pa.list_(pa.float64()))})
    return spark.createDataFrame(table, WEIGHTS_SCHEMA)


def collect_state(rows: DataFrame, dtype=np.float64) -> Params:
    """Weight rows of one small model -> numpy tensors on the driver."""
    table = rows.select("tensor", "shape", "chunk", "values").toArrow().to_pandas()
    table = table.sort_values(["tensor", "chunk"])
    return {name: np.concatenate(list(part["values"])).astype(dtype, copy=False).reshape(tuple(part["shape"].iloc[0]))
            for name, part in table.groupby("tensor")}


# ---- one step of softmax regression ---------------------------------------

def softmax_gradient_sums(df: DataFrame, params: Params, pixels: str = "pixels", label: str = "label") -> DataFrame:
    """Gradient sums per input of `x W + b`, one partial row per task and input.

    Returns row (input number, -1 for the bias), n and grad (array over classes).
    """
    shared = broadcast_params(df.sparkSession, params)

    def run(batches):
        w, b = shared.value["w0"], shared.value["b0"]
        total, count = np.zeros((len(w) + 1, len(b))), 0
        for part in (b.slice(i, 2048) for b in batches for i in range(0, b.num_rows, 2048)):
            x, y = matrix(part.column(0)), np.asarray(part.column(1))
            _, p = softmax_loss(x @ w + b, y)
            p[np.arange(len(y)), y] -= 1
            total[:-1] += x.T @ p
            total[-1] += p.sum(axis=0)
            count += len(y)
        if count:
            yield pa.RecordBatch.from_pydict({
                "row": pa.array([*range(len(w)), -1], pa.int32()), "n": pa.array([count] * len(total), pa.int64()),
                "grad": pa.array(list(total), pa.list_(pa.float64()))})

    classes = len(params["b0"])
    parts = df.select(pixels, F.col(label).cast("int")).mapInArrow(run, "row int, n long, grad array<double>")
    sums = [F.sum(F.col("grad")[j]).alias(f"g{j}") for j in range(classes)]
    return parts.groupBy("row").agg(F.sum("n").alias("n"), *sums).select(
        "row", "n", F.array(*[f"g{j}" for j in range(classes)]).alias("grad"))


def train_softmax_step(df: DataFrame, params: Params, lr: float, pixels: str = "pixels",
                       label: str = "label") -> DataFrame:
    """One gradient step of the softmax classifier over all rows: tensor, row, col, gradient, value."""
    sums = softmax_gradient_sums(df, params, pixels, label)
    grads = sums.select("row", F.posexplode(F.transform("grad", lambda g: g / F.col("n"))).alias("col", "gradient"))
    old = df.sparkSession.createDataFrame(
        [(r, c, float(v)) for r, values in [*enumerate(params["w0"]), (-1, params["b0"])]
         for c, v in enumerate(values)], "row int, col int, old double")
    both = grads.select("row", "col", "gradient", F.lit(0.0).alias("old")).unionByName(
        old.withColumn("gradient", F.lit(0.0)))
    return both.groupBy("row", "col").agg(F.sum("gradient").alias("gradient"), F.sum("old").alias("__old")).select(
        F.when(F.col("row") < 0, "b0").otherwise("w0").alias("tensor"), F.greatest("row", F.lit(0)).alias("row"),
        "col", "gradient", (F.col("__old") - lr * F.col("gradient")).alias("value"))


# ---- rounds ----------------------------------------------------------------

def decayed_rate(lr0: float, factor: float = 0.1, decay_steps: int = 136_718) -> Callable[[int], float]:
    """Staircase learning rate as a function of the step."""
    return lambda step: lr0 * factor ** (step // decay_steps)


@dataclass
class Trained:
    """The written table of weights (with optimizer state), step, metrics of each round, and the folder of the step events."""
    table: StateTable
    step: int = 0
    round: int = 0
    metrics: list[tuple] = field(default_factory=list)
    log: str | None = None

    def weights(self, averaged: bool = False) -> Weights:
        """What scoring takes: tasks read the tensors themselves."""
        return Weights(self.table, averaged)

    @property
    def state(self) -> Params:
        """All tensors as arrays, read on the driver: for models that fit it."""
        return self.table.read()

    @property
    def params(self) -> Params:
        """The model tensors alone, without optimizer state or averages."""
        return model_tensors(self.state)

    @property
    def averaged(self) -> Params:
        """Moving averages of the model tensors, if they were kept."""
        return averages(self.state)


def start_training(spark: SparkSession, model: dict, optimizer: str = "sgd", seed: int = 0, ema: float | None = None, dtype=np.float32) -> Trained:
    """Initial weights, drawn and written by one task."""
    if optimizer not in ("sgd", "adam"):
        raise ValueError(f"unknown optimizer: {optimizer}")
    table = write_table(spark, shared_dir(spark, "state"), dtype, lambda: initial_state(model, optimizer, seed, ema, dtype))
    size = table.size(spark)
    if size > scoring.MAX_MODEL_BYTES:
        raise ValueError(f"state of {size} bytes does not fit a task; the limit is {scoring.MAX_MODEL_BYTES}")
    return Trained(table)


def shards_for(rows: int, batch: int, local_steps: int = LOCAL_STEPS) -> int:
    """Shards that take about `local_steps` mini-batches a round each: they grow with the rows."""
    return max(1, -(-rows // (batch * local_steps)))


def shards_per_task(spark: SparkSession, shards: int) -> int:
    """A power of two that gives about two tasks for every core; the result of a round does not depend on it."""
    tasks = 2 * spark.sparkContext.defaultParallelism
    return 1 << max(0, -(-shards // tasks) - 1).bit_length()


def lay_out(df: DataFrame, shards: int, ident: str, per_task: int = 1) -> DataFrame:
    """Rows by the shard of their id's md5, `per_task` (a power of two) shards to a partition. Ids identify rows, so shards are even."""
    digest = F.md5(F.coalesce(F.col(ident).cast("string"), F.lit("")))
    shard = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % shards).cast("int")
    block = F.floor(F.col("__shard") / per_task).cast("int")
    return df.withColumn("__shard", shard).repartitionById(-(-shards // per_task), block)


def mini_batches(batches, size: int):
    """(pixels, labels, shard) blocks of `size` rows of one shard; the last of a shard may be short."""
    held, count, current = [], 0, None
    for batch in batches:
        shards = np.asarray(batch.column("__shard"))
        at = 0
        while at < batch.num_rows:
            if held and shards[at] != current:
                yield (*_block(held), current)
                held, count = [], 0
            current = int(shards[at])
            same = int(np.argmax(shards[at:] != current)) or batch.num_rows - at
            part = batch.slice(at, min(size - count, same))
            held.append(part)
            at, count = at + part.num_rows, count + part.num_rows
            if count == size:
                yield (*_block(held), current)
                held, count = [], 0
    if held:
        yield (*_block(held), current)


def _block(parts):
    return (np.concatenate([matrix(p.column("pixels")) for p in parts]),
            np.concatenate([np.asarray(p.column("label")) for p in parts]))


def _add(left: tuple, right: tuple) -> tuple:
    """Rows and row-weighted sums of two nodes of the tree."""
    a, b = _sums(left), _sums(right)
    for name, value in b.items():
        a[name] += value
    return left[0] + right[0], None, a


def _sums(node: tuple) -> Params:
    rows, state, sums = node
    return {k: v.astype(np.float64) * rows for k, v in state.items()} if sums is None else sums


def _node_batches(first: int, node: tuple, dtype, each: int = 256):
    """A node of the tree as rows: the weights of one shard as they are, sums of several in double."""
    rows, state, sums = node
    single, pieces = sums is None, list(weight_chunks(state if sums is None else sums))
    small, wide = pa.list_(pa.from_numpy_dtype(dtype)), pa.list_(pa.float64())
    for at in range(0, len(pieces), each):
        names, shapes, chunks, values = zip(*pieces[at:at + each])
        n = len(names)
        yield pa.RecordBatch.from_arrays([
            pa.array(names), pa.array(shapes, pa.list_(pa.int32())), pa.array(chunks, pa.int32()), pa.array([first] * n, pa.int32()),
            pa.array([rows] * n, pa.int64()), pa.array(values if single else [None] * n, small),
            pa.array([None] * n if single else values, wide), pa.array([None] * n, wide)], names=PART_NAMES)


def _log_batch(shard: int, values: list, dtype, name: str = "#shard") -> pa.RecordBatch:
    one = lambda value, kind: pa.array([value], kind)
    return pa.RecordBatch.from_arrays([
        pa.array([name]), one([], pa.list_(pa.int32())), one(shard, pa.int32()), one(shard, pa.int32()), one(0, pa.int64()),
        one([], pa.list_(pa.from_numpy_dtype(dtype))), one(None, pa.list_(pa.float64())), one([float(x) for v in values for x in v], pa.list_(pa.float64()))],
        names=PART_NAMES)


PART_NAMES = ["tensor", "shape", "chunk", "first", "n_rows", "values", "sums", "log"]


def _parts_schema(dtype) -> str:
    return f"tensor string, shape array<int>, chunk int, first int, n_rows long, values array<{value_type(dtype)}>, sums array<double>, log array<double>"


def _merged_schema(dtype) -> str:
    return f"tensor string, shape array<int>, chunk int, values array<{value_type(dtype)}>, log array<double>"


def _shard_trainer(model, table, optimizer, batch, rate, seed, round_no, step0, skip, limit, ema, per_task, dtype, count_gradients=False):
    """mapInArrow body: mini-batch steps on each shard of a task, then the sum of its shards' weights as chunks.

    Rows come sorted by shard. A task holds one block of shards, but nothing relies on it.
    """
    counts: dict[str, Counter] = {}

    def learn(state, x, y, shard, done):
        began = time.time()
        rng = np.random.Generator(np.random.Philox(key=[seed, (round_no << 32) | shard], counter=done << 64))
        params = model_tensors(state)
        loss, hits, grads = gradients(model, params, x, y, rng)
        step = step0 + done - skip
        if count_gradients:
            for name, g in grads.items():
                counts.setdefault(name, Counter()).update(exponent_counts(g))
        apply_gradients(state, grads, optimizer, rate(step), step)
        if ema:
            d = min(ema, (1 + step) / (10 + step))
            for k in params:
                state[f"ema/{k}"] += (1 - d) * (state[k] - state[f"ema/{k}"])
        now = time.time()
        return now, now - began, len(y), loss, hits, rate(step)

    def run(batches):
        fold, block, current, state, seen, steps = None, None, None, None, 0, []

        def close_shard():
            nonlocal fold, block
            if steps:
                yield _log_batch(current, steps, dtype)
                for name, found in counts.items():
                    yield _log_batch(current, sorted(found.items()), dtype, f"#gradient {name}")
                counts.clear()
                if fold is not None and block != current // per_task:
                    yield from close_block()
                if fold is None:
                    fold, block = Fold(_add), current // per_task
                fold.push(current, (sum(s[2] for s in steps), state, None))

        def close_block():
            nonlocal fold
            if fold is not None:
                first = fold.items[0][0]
                yield from _node_batches(first, fold.total(), dtype)
                fold = None

        for x, y, shard in mini_batches(batches, batch):
            if shard != current:
                yield from close_shard()
                current, state, seen, steps = shard, {k: v.copy() for k, v in table.read().items()}, 0, []
            if seen >= skip and (limit is None or len(steps) < limit):
                steps.append(learn(state, x, y, shard, seen))
            seen += 1
        if current is not None:
            yield from close_shard()
        yield from close_block()

    return run


def _average_chunks(dtype, batches):
    """mapInArrow body: rows sorted by (tensor, chunk, first) -> one averaged row per (tensor, chunk).

    The mean is weighted by rows and added up in the order of the tree. Logs of shards pass as they are.
    """
    key, shape, fold, done = None, None, None, []
    add = lambda a, b: (a[0] + b[0], a[1] + b[1])

    def finished():
        rows, total = fold.total()
        return (*key, shape, total / rows, None)

    for batch in batches:
        names, shapes, chunks, firsts, n_rows, logs = (batch.column(c).to_pylist() for c in ("tensor", "shape", "chunk", "first", "n_rows", "log"))
        values, sums = batch.column("values"), batch.column("sums")
        for i, name in enumerate(names):
            if logs[i] is not None:
                done.append((name, chunks[i], shapes[i], np.zeros(0), logs[i]))
                continue
            if (name, chunks[i]) != key:
                if key:
                    done.append(finished())
                key, shape, fold = (name, chunks[i]), shapes[i], Fold(add)
            weighted = np.asarray(sums[i].values) if sums[i].is_valid else np.asarray(values[i].values).astype(np.float64) * n_rows[i]
            fold.push(firsts[i], (n_rows[i], weighted))
        if len(done) >= 256:
            yield _merged_batch(done, dtype)
            done = []
    if key:
        done.append(finished())
    if done:
        yield _merged_batch(done, dtype)


def _merged_batch(done, dtype) -> pa.RecordBatch:
    names, chunks, shapes, values, logs = zip(*done)
    return pa.RecordBatch.from_pydict({
        "tensor": pa.array(names), "shape": pa.array(shapes, pa.list_(pa.int32())),
        "chunk": pa.array(chunks, pa.int32()), "values": pa.array([v.astype(dtype) for v in values], pa.list_(pa.from_numpy_dtype(dtype))),
        "log": pa.array(logs, pa.list_(pa.float64()))})


def exponent_counts(values: np.ndarray) -> dict[int, int]:
    """Numbers of finite values by the buckets of `metrics.exponent_histogram`."""
    v = values[np.isfinite(values)].astype(np.float64)
    buckets, n = np.unique(np.where(v == 0, 0, np.sign(v) * (np.frexp(v)[1] - LEAST_EXPONENT)).astype(np.int64), return_counts=True)
    return dict(zip(buckets.tolist(), n.tolist()))


def _gradients(rows: DataFrame, round_no: int) -> DataFrame:
    """(round, tensor, bucket, n) of a round, summed over its shards."""
    pairs = F.transform(F.sequence(F.lit(1), F.size("log"), F.lit(2)), lambda i: F.struct(F.get("log", i - 1).cast("int").alias("bucket"), F.get("log", i).cast("long").alias("n")))
    each = rows.where(F.col("tensor").startswith("#gradient ") & (F.size("log") > 0)).select(F.substring("tensor", 11, 1 << 20).alias("tensor"), F.explode(pairs).alias("p"))
    return each.groupBy("tensor", "p.bucket").agg(F.sum("p.n").alias("n")).select(F.lit(round_no).alias("round"), "tensor", "bucket", "n")


def gradient_histogram(spark: SparkSession, trained: Trained) -> DataFrame:
    """Values of the gradients of each tensor and round, by sign and binary exponent: round, tensor, bucket, lower, upper, n.

    For a training that counts its gradients (`count_gradients`); shards count while they learn, and no gradient is kept.
    """
    lower, upper = exponent_bounds("bucket")
    rows = spark.read.schema(GRADIENTS_SCHEMA).parquet(f"{trained.log}-gradients")
    return rows.select("round", "tensor", "bucket", lower.alias("lower"), upper.alias("upper"), "n")


def _events(rows: DataFrame, round_no: int, step0: int) -> DataFrame:
    """Step events (EVENTS_SCHEMA) from the logs of a round's shards."""
    each = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("log") - 1, F.lit(len(LOG))), lambda i: F.slice("log", i + 1, len(LOG))))
    logs = rows.where("tensor = '#shard'").select(F.col("chunk").alias("shard"), each.alias("place", "e"))
    of = {name: F.col("e")[i] for i, name in enumerate(LOG)}
    return logs.select(F.lit(round_no).alias("round"), "shard", (F.lit(step0) + F.col("place") + 1).cast("long").alias("step"),
                       F.timestamp_micros((of["ts"] * 1e6).cast("long")).alias("ts"), of["seconds"].alias("seconds"), of["n"].cast("long").alias("n"),
                       of["loss"].alias("loss"), of["accuracy"].alias("accuracy"), of["learning_rate"].alias("learning_rate"))


def train_round(laid: DataFrame, model: dict, trained: Trained, *, optimizer: str, batch: int,
                rate: Callable[[int], float], seed: int, ident: str, limit: int | None = None, skip: int = 0,
                ema: float | None = None, prepare: Callable[[DataFrame, int], DataFrame] | None = None,
                per_task: int = 1, dtype=np.float32, count_gradients: bool = False) -> Trained:
    """One round over rows from `lay_out`: one narrow pass over the shards and a shuffle of one set of weights per task.

    The steps of a shard run in `dtype`, sums over shards in double. `skip` leaves out the first mini-batches of every shard,
    `limit` those after so many. The driver sees the mean loss and accuracy and the number of steps; every step is an
    event in the folder `log`.
    """
    spark, dtype = laid.sparkSession, np.dtype(dtype)
    rows = prepare(laid, trained.round) if prepare else laid
    ordered = (rows.withColumn("__key", hash_key(seed, trained.round, "round", ident))
               .sortWithinPartitions("__shard", "__key", ident)
               .select(F.col("pixels"), F.col("label").cast("int").alias("label"), "__shard"))
    body = _shard_trainer(model, StateTable(trained.table.path, dtype.name), optimizer, batch, rate, seed, trained.round, trained.step,
                          skip, limit, ema, per_task, dtype, count_gradients)
    merged = (ordered.mapInArrow(body, _parts_schema(dtype)).repartition("tensor", "chunk").sortWithinPartitions("tensor", "chunk", "first")
              .mapInArrow(partial(_average_chunks, dtype), _merged_schema(dtype)))
    path = qualified(spark, shared_dir(spark, "state"))
    merged.write.parquet(path)
    written = spark.read.schema(_merged_schema(dtype)).parquet(path)
    events = _events(written, trained.round, trained.step)
    log = trained.log or shared_dir(spark, "training-log")
    events.write.mode("append").parquet(log)
    if count_gradients:
        _gradients(written, trained.round).write.mode("append").parquet(f"{log}-gradients")
    # exact sums, so that the order in which tasks end plays no role
    mean = lambda c: F.sum(F.when(F.abs(c) < 1e15, (c * F.col("n")).cast("decimal(38,12)"))) / F.sum("n")
    steps, loss, hits, finite = events.agg(F.max("step"), mean(F.col("loss")).cast("double"), mean(F.col("accuracy")).cast("double"),
                                           F.min(F.coalesce(F.abs("loss") < 1e15, F.lit(False)))).first()
    if steps is None:
        return trained
    if not finite:
        raise ArithmeticError(f"loss is not finite in round {trained.round}")
    new = [(trained.round, steps, tag, float(value)) for tag, value in
           [("loss", loss), ("accuracy", hits), ("learning_rate", rate(steps - 1))]]
    return Trained(StateTable(path, dtype.name), steps, trained.round + 1, trained.metrics + new, log)


def train_parallel(df: DataFrame, model: dict, optimizer: str = "sgd", batch: int = 100, rounds: int = 1,
                   shards: int | None = None, seed: int = 0, callbacks: Sequence[Callable[[Trained], bool | None]] = (), *,
                   lr: float | Callable[[int], float] = 0.1, steps: int | None = None, ema: float | None = None,
                   ident: str = "example_id", start: Trained | None = None,
                   prepare: Callable[[DataFrame, int], DataFrame] | None = None, dtype=np.float32, per_task: int | None = None,
                   count_gradients: bool = False) -> Trained:
    """Train on rows with `ident`, `pixels`, `label`, one pass over the rows per round.

    Stops after `rounds` rounds, after `steps` steps, or when a callback returns
    True. `prepare(rows, round)` is applied to the rows each round, for instance
    the distortion chain. `start` goes on from an earlier state. Without `shards` there are as many as
    give each LOCAL_STEPS mini-batches a round. `per_task` shards (a power of two) share a task; it does not change the result.
    `count_gradients` keeps histograms of the gradients (see `gradient_histogram`).
    """
    spark = df.sparkSession
    rate = lr if callable(lr) else (lambda step: lr)
    shards = shards or shards_for(df.count(), batch)
    per_task = per_task or shards_per_task(spark, shards)
    trained = start or start_training(spark, model, optimizer, seed, ema, dtype)
    columns = [c for c in (ident, "pixels", "label", "height", "width", "depth") if c in df.columns]
    laid = lay_out(df.select(*columns), shards, ident, per_task).persist(StorageLevel.MEMORY_AND_DISK)
    own = None if start else trained.table
    try:
        while trained.round < rounds and (steps is None or trained.step < steps):
            limit = None if steps is None else steps - trained.step
            before = trained.step
            trained = train_round(laid, model, trained, optimizer=optimizer, batch=batch, rate=rate, seed=seed,
                                  ident=ident, limit=limit, ema=ema, prepare=prepare, dtype=dtype, per_task=per_task,
                                  count_gradients=count_gradients)
            if trained.step == before:
                break
            drop_table(own)  # of the round before
            own = trained.table
            if any([callback(trained) for callback in callbacks]):
                break
    finally:
        laid.unpersist()
    return trained


def drop_table(table: StateTable | None) -> None:
    """Delete a version that is not needed any more."""
    if table:
        system, inner = filesystem(table.path)
        with contextlib.suppress(OSError):
            system.delete_dir(inner)


def step_events(spark: SparkSession, trained: Trained) -> DataFrame:
    """EVENTS_SCHEMA: every step of every shard since the training began, as its tasks wrote it."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(trained.log) if trained.log else spark.createDataFrame([], EVENTS_SCHEMA)


def step_log(events: DataFrame) -> DataFrame:
    """Rows (run, step, ts, loss) of step events: input of the series operators. A run is a shard, and steps count from 0."""
    return events.select(F.col("shard").alias("run"), (F.col("step") - 1).alias("step"), "ts", "loss")


def metrics_frame(spark: SparkSession, trained: Trained) -> DataFrame:
    """Metrics of each round, as rows."""
    return spark.createDataFrame(trained.metrics, METRICS_SCHEMA)


def weight_rows(spark: SparkSession, params: Params) -> DataFrame:
    """One row per weight of a softmax model: tensor, row, col, value."""
    return spark.createDataFrame(
        [(name, i, j, float(v)) for name, value in sorted(params.items()) for i, line in enumerate(np.atleast_2d(value))
         for j, v in enumerate(line)], "tensor string, row int, col int, value double")


def weight_values(weights: DataFrame) -> DataFrame:
    """One row per weight (model, step, tensor, value): input of the summary and histogram operators."""
    return weights.select("model", "step", "tensor", F.explode("values").alias("value"))


def evaluate_each_round(df: DataFrame, model: dict, results: list) -> Callable[[Trained], None]:
    """Callback that appends (round, step, accuracy, loss) on a table the training does not see."""
    def run(trained: Trained) -> None:
        row = evaluate_model(df, model, trained.weights(), trained.step).first()
        results.append((trained.round, trained.step, row.accuracy, row.loss))
    return run


def metrics_each_round(spark: SparkSession, path: str, run: str) -> Callable[[Trained], None]:
    """Callback that appends the metric rows of the round just done."""
    def write(trained: Trained) -> None:
        latest = [m for m in trained.metrics if m[0] == trained.round - 1]
        write_metrics(spark.createDataFrame(latest, METRICS_SCHEMA), path, run)
    return write


def save_state(spark: SparkSession, trained: Trained, path: str, model: str, step: int, notes: dict[str, list[int]]) -> None:
    """Checkpoint a written state and its notes: rows are copied from table to table."""
    rows = trained.table.rows(spark).where(~F.col("tensor").startswith("#")).unionByName(notes_frame(spark, notes, trained.table.dtype))
    checkpoint_weights(rows.select(F.lit(model).alias("model"), F.lit(step).cast("long").alias("step"), "tensor", "shape", "chunk",
                                   F.lit(rows.count()).cast("int").alias("parts"), "values"), path)


def saved_state(spark: SparkSession, path: str, model: str, dtype=np.float32) -> tuple[Trained, dict[str, list[int]]] | None:
    """The latest complete checkpoint and its notes; its rows stay where they are."""
    rows = restore_weights(spark, path, model)
    step = rows.agg(F.max("step")).first()[0]
    if step is None:
        return None
    table = StateTable(f"{qualified(spark, path).rstrip('/')}/model={model}/step={step}", np.dtype(dtype).name)
    return Trained(table, int(step)), read_notes(rows)


def save_each_round(spark: SparkSession, path: str, model: str) -> Callable[[Trained], None]:
    """Callback that checkpoints the weights after each round."""
    def save(trained: Trained) -> None:
        save_state(spark, trained, path, model, trained.step, {"round": [trained.round]})
    return save


def resume(spark: SparkSession, path: str, model: str, dtype=np.float32) -> Trained:
    """State of the latest complete checkpoint."""
    found = saved_state(spark, path, model, dtype)
    if found is None:
        raise FileNotFoundError(f"no complete checkpoint of {model} below {path}")
    trained, notes = found
    trained.round = notes["round"][0]
    return trained
