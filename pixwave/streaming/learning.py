"""Scoring and training on a stream of example files."""

from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layers import Params
from ..operators.scoring import predict_batches
from ..operators.state import Weights
from ..operators.training import (drop_table, lay_out, save_state, saved_state, shards_for, shards_per_task, start_training, train_round)

EXAMPLE_SCHEMA = "example_id long, height int, width int, depth int, label int, pixels array<double>"


def example_stream(spark: SparkSession, in_path: str, files_per_trigger: int, schema: str = EXAMPLE_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(in_path)


def stream_score(spark: SparkSession, in_path: str, out_path: str, model: dict, params: Params | Weights, *,
                 checkpoint: str, files_per_trigger: int = 8, schema: str = EXAMPLE_SCHEMA, feed: DataFrame | None = None):
    """Score example files as they arrive; ends when the files present at the start are done.

    `feed` is a stream of examples from another source (see `feeds`) instead of the Parquet files of `in_path`. Returns the finished query. The rows appear below `out_path` exactly once.
    """
    source = example_stream(spark, in_path, files_per_trigger, schema) if feed is None else feed
    scored = predict_batches(source, model, params)
    query = (scored.select("example_id", "label", "prediction", "probabilities").writeStream
             .format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


class _Enough(Exception):
    """The wanted number of steps is reached, and the feed has more."""


def train_on_batch(spark: SparkSession, batch: DataFrame, batch_id: int, weights_path: str, model: dict, *,
                   stream: str, optimizer: str = "sgd", lr: float = 0.1, size: int = 100, shards: int | None = None, seed: int = 0,
                   steps: int | None = None, ema: float | None = None, dtype=np.float32) -> bool:
    """Update the weights table with one micro-batch; whether all of it is learned now.

    Each batch makes the next version of the weights, whatever stream it comes
    from, and notes in it how far every stream is: its last batch, the steps taken in it, whether it is done, and the round
    that its order was drawn for. A batch that its own stream replays goes on where it stopped, and changes nothing if it was done; the numbers
    of other streams play no role. Weights go from table to table; the driver reads the notes.
    """
    try:
        found = saved_state(spark, weights_path, model["name"], dtype)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = None
    trained, notes = found or (start_training(spark, model, optimizer, seed, ema, dtype), {"step": [0]})
    version = trained.step if found else 0
    trained.step = notes["step"][0]
    last, taken, done, round_no = notes.get(f"stream {stream}", [-1, 0, 1, 0])
    if batch_id < last or (batch_id == last and done):
        return True
    if steps is not None and trained.step >= steps:
        return False
    skip, trained.round = (taken, round_no) if batch_id == last else (0, version)
    limit = None if steps is None else steps - trained.step
    rows = batch.select("example_id", "pixels", "label")
    shards = shards or shards_for(rows.count(), size)
    per_task = shards_per_task(spark, shards)
    before, own_round = trained.step, trained.round
    trained = train_round(lay_out(rows, shards, "example_id", per_task), model, trained, optimizer=optimizer, batch=size, rate=lambda step: lr,
                          seed=seed, ident="example_id", limit=limit, skip=skip, ema=ema, per_task=per_task, dtype=dtype)
    made = trained.step - before
    done = limit is None or made < limit
    notes |= {"step": [trained.step], f"stream {stream}": [batch_id, skip + made, int(done), own_round]}
    save_state(spark, trained, weights_path, model["name"], version + 1, notes)
    if made:
        drop_table(trained.table)
    return done


def stream_train(spark: SparkSession, in_path: str, model: dict, steps: int | None, weights_path: str, *,
                 checkpoint: str, stream: str | None = None, files_per_trigger: int = 8, schema: str = EXAMPLE_SCHEMA,
                 feed: DataFrame | None = None, on_batch: Callable[[int], None] | None = None, **options):
    """Train on example files as they arrive, one round per micro-batch, until `steps` or the end of the feed.

    `feed` is a stream of examples from another source (see `feeds`) instead of the Parquet files of `in_path`. `stream` names the feed; by default
    it is known by its checkpoint folder. A new feed, or a new checkpoint folder, goes on from the weights that are there.
    At `steps` the feed stops inside its micro-batch, which its checkpoint does not count as done: a later call with
    more steps learns the rest of it and what follows.
    """
    name, enough = stream or checkpoint, []

    def step(batch: DataFrame, batch_id: int) -> None:
        if not train_on_batch(batch.sparkSession, batch, batch_id, weights_path, model, stream=name, steps=steps, **options):
            enough.append(batch_id)
            raise _Enough(f"{steps} steps are reached in batch {batch_id}")
        if on_batch:
            on_batch(batch_id)

    source = example_stream(spark, in_path, files_per_trigger, schema) if feed is None else feed
    query = (source.writeStream.foreachBatch(step)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if not enough:
            raise
    return query
