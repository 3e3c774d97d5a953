"""Scoring of example tables with a model whose weights are broadcast, or read by the tasks from a written state."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.vectors import argmax, softmax
from .images import DOUBLES, block_array
from .layers import Params, forward
from .metrics import evaluate
from .state import Weights

# A model is copied to every executor, so its size is checked before it is broadcast.
MAX_MODEL_BYTES = 1 << 30


def broadcast_params(spark: SparkSession, params: Params | Weights):
    """Something whose `value` is the weights in a task. Weights of a written state are read there."""
    if isinstance(params, Weights):
        return params
    size = sum(v.nbytes for v in params.values())
    if size > MAX_MODEL_BYTES:
        raise ValueError(f"model of {size} bytes does not fit an executor; the limit is {MAX_MODEL_BYTES}")
    return spark.sparkContext.broadcast(params)


def matrix(vectors: pa.Array) -> np.ndarray:
    """list<number> column of equally long vectors -> [n, d] doubles."""
    values = np.asarray(vectors.flatten()).astype(np.float64)
    sizes = np.asarray(vectors.value_lengths())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of different length")
    return values.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def logits_column(spark: SparkSession, model: dict, params: Params | Weights, pixels: str = "pixels", batch: int = 32) -> Column:
    """Column of logits; only the pixel column goes to Python, `batch` rows at a time."""
    shared = broadcast_params(spark, params)

    @arrow_udf(DOUBLES)
    def run(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.list_(pa.float64()))
        return block_array(np.concatenate([forward(model, shared.value, matrix(column.slice(i, batch)))[0]
                                           for i in range(0, len(column), batch)]))

    return run(pixels)


def score_dense(df: DataFrame, model: dict, params: Params | Weights, pixels: str = "pixels", name: str = "logits") -> DataFrame:
    """Logits of a stack of dense layers."""
    return df.withColumn(name, logits_column(df.sparkSession, model, params, pixels, 4096))


def score_cnn(df: DataFrame, model: dict, params: Params | Weights, pixels: str = "pixels", batch: int = 32,
              name: str = "logits") -> DataFrame:
    """Logits of a convolutional model."""
    return df.withColumn(name, logits_column(df.sparkSession, model, params, pixels, batch))


def predict_batches(df: DataFrame, model: dict, params: Params | Weights, pixels: str = "pixels") -> DataFrame:
    """Logits, probabilities and predicted class of each row."""
    scored = score_cnn(df, model, params, pixels)
    return scored.withColumns({"prediction": argmax("logits"), "probabilities": softmax("logits")})


def evaluate_model(df: DataFrame, model: dict, params: Params | Weights, step: int = 0, pixels: str = "pixels",
                   label: str = "label") -> DataFrame:
    """Accuracy, loss, rows and global step of a model on a table, in one pass."""
    return evaluate(score_cnn(df, model, params, pixels), label, "logits", step)


def layer_outputs(df: DataFrame, model: dict, params: Params | Weights, ident: str = "example_id", pixels: str = "pixels",
                  batch: int = 32) -> DataFrame:
    """Activations of every layer: ident, tag, values. Input of the histogram and sparsity operators."""
    shared = broadcast_params(df.sparkSession, params)

    def run(batches):
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                outputs = []
                forward(model, shared.value, matrix(rows.column(1).slice(i, batch)), outputs=outputs)
                for tag, values in outputs:
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0).slice(i, batch), pa.array([tag] * len(values)), block_array(values)],
                        names=[ident, "tag", "values"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(ident, pixels).mapInArrow(run, f"`{ident}` {kind}, tag string, values array<double>")


def activation_summary(df: DataFrame, model: dict, params: Params | Weights, pixels: str = "pixels", batch: int = 32) -> DataFrame:
    """mean, stddev, min, max and sparsity of the activations of each layer.

    A task sends one row per layer: count, mean, sum of squares about that mean, bounds and zeros. Squares are always
    about a mean, so a large mean does not cancel a small variance.
    """
    shared = broadcast_params(df.sparkSession, params)

    def run(batches):
        sums: dict[str, list] = {}
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                outputs = []
                forward(model, shared.value, matrix(rows.column(0).slice(i, batch)), outputs=outputs)
                for tag, values in outputs:
                    n, mean = values.size, values.mean()
                    new = [n, mean, ((values - mean) ** 2).sum(), values.min(), values.max(), (values == 0).sum()]
                    sums[tag] = _merge(sums[tag], new) if tag in sums else new
        if sums:
            columns = list(zip(*sums.values()))
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), *(pa.array([float(x) for x in c]) for c in columns)],
                                             names=["tag", "n", "mean", "m2", "lo", "hi", "z"])

    parts = df.select(pixels).mapInArrow(run, "tag string, n double, mean double, m2 double, lo double, hi double, z double")
    pivot = parts.groupBy("tag").agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("__mean"))
    about = F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("__mean"), 2)
    return (parts.join(pivot, "tag").groupBy("tag", "__mean")
            .agg(F.sum(about).alias("__m2"), F.sum("n").alias("__n"), F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("z").alias("__z"))
            .select("tag", F.col("__mean").alias("mean"), F.sqrt(F.col("__m2") / F.col("__n")).alias("stddev"), "min", "max",
                    (F.col("__z") / F.col("__n")).alias("sparsity")))


def _merge(a: list, b: list) -> list:
    """Count, mean, squares about the mean, bounds and zeros of two sets of values together."""
    n, shift = a[0] + b[0], b[1] - a[1]
    return [n, a[1] + shift * b[0] / n, a[2] + b[2] + shift * shift * a[0] * b[0] / n, min(a[3], b[3]), max(a[4], b[4]), a[5] + b[5]]
