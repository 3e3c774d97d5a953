"""Epochs, shuffles and batches as columns: (epoch, rank) and (step, slot)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_key, hash_uniform, key_uniform
from .index import default_buckets, global_index, hash_bucket


def shuffle_epoch(df: DataFrame, ident: str = "example_id", seed: int = 0, epoch=0, name: str = "rank", *,
                  buckets: int | None = None, total: str | None = None) -> DataFrame:
    """Add the place of each row in the permutation of (seed, epoch).

    `epoch` is a number, or the name of a column to permute each epoch by itself.
    The order is that of the md5 digest, whose first bits are an evenly spread
    bucket. `ident` must identify a row.
    """
    by = [epoch] if isinstance(epoch, str) else []
    keyed = df.withColumn("__key", hash_key(seed, epoch, "shuffle", ident))
    bucket = hash_bucket(key_uniform(F.col("__key")), buckets or default_buckets(df))
    return global_index(keyed, ["__key", ident], name, by=by, bucket=bucket, total=total).drop("__key")


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Each row once per epoch."""
    if epochs < 1:
        return df.withColumn("epoch", F.lit(0)).limit(0)
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def assign_batches(df: DataFrame, batch: int, epochs: int = 1, seed: int = 0, policy: str = "wrap",
                   shuffle: bool = True, ident: str = "example_id", *, block: int = 1 << 17,
                   buckets: int | None = None) -> DataFrame:
    """Add `epoch`, `step` and `slot`.

    `wrap`: batches run over the epoch border, the rest of one epoch and the
    start of the next form one batch. `partial`: each epoch ends with a short
    batch. Without `shuffle` every epoch is in `ident` order. `ident` must identify a row.
    """
    if policy not in ("wrap", "partial"):
        raise ValueError(f"unknown policy: {policy}")
    # only ids are ranked; the other columns join them once, keyed by a struct, which compares nulls as equal
    rows = repeat_epochs(df.select(ident), epochs)
    if shuffle:
        ranked = shuffle_epoch(rows, ident, seed, "epoch", "__rank", buckets=buckets, total="__total")
    else:
        ranked = global_index(rows, ident, "__rank", by=["epoch"], block=block, total="__total")
    rank, total, epoch = F.col("__rank"), F.col("__total"), F.col("epoch")
    if policy == "wrap":
        position = epoch * total + rank
        step = F.floor(position / batch)
    else:
        position = rank
        step = epoch * F.ceil(total / batch) + F.floor(rank / batch)
    placed = ranked.select(F.struct(F.col(ident).alias("id")).alias("__id"), "epoch", step.cast("long").alias("step"),
                           (position % batch).cast("int").alias("slot"))
    payload = df.drop("epoch", "step", "slot").withColumn("__id", F.struct(F.col(ident).alias("id")))
    return payload.join(placed, "__id").drop("__id")


def bootstrap_batches(df: DataFrame, batch: int, steps: int, seed: int = 0, ident: str = "example_id", *,
                      block: int = 1 << 17) -> DataFrame:
    """`steps` batches drawn uniformly with replacement from the rows of `df`."""
    spark = df.sparkSession
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    draws = spark.range(steps * batch).select(
        F.floor(F.col("id") / batch).alias("step"),
        (F.col("id") % batch).cast("int").alias("slot"),
        F.floor(hash_uniform(seed, 0, "bootstrap", "id") * rows).alias("__idx"),
    )
    return draws.join(global_index(df, ident, "__idx", block=block), "__idx").drop("__idx")


def preview(df: DataFrame, n: int = 10, order: str = "example_id") -> DataFrame:
    """The first `n` rows in order (a top-k, not a sort of the table)."""
    return df.orderBy(order).limit(n)


def explode_batches(df: DataFrame, data: str = "data", labels: str = "labels", batch: str = "batch") -> DataFrame:
    """Batch rows (list of pixel vectors, list of labels) -> one row per example: batch, offset, pixels, label.

    Lists of different length are an error.
    """
    error = F.raise_error(F.concat(F.lit("images and labels differ in number in batch "),
                                   F.col(batch).cast("string")))
    kind = df.schema[data].dataType.elementType.simpleString()
    pairs = F.arrays_zip(F.col(data).alias("pixels"), F.col(labels).alias("label"))
    checked = F.when(F.size(data) == F.size(labels), pairs).otherwise(
        error.cast(f"array<struct<pixels:{kind},label:{df.schema[labels].dataType.elementType.simpleString()}>>"))
    return (df.select(batch, F.posexplode(checked).alias("offset", "__pair"))
            .select(batch, "offset", "__pair.pixels", F.col("__pair.label").cast("int").alias("label")))
