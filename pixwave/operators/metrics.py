"""Evaluation and telemetry aggregates. All of them aggregate partially before any shuffle."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import learning_rate, strip_tower
from ..functions.vectors import argmax, onehot_cross_entropy, softmax, sparse_cross_entropy

SALTS = 32  # copies of the bounds of a tag


def argmax_decode(df: DataFrame, column: str = "logits", name: str = "prediction") -> DataFrame:
    return df.withColumn(name, argmax(column))


def softmax_probs(df: DataFrame, column: str = "logits", name: str = "probabilities") -> DataFrame:
    return df.withColumn(name, softmax(column))


def accuracy(df: DataFrame, by: str | None = None, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction is the label, overall or per `by`."""
    hit = F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)
    return df.groupBy(*([by] if by else [])).agg(F.avg(hit).alias("accuracy"))


def cross_entropy_value(label: str, logits: str, onehot: bool) -> Column:
    return onehot_cross_entropy(logits, label) if onehot else sparse_cross_entropy(logits, label)


def cross_entropy(df: DataFrame, label: str = "label", logits: str = "logits", onehot: bool = False) -> DataFrame:
    """Mean softmax cross-entropy; `label` is a class index, or a class vector with `onehot`."""
    return df.agg(F.avg(cross_entropy_value(label, logits, onehot)).alias("cross_entropy"))


def total_loss(df: DataFrame, weights: DataFrame, wd: dict[str, float], label: str = "label",
               logits: str = "logits") -> DataFrame:
    """Mean cross-entropy plus sum of wd * 1/2 * sum(w^2) over the decayed tensors.

    weights: tensor, values (array). Both parts are one-row sums of one union.
    """
    data = df.agg(F.avg(cross_entropy_value(label, logits, False)).alias("part"))
    rates = F.lit(0.0)
    for tensor, rate in wd.items():
        rates = F.when(F.col("tensor") == tensor, F.lit(float(rate))).otherwise(rates)
    squares = F.aggregate("values", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    decay = weights.filter(F.col("tensor").isin(list(wd))).agg(
        F.coalesce(F.sum(rates * 0.5 * squares), F.lit(0.0)).alias("part"))
    return data.unionByName(decay).agg(F.sum("part").alias("total_loss"))


def tensor_summary(df: DataFrame, tag: str | Sequence[str], column: str) -> DataFrame:
    """mean, population stddev, min and max of a value per tag."""
    tags = [tag] if isinstance(tag, str) else list(tag)
    return df.groupBy(*tags).agg(F.avg(column).alias("mean"), F.stddev_pop(column).alias("stddev"),
                                 F.min(column).alias("min"), F.max(column).alias("max"))


def histogram(df: DataFrame, tag: str | Sequence[str], column: str, bins: int = 30) -> DataFrame:
    """Counts of `bins` equal buckets between minimum and maximum of each tag.

    The largest value belongs to the last bucket; a constant tag has bucket 0
    only. NaN and null values are left out; a null tag is a tag. The bounds are
    joined by tag, a struct that compares nulls as equal. Values are dealt over
    SALTS copies of the bounds, so a tag with most of the values is many keys.
    """
    tags = [tag] if isinstance(tag, str) else list(tag)
    key = F.struct(*[F.col(f"`{t}`").alias(t) for t in tags]).alias("__key")
    values = df.select(key, F.col(column).cast("double").alias("__v")).filter(~F.isnan("__v"))
    bounds = (values.groupBy("__key").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
              .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = values.withColumn("__salt", F.pmod(F.xxhash64("__v"), F.lit(SALTS)).cast("int"))
    place = F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins)
    bucket = F.when(F.col("__hi") > F.col("__lo"), F.least(place, F.lit(bins - 1))).otherwise(F.lit(0))
    width = (F.col("__hi") - F.col("__lo")) / bins
    counted = (salted.join(bounds, ["__key", "__salt"]).groupBy("__key", "__lo", "__hi", bucket.cast("int").alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n")))
    return counted.select("__key.*", "bucket", (F.col("__lo") + F.col("bucket") * width).alias("lower"),
                          (F.col("__lo") + (F.col("bucket") + 1) * width).alias("upper"), "n")


# A bucket is the sign of a value times its binary exponent, counted from 1 for the smallest positive number; 0 is zero.
LEAST_EXPONENT = -1075


def exponent_bounds(bucket: Column | str) -> tuple[Column, Column]:
    """Where the values of an exponent bucket lie: the end nearer to zero and the farther one, in the order of the numbers."""
    b = F.col(bucket) if isinstance(bucket, str) else bucket
    near, far = (F.pow(F.lit(2.0), F.abs(b) + LEAST_EXPONENT - 1 + i) * F.signum(b.cast("double")) for i in (0, 1))
    return F.when(b < 0, far).when(b == 0, 0.0).otherwise(near), F.when(b < 0, near).when(b == 0, 0.0).otherwise(far)


def exponent_histogram(df: DataFrame, tag: str | Sequence[str], column: str) -> DataFrame:
    """Counts of the values of each tag by sign and binary exponent: tag, bucket, lower, upper, n.

    The buckets are the same for all data, so counts of parts add up, in one pass and without bounds. Null, NaN and infinite values are left out.
    """
    tags = [tag] if isinstance(tag, str) else list(tag)
    v = F.col("__v")
    size = F.abs(v)
    guess = F.floor(F.log2(size))
    # the logarithm may be off by a bit next to a power of two
    exponent = F.when(size >= F.pow(F.lit(2.0), guess + 1), guess + 1).when(size < F.pow(F.lit(2.0), guess), guess - 1).otherwise(guess)
    bucket = F.when(v == 0, 0).otherwise(F.signum(v) * (exponent + 1 - LEAST_EXPONENT)).cast("int")
    values = df.select(*tags, F.col(column).cast("double").alias("__v")).where(F.abs("__v") < float("inf"))
    counted = values.select(*tags, bucket.alias("bucket")).groupBy(*tags, "bucket").agg(F.count(F.lit(1)).alias("n"))
    lower, upper = exponent_bounds("bucket")
    return counted.select(*tags, "bucket", lower.alias("lower"), upper.alias("upper"), "n")


def sparsity(df: DataFrame, tag: str, column: str) -> DataFrame:
    """Share of exact zeros per tag."""
    return df.groupBy(tag).agg(F.avg(F.when(F.col(column) == 0, 1.0).otherwise(0.0)).alias("sparsity"))


def validate_examples(df: DataFrame, pixels: str = "pixels", label: str = "label") -> DataFrame:
    """Counts and shape facts of an example table, in one row."""
    size = F.size(pixels)
    return df.agg(
        F.count(F.lit(1)).alias("num_rows"), F.count(pixels).alias("num_images"), F.count(label).alias("num_labels"),
        F.min(size).alias("min_size"), F.max(size).alias("max_size"),
        F.count_if(size != F.col("height") * F.col("width") * F.col("depth")).alias("bad_shape"),
        F.count_if(F.col("depth") != 1).alias("not_depth_1"))


def check_examples(df: DataFrame) -> None:
    """Raise if images and labels differ in number or a pixel vector does not match its shape."""
    facts = validate_examples(df).first()
    if facts.num_images != facts.num_labels:
        raise ValueError(f"{facts.num_images} images but {facts.num_labels} labels")
    if facts.bad_shape:
        raise ValueError(f"{facts.bad_shape} images whose size does not match their shape")


def nan_guard(df: DataFrame, column: str) -> DataFrame:
    """Number of NaN values of a column."""
    return df.agg(F.count_if(F.isnan(F.col(column).cast("double"))).alias("nan_count"))


def stop_on_nan(df: DataFrame, column: str) -> None:
    if nan_guard(df, column).first().nan_count:
        raise ArithmeticError(f"{column} is NaN")


def evaluate(scored: DataFrame, label: str = "label", logits: str = "logits", step: int = 0) -> DataFrame:
    """Accuracy, loss, number of rows and global step of scored rows, in one pass."""
    hit = F.when(argmax(logits) == F.col(label), 1.0).otherwise(0.0)
    return scored.agg(F.avg(hit).alias("accuracy"), F.avg(sparse_cross_entropy(logits, label)).alias("loss"),
                      F.count(F.lit(1)).alias("n"), F.lit(step).cast("long").alias("global_step"))


def lr_schedule(df: DataFrame, lr0: float = 0.1, factor: float = 0.1, decay_steps: int = 136_718,
                step: str = "step") -> DataFrame:
    return df.withColumn("learning_rate", learning_rate(step, lr0, factor, decay_steps))


def clean_metric_tag(df: DataFrame, column: str = "tag") -> DataFrame:
    return df.withColumn(column, strip_tower(column))


def every_n_steps(df: DataFrame, n: int, step: str = "step") -> DataFrame:
    return df.filter(F.col(step) % n == 0)
