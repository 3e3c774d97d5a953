"""Sinks for examples, clips, predictions, weights and metrics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import prediction_line
from ..functions.vectors import to_csv

WEIGHTS_SCHEMA = "model string, step long, tensor string, shape array<int>, chunk int, parts int, values array<double>"


def csv_lines(df: DataFrame, column: str, ident: str = "example_id") -> DataFrame:
    """`id<TAB>v,v,...` lines of an array column (and the split, if there is one)."""
    line = F.concat(F.col(ident).cast("string"), F.lit("\t"), to_csv(column)).alias("value")
    return df.select(line, *([F.col("split")] if "split" in df.columns else []))


def _write_text(lines: DataFrame, path: str, mode: str) -> None:
    writer = lines.write.mode(mode)
    (writer.partitionBy("split") if "split" in lines.columns else writer).text(path)


def write_csv_vectors(df: DataFrame, path: str, image: str = "pixels", target: str = "target",
                      mode: str = "errorifexists") -> None:
    """Vectors as text below `images` and `labels`, one folder per split; both carry the id."""
    _write_text(csv_lines(df, image), f"{path}/images", mode)
    _write_text(csv_lines(df, target), f"{path}/labels", mode)


def labelled_lines(df: DataFrame, image: str = "pixels", target: str = "target") -> DataFrame:
    return df.select(F.concat_ws("|", to_csv(target), to_csv(image)).alias("value"),
                     *([F.col("split")] if "split" in df.columns else []))


def write_labelled_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """`label-vector|pixels` lines, one folder per split."""
    _write_text(labelled_lines(df), path, mode)


def write_examples(df: DataFrame, path: str, partitions: int | None = None, mode: str = "errorifexists") -> None:
    """Examples as Parquet, one folder per split; in `partitions` parts, or in as many as `df` has."""
    writer = (df.repartition(partitions) if partitions else df).write.mode(mode)
    (writer.partitionBy("split") if "split" in df.columns else writer).parquet(path)


def write_clips(df: DataFrame, path: str, mode: str = "errorifexists", folders: bool = False) -> None:
    """Clip parts as Parquet, in the order of episode, number and part.

    The order lets a reader of one episode skip the other files, with any number
    of episodes; a large episode takes several files. `folders` writes one folder
    per episode instead, for a moderate number of them.
    """
    order = ["episode", "num", "part_no"]
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = sorted_rows.write.mode(mode)
    (writer.partitionBy("episode") if folders else writer).parquet(path)


def prediction_lines(df: DataFrame, ts="ts", label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.select(prediction_line(ts, label, prediction).alias("value"))


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Predictions as a table below `table` and as text lines below `text`.

    The lines are made from the written table, so the model runs once.
    """
    df.write.mode(mode).parquet(f"{path}/table")
    prediction_lines(df.sparkSession.read.schema(df.schema).parquet(f"{path}/table")).write.mode(mode).text(f"{path}/text")


def checkpoint_weights(weights: DataFrame, path: str) -> None:
    """Save weight rows (WEIGHTS_SCHEMA) by model and step; saving a step again replaces it.

    When the rows are there, the step is noted in the small table `_steps`, which readers of the weights skip.
    """
    (weights.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("model", "step").parquet(path))
    weights.select("model", "step").distinct().write.mode("append").parquet(f"{path}/_steps")


def restore_weights(spark: SparkSession, path: str, model: str) -> DataFrame:
    """Weight rows of the latest complete step: the one whose `parts` rows are all there.

    Noted steps are tried from the last one on, so that as a rule only the rows of one step are read.
    """
    table = spark.read.schema(WEIGHTS_SCHEMA).parquet(path).filter(F.col("model") == model)
    noted = spark.read.schema("model string, step long").parquet(f"{path}/_steps").filter(F.col("model") == model)
    for noted_step in noted.select("step").distinct().orderBy(F.desc("step")).toLocalIterator():
        rows = table.filter(F.col("step") == noted_step.step)
        if rows.agg(F.count(F.lit(1)) == F.max("parts")).first()[0]:
            return rows
    return table.limit(0)


def write_metrics(df: DataFrame, path: str, run: str, mode: str = "append") -> None:
    """Append metric rows, one folder per run."""
    df.withColumn("run", F.lit(run)).write.mode(mode).partitionBy("run").parquet(path)


def verify_examples(df: DataFrame, n: int = 10, ident: str = "example_id", image: str = "pixels",
                    target: str = "label") -> DataFrame:
    """First `n` examples, each with the number of images and of labels of the whole table.

    Differing numbers are an error.
    """
    counts = df.agg(F.count(image).alias("i"), F.count(target).alias("l"))
    images, labels = counts.select("i").scalar(), counts.select("l").scalar()
    error = F.raise_error(F.lit("images and labels differ in number")).cast("long")
    return (df.orderBy(ident).limit(n)
            .withColumns({"num_images": F.when(images == labels, images).otherwise(error), "num_labels": labels}))
