"""spark-submit job: labelled image files -> examples as CSV, labelled CSV, Parquet or TFRecord, one folder per split.

    spark-submit --py-files pixwave.zip pixwave/jobs/prepare.py -i cifar/ -o out/ -f tfr --verify
"""

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixwave.functions.vectors import class_index
from pixwave.operators.images import one_hot
from pixwave.operators.index import global_index
from pixwave.session import build_session
from pixwave.sources import records, sinks, text, tfrecord


def arguments(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("-i", "--input", help="file or folder of fixed-length records, or of IDX images")
    p.add_argument("-l", "--labels", help="IDX labels; the input is then IDX")
    p.add_argument("--shape", default="3,32,32", help="depth, height, width of a record")
    p.add_argument("--test", default="test", help="files whose name holds this word are the test split")
    p.add_argument("--classes", type=int, default=10)
    p.add_argument("-f", "--format", choices=["csv", "csv2", "parquet", "tfr"], default="csv")
    p.add_argument("-n", "--num-partitions", type=int, help="number of output partitions; by default as many as the input has")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("-r", "--read", action="store_true", help="only read examples written before")
    p.add_argument("-v", "--verify", action="store_true", help="read the examples back after writing")
    return p.parse_args(argv)


def read_input(spark: SparkSession, args) -> DataFrame:
    if args.labels:
        df = records.read_idx(spark, args.input, args.labels).withColumnRenamed("file", "key")
    else:
        shape = tuple(int(x) for x in args.shape.split(","))
        df = records.read_fixed_records(spark, args.input, shape)
    name = F.element_at(F.split("key", "/"), -1)
    split = F.when(name.contains(args.test), "test").otherwise("train")
    return one_hot(df, "label", args.classes).withColumn("split", split)


def write(df: DataFrame, args) -> None:
    rows = df.repartition(args.num_partitions) if args.num_partitions else df
    if args.format == "csv":
        sinks.write_csv_vectors(rows, args.output)
    elif args.format == "csv2":
        sinks.write_labelled_csv(rows, args.output)
    elif args.format == "parquet":
        sinks.write_examples(df, args.output, args.num_partitions)
    else:
        for split in ("train", "test"):
            part = rows.filter(F.col("split") == split).select(
                F.array("example_id").alias("id"), F.col("pixels").alias("image"), F.col("target").alias("label"))
            tfrecord.write_tfrecords(part, f"{args.output}/split={split}", ["image", "label", "id"])


def read_back(spark: SparkSession, path: str, fmt: str, split: str = "train") -> DataFrame:
    """Examples written by `write`: example_id, pixels, label."""
    if fmt == "csv":
        images = text.read_csv_vectors(spark, f"{path}/images/split={split}", "double", with_id=True)
        labels = text.read_csv_vectors(spark, f"{path}/labels/split={split}", "double", with_id=True)
        return images.withColumnRenamed("values", "pixels").join(
            labels.select("example_id", class_index("values").alias("label")), "example_id", "left")
    if fmt == "csv2":
        rows = text.read_labelled_csv(spark, f"{path}/split={split}", "double")
        numbered = global_index(rows, ["file", "block", "line"], "example_id", bucket=F.struct("file", "block"))
        return numbered.select("example_id", "pixels", class_index("target").alias("label"))
    if fmt == "parquet":
        return (spark.read.parquet(path).filter(F.col("split") == split)
                .select("example_id", F.col("pixels").cast("array<double>").alias("pixels"), "label"))
    rows = tfrecord.read_tfrecords(spark, f"{path}/split={split}", ["image", "label", "id"])
    return rows.select(F.col("id")[0].alias("example_id"), F.col("image").cast("array<double>").alias("pixels"),
                       class_index("label").alias("label"))


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or build_session("prepare")
    if not args.read:
        write(read_input(spark, args), args)
    if args.read or args.verify:
        for split in ("train", "test"):
            try:
                first = sinks.verify_examples(read_back(spark, args.output, args.format, split)).collect()
            except AnalysisException as e:  # an input without files of this split has no folder for it
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            print(split, "num_images:", first[0].num_images if first else 0)
            print(split, "num_labels:", first[0].num_labels if first else 0)
            for row in first:
                print(row.example_id, row.label, list(row.pixels[:8]), "...")


if __name__ == "__main__":
    main()
