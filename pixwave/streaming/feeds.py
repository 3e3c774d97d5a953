"""Streams of examples from fixed-length records, IDX images, TFRecord files and labelled CSV lines.

Spark's file source notes in the checkpoint which files were seen, so a query that is started again goes on with the others. Only
paths travel in the stream; the tasks of a micro-batch read the byte ranges of its files with the readers of the batch sources.
Every feed has example_id, height, width, depth, label and pixels (array<double>), as `learning` takes them.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import class_index, from_csv
from ..sources.files import TARGET_BYTES, Slice, Slices, byte_ranges, file_stream
from ..sources.records import RECORD_SCHEMA, FixedRecordReader, IdxReader, IdxSlice
from ..sources.tfrecord import RecordSlice, TFRecordReader

IDX_SCHEMA = "file string, idx long, height int, width int, depth int, label int, pixels array<short>"


def _read(ranges: DataFrame, read: Callable[[dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`read` on every range, the ranges of a micro-batch spread over the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read(row)

    return ranges.repartition("path", "start").mapInArrow(run, schema)


def _examples(rows: DataFrame, ident: Column) -> DataFrame:
    return rows.select(ident.cast("long").alias("example_id"), "height", "width", "depth", "label", F.col("pixels").cast("array<double>").alias("pixels"))


def record_feed(spark: SparkSession, path: str, shape=(3, 32, 32), label_bytes: int = 1, files_per_trigger: int = 8,
                target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Fixed-length labelled records. The id is a hash of file and place; a file that is not whole records fails the query."""
    options = {"path": path, "shape": ",".join(map(str, shape)), "label_bytes": str(label_bytes)}
    size = label_bytes + int(np.prod(shape))

    def read(row: dict) -> Iterator[pa.RecordBatch]:
        if row["length"] % size:
            raise ValueError(f"{row['path']}: {row['length']} bytes are not whole records of {size} bytes")
        reader = FixedRecordReader(options, [f.split()[0] for f in RECORD_SCHEMA.split(", ")])
        yield from reader.read(Slices([Slice(row["path"], row["start"] // size, (row["stop"] - row["start"]) // size)]))

    rows = _read(byte_ranges(file_stream(spark, path, files_per_trigger), target_bytes, size), read, RECORD_SCHEMA)
    return _examples(rows, F.xxhash64("key"))


def idx_feed(spark: SparkSession, path: str, labels: tuple[str, str] = ("images-idx3", "labels-idx1"), files_per_trigger: int = 8,
             target_bytes: int = TARGET_BYTES) -> DataFrame:
    """IDX images, each with the label file whose path has the second string in place of the first; it must be there before the images.

    Files whose path has not the first string are left out. Gzip files are read by one task each.
    """
    images, names = labels

    def read(row: dict) -> Iterator[pa.RecordBatch]:
        label_path = names.join(row["path"].rsplit(images, 1))
        count, height, width = IdxReader._shape(row["path"], label_path)
        zipped, size = row["path"].endswith(".gz") or label_path.endswith(".gz"), max(1, height * width)
        # images that begin in the range; of a file that can not be cut the first range has them all
        first, last = (0 if at == 0 else count if at == row["length"] else max(0, min(count, -(-(at - 16) // size))) for at in (row["start"], row["stop"]))
        if zipped:
            first, last = 0, count if row["start"] == 0 else 0
        if last > first:
            for batch in IdxReader({"path": path, "labels": label_path}).read(Slices([IdxSlice(row["path"], first, last - first, 0, (height, width), label_path)])):
                yield batch.drop_columns(["example_id"])

    files = file_stream(spark, path, files_per_trigger).where(F.col("path").contains(images))
    return _examples(_read(byte_ranges(files, target_bytes), read, IDX_SCHEMA), F.xxhash64("file", "idx"))


def tfrecord_feed(spark: SparkSession, path: str, shape=(32, 32, 3), image: str = "image", label: str = "label", ident: str | None = None,
                  files_per_trigger: int = 8) -> DataFrame:
    """Examples of TFRecord files, a file to a task. The id is the value of the field `ident`, or a hash of file and place."""
    names = [image, label, *([ident] if ident else [])]
    schema = "path string, file_no int, record_no long, " + ", ".join(f"`{n}` array<long>" for n in names)

    def read(row: dict) -> Iterator[pa.RecordBatch]:
        for batch in TFRecordReader(path, names, TARGET_BYTES, None).read(Slices([RecordSlice(row["path"], 0, -1)])):
            yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * batch.num_rows), *batch.columns], names=["path", *batch.schema.names])

    rows = _read(byte_ranges(file_stream(spark, path, files_per_trigger), 1 << 62), read, schema)
    height, width, depth = shape
    ready = rows.withColumns({"height": F.lit(height), "width": F.lit(width), "depth": F.lit(depth)})
    number = F.get(f"`{ident}`", F.lit(0)) if ident else F.xxhash64("path", "record_no")
    return _examples(ready.withColumns({"__id": number, "pixels": F.col(f"`{image}`"), "label": F.get(f"`{label}`", F.lit(0)).cast("int")}), F.col("__id"))


def csv_feed(spark: SparkSession, path: str, shape=(32, 32, 3), files_per_trigger: int = 8) -> DataFrame:
    """`label-vector|pixels` lines. The id is a hash of the file, the range it was read in and the line."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)
    cut = F.split("value", "\\|", 2)
    height, width, depth = shape
    ready = lines.select(F.xxhash64("_metadata.file_path", "_metadata.file_block_start", "value").alias("__id"), from_csv(F.get(cut, F.lit(0)), "double").alias("target"),
                         from_csv(F.get(cut, F.lit(1)), "double").alias("pixels"), F.lit(height).alias("height"), F.lit(width).alias("width"), F.lit(depth).alias("depth"))
    return _examples(ready.withColumn("label", class_index("target")), F.col("__id"))
