"""File listing and record-aligned read ranges shared by the binary sources."""

import os
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import InputPartition

TARGET_BYTES = 128 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the file system Spark itself would use for it."""
    if "://" in path or path.startswith("file:/"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    if default.startswith("file:"):
        return os.path.abspath(path)
    return f"{default.rstrip('/')}/{path.lstrip('/')}"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or of any URI Arrow knows (hdfs, s3, gs, file)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the data files below `path` in name order; nothing there is an error."""
    system, inner = filesystem(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.is_file:
        return [(path, info.size)]
    found = [f for f in system.get_file_info(fs.FileSelector(inner, recursive=True))
             if f.is_file and not any(p[:1] in "._" for p in f.path[len(inner):].split("/") if p)]
    if not found:
        raise FileNotFoundError(f"no files below {path}")
    prefix = path[:len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted((prefix + f.path, f.size) for f in found)


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the files below `path`, listed by Spark: many folders are listed by tasks."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def file_stream(spark: SparkSession, path: str, files_per_trigger: int) -> DataFrame:
    """The same as a stream: Spark notes in the checkpoint which files were seen. Their content is not read."""
    return (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_trigger).load(path).select("path", "length"))


def byte_ranges(files: DataFrame, target: int, unit: int = 1, header: int = 0) -> DataFrame:
    """path, length, start, stop: whole units of about `target` bytes each, after the header."""
    step = max(1, target // unit) * unit
    at = F.sequence(F.lit(header), F.greatest(F.lit(header), F.col("length") - 1), F.lit(step).cast("long"))
    return (files.select("path", "length", F.explode(at).alias("start"))
            .withColumn("stop", F.least(F.col("start") + step, F.col("length"))))


@dataclass
class Slice:
    """Records [first, first + count) of one file; `base` is the id of its first record."""
    path: str
    first: int
    count: int
    base: int = 0


class Slices(InputPartition):
    """Slices one task reads; small files share a task, large ones are cut."""

    def __init__(self, slices: list[Slice]):
        super().__init__(None)
        self.slices = slices


def pack(slices: list[Slice], record_bytes: int, target: int = TARGET_BYTES) -> list[Slices]:
    """Cut and group slices into tasks of about `target` bytes, in file order."""
    limit = max(1, target // record_bytes)
    tasks: list[list[Slice]] = [[]]
    room = limit
    for s in slices:
        first, left = s.first, s.count
        while left > 0:
            if room == 0:
                tasks.append([])
                room = limit
            n = min(left, room)
            tasks[-1].append(Slice(s.path, first, n, s.base + first - s.first))
            first, left, room = first + n, left - n, room - n
    return [Slices(t) for t in tasks if t]


def pack_files(files: list[tuple[str, int]], target: int = TARGET_BYTES) -> list[Slices]:
    """Group whole files into tasks of about `target` bytes, for formats that cannot be cut."""
    tasks: list[list[Slice]] = []
    size = target
    for number, (path, nbytes) in enumerate(files):
        if size >= target:
            tasks.append([])
            size = 0
        tasks[-1].append(Slice(path, 0, nbytes, number))
        size += nbytes
    return [Slices(t) for t in tasks]
