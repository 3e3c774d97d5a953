"""Text datasets: CSV vectors, labelled CSV and subtitle files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_stem, plain_path, subtitle_fields
from ..functions.vectors import from_csv
from ..operators.index import global_index


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line, value, and the split if the folders name one.

    (file, block, line) orders the lines, also over several files and split
    files: `block` is the start of the file range a task reads and `line` rises
    inside it.
    """
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", *[c for c in lines.columns if c == "split"])


def read_csv_vectors(spark: SparkSession, path: str, dtype: str = "double", with_id: bool = False) -> DataFrame:
    """Comma-joined lines -> file, block, line, values; with `with_id` lines `id<TAB>vector` -> example_id, values.

    An empty line is an empty vector, an empty element an error.
    """
    lines = _lines(spark, path)
    split = [c for c in lines.columns if c == "split"]
    if not with_id:
        return lines.select("file", "block", "line", from_csv("value", dtype).alias("values"), *split)
    cut = F.split("value", "\t", 2)
    return lines.select(F.get(cut, F.lit(0)).cast("long").alias("example_id"),
                        from_csv(F.get(cut, F.lit(1)), dtype).alias("values"), *split)


def read_labelled_csv(spark: SparkSession, path: str, dtype: str = "int") -> DataFrame:
    """`label-vector|pixels` lines -> file, block, line, target, pixels."""
    cut = F.split("value", "\\|", 2)
    return _lines(spark, path).select("file", "block", "line", from_csv(F.get(cut, F.lit(0)), "double").alias("target"),
                                      from_csv(F.get(cut, F.lit(1)), dtype).alias("pixels"))


def read_subtitles(spark: SparkSession, path: str, marker: str = "---Sub-JP----", style: str = "Sub-Jap") -> DataFrame:
    """Subtitle files -> file, episode, num, dialogue, start_tc, end_tc.

    Lines after the first marker line of a file that hold the style name are
    dialogue, numbered from 0. Files are read by lines and in ranges, the marker
    is a minimum with partial aggregation and numbers are counted by range, so
    neither a file nor an episode has to fit one row or task.
    """
    lines = spark.read.text(path, recursiveFileLookup=True).select(
        plain_path("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")
    place = F.struct("block", "line")
    marked = (lines.filter(F.col("value").contains(marker)).groupBy("file").agg(F.min(place).alias("__marker")))
    spoken = lines.filter(F.col("value").contains(style)).join(marked, "file").filter(place > F.col("__marker"))
    numbered = global_index(spoken, ["block", "line"], "num", by=["file"], bucket=F.col("block"))
    return numbered.select("file", file_stem("file").alias("episode"), "num",
                           *[c.alias(n) for n, c in subtitle_fields("value").items()])


def parse_subtitle_lines(lines: DataFrame, episode: str = "episode", line_no: str = "line_no", line: str = "line",
                         marker: str = "---Sub-JP----", style: str = "Sub-Jap") -> DataFrame:
    """The same rule on a table of lines, for texts of any length.

    The marker line of an episode is a minimum with partial aggregation; rows
    keep their line number, which orders the dialogue.
    """
    marked = lines.filter(F.col(line).contains(marker)).groupBy(episode).agg(F.min(line_no).alias("__marker"))
    spoken = (lines.filter(F.col(line).contains(style)).join(marked, episode)
              .filter(F.col(line_no) > F.col("__marker")))
    return spoken.select(episode, line_no, *[c.alias(n) for n, c in subtitle_fields(line).items()])
