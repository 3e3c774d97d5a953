"""Image, audio, subtitle and log tables derived from the given tables, for the registered queries."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import argmax
from ..operators import audio, images, layers, scoring
from ..operators.index import global_index
from ..sources.files import filesystem, qualified

SEED = 7
# Sample rate, piece length and highest frequency of the audio made from `events`.
FS, MINTIME, MAX_FREQUENCY = 160, 6, 50
# Samples per chunk row of that audio.
CHUNK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def img8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`embeddings` as 8 x 8 x 1 images of 0..255."""
    def pixel(v: Column) -> Column:
        return F.least(F.lit(255), F.greatest(F.lit(0), F.floor((v.cast("double") + 1) * 127.5).cast("int")))

    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("example_id"), F.lit(8).alias("height"), F.lit(8).alias("width"),
        F.lit(1).alias("depth"), F.col("label").cast("int").alias("label"),
        F.transform("embedding", pixel).alias("pixels"))


def sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as samples: file = user, position = rank of the event within the user."""
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("file"), "event_id", "value")
    return global_index(events, "event_id", "pos", by=["file"], total="n_frames").select("file", "pos", "n_frames", "value")


def sig_chunks(spark: SparkSession, sf_dir: str, fs: int = FS) -> DataFrame:
    return audio.pack_samples(sig(spark, sf_dir), "file", "pos", "value", fs, CHUNK)


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a training log: run = event type, step = rank of the event within the run."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("run"), "event_id", "ts",
                                                   F.col("value").alias("loss"))
    return global_index(events, "event_id", "step", by=["run"]).select("run", "step", "ts", "loss")


def _timecode(seconds: Column) -> Column:
    minutes = F.floor(seconds / 60)
    return F.format_string("0:%02d:%05.2f", minutes, seconds - minutes * 60)


def subtitle_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` as lines of subtitle files: a header, the marker, then one event line per turn."""
    talk = table(spark, sf_dir, "conversations")
    start = F.col("turn") * 7 + F.lit(0.25)
    text = F.regexp_replace("text", "[\r\n]|,,", " ")
    event = F.concat(F.lit("Dialogue: 0,"), _timecode(start), F.lit(","), _timecode(start + 2.5),
                     F.lit(",Sub-Jap,,0,0,0,,"), text)
    spoken = talk.select(F.col("conv_id").alias("episode"), (F.col("turn") + 2).alias("line_no"), event.alias("line"))
    head = F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("line_no"), F.lit("Dialogue: 0,Sub-Jap before the marker").alias("line")),
        F.struct(F.lit(1).cast("long").alias("line_no"), F.lit("; ---Sub-JP----").alias("line"))))
    heads = talk.select(F.col("conv_id").alias("episode")).distinct().select("episode", head.alias("h"))
    return spoken.unionByName(heads.select("episode", "h.line_no", "h.line"))


def formula_weights(inputs: int = 64, classes: int = 10) -> np.ndarray:
    i, j = np.arange(inputs)[:, None], np.arange(classes)[None, :]
    return ((31 * i + 17 * j) % 23 - 11) / 11


def dense_model(inputs: int = 64) -> tuple[dict, dict]:
    # the small biases keep two classes from having exactly the same logit
    return layers.softmax_model(inputs), {"w0": formula_weights(inputs), "b0": np.arange(10) / 1000}


def cnn_model() -> tuple[dict, dict]:
    """conv 3x3 to 2 channels, pool 2/2, normalisation over neighbouring channels, softmax layer.

    Kernel and bias are eighths, so that on whole-number pixels the sums are
    exact and a sum of zero is zero in any order of addition.
    """
    model = dict(name="small-cnn", shape=(8, 8, 1), layers=[
        layers.conv(3, 3, 2), layers.pool(2, 2), layers.lrn(1, 1.0, 0.5, 0.75), layers.dense(10, "identity")])
    i, j, o = np.arange(3)[:, None, None], np.arange(3)[None, :, None], np.arange(2)[None, None, :]
    kernel = ((7 * i + 5 * j + 3 * o) % 11 - 5) / 8
    return model, {"w0": kernel[:, :, None, :], "b0": np.array([0.0, 0.125]),
                   "w3": formula_weights(32), "b3": np.zeros(10)}


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised images with logits of the fixed dense layer and the predicted class."""
    model, params = dense_model()
    scored = scoring.score_dense(images.standardize_image(img8(spark, sf_dir)), model, params)
    return scored.withColumn("prediction", argmax("logits"))


def byte_string(values: Column) -> Column:
    """Array of 0..255 -> binary."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))


def write_blocks(df: DataFrame, folder: str, payload: str, suffix: str = ".bin", header=None, block: int = 4096) -> str:
    """Write the binary column `payload` to files of at most `block` rows, each after `header(rows)`.

    A task writes the same names with the same bytes when it is run again; the
    names sort in partition order.
    """
    return write_block_sets(df, [(folder, payload, suffix, header)], block)[0]


def write_block_sets(df: DataFrame, sets: list[tuple], block: int = 4096) -> list[str]:
    """Several (folder, payload, suffix, header) by `write_blocks`, in one pass over the rows.

    Files of the same rank in two folders hold the same rows in the same order. Two passes would
    not do: each may cut the rows into other partitions, by what its own columns weigh.
    """
    folders = [qualified(df.sparkSession, folder) for folder, *_ in sets]
    endings = [(suffix, header) for _, _, suffix, header in sets]

    def run(batches):
        places = [filesystem(folder) for folder in folders]
        for system, inner in places:
            system.create_dir(inner, recursive=True)
        part, files, held = TaskContext.get().partitionId(), 0, [[] for _ in places]

        def save(columns):
            for rows, (system, inner), (suffix, header) in zip(columns, places, endings):
                with system.open_output_stream(f"{inner}/part-{part:06d}-{files:06d}{suffix}") as f:
                    f.write((header(len(rows)) if header else b"") + b"".join(rows))

        for batch in batches:
            held = [rows + column.to_pylist() for rows, column in zip(held, batch.columns)]
            while len(held[0]) >= block:
                save([rows[:block] for rows in held])
                held, files = [rows[block:] for rows in held], files + 1
        if held[0]:
            save(held)
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    df.select(*(payload for _, payload, *_ in sets)).mapInArrow(run, "files long").agg(F.sum("files")).first()
    return folders


def write_texts(df: DataFrame, folder: str, name: str, text: str, suffix: str) -> str:
    """Write the column `text` to one file per row, named by the column `name`; a task that is run again writes the same."""
    folder = qualified(df.sparkSession, folder)

    def run(batches):
        system, inner = filesystem(folder)
        system.create_dir(inner, recursive=True)
        files = 0
        for batch in batches:
            for stem, body in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_output_stream(f"{inner}/{stem}{suffix}") as f:
                    f.write(body.encode())
                files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    df.select(F.col(name).cast("string"), text).mapInArrow(run, "files long").agg(F.sum("files")).first()
    return folder
