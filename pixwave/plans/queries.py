"""Registered queries: one per operator, each over whole tables."""

import struct
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform as draw
from ..functions.vectors import argmax
from ..operators import audio, batching, images, index, layers, metrics, pairing, scoring, series, training
from ..session import shared_dir
from ..sources import records, sinks, text, tfrecord, wav
from ..streaming import feeds, learning
from .fixtures import (CHUNK, FS, MAX_FREQUENCY, MINTIME, SEED, byte_string, cnn_model, dense_model, img8, pred, sig,
                       sig_chunks, subtitle_lines, table, train_log, write_block_sets, write_blocks, write_texts)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(value, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits) + F.lit(0.0)


def cells(df: DataFrame, keys: list[str], array: str = "pixels", digits: int = 6) -> DataFrame:
    """One row per array element, rounded.

    The outer form: the plain one adds a filter on the array, and with it a second run of the
    Arrow function that makes the array. No array here is empty.
    """
    value = r6(F.col("value").cast("double"), digits)
    return df.select(*keys, F.posexplode_outer(array).alias("idx", "value")).select(*keys, "idx", value.alias("value"))


def workers(spark: SparkSession) -> int:
    """Cores of the cluster: the number of shards, part files or files per micro-batch."""
    return spark.sparkContext.defaultParallelism


def ordered(df: DataFrame) -> DataFrame:
    return df.repartitionByRange("example_id").sortWithinPartitions("example_id")


# ---- sources ----------------------------------------------------------------

@query
def read_fixed_records(spark, sf_dir):
    rows = img8(spark, sf_dir).withColumn("record", byte_string(F.concat(F.array("label"), F.col("pixels"))))
    path = write_blocks(ordered(rows), shared_dir(spark, "records"), "record")
    return cells(records.read_fixed_records(spark, path, (4, 4, 4)), ["example_id", "label"])


@query
def read_idx(spark, sf_dir):
    base = ordered(img8(spark, sf_dir).withColumn("image", byte_string(F.col("pixels")))
                   .withColumn("target", byte_string(F.array("label"))))
    images_dir, labels_dir = write_block_sets(base, [
        (shared_dir(spark, "idx-images"), "image", ".idx3", lambda n: struct.pack(">4I", 2051, n, 8, 8)),
        (shared_dir(spark, "idx-labels"), "target", ".idx1", lambda n: struct.pack(">2I", 2049, n))])
    return cells(records.read_idx(spark, images_dir, labels_dir), ["example_id", "label"])


@query
def explode_batches(spark, sf_dir):
    rows = img8(spark, sf_dir)
    batch = F.floor(F.col("example_id") / 100)
    packed = (rows.groupBy(batch.alias("batch"))
              .agg(F.array_sort(F.collect_list(F.struct("example_id", "pixels", "label"))).alias("r"))
              .select("batch", F.transform("r", lambda x: x["pixels"]).alias("data"),
                      F.transform("r", lambda x: x["label"]).alias("labels")))
    return cells(batching.explode_batches(packed, "data", "labels", "batch"), ["batch", "offset", "label"])


@query
def read_csv_vectors(spark, sf_dir):
    path = shared_dir(spark, "csv")
    sinks.write_csv_vectors(images.one_hot(img8(spark, sf_dir)), path)
    pixels = text.read_csv_vectors(spark, f"{path}/images", "int", with_id=True)
    target = text.read_csv_vectors(spark, f"{path}/labels", "double", with_id=True).withColumnRenamed("values", "target")
    return cells(pixels.join(target, "example_id").withColumn("label", argmax("target")), ["example_id", "label"], "values")


@query
def read_labelled_csv(spark, sf_dir):
    path = shared_dir(spark, "csv2")
    sinks.write_labelled_csv(images.one_hot(img8(spark, sf_dir)), path)
    back = text.read_labelled_csv(spark, path).withColumn("label", argmax("target"))
    return back.select("label", F.array_join("pixels", ",").alias("pixels"))


@query
def read_tfrecords(spark, sf_dir):
    path = shared_dir(spark, "tfr")
    rows = img8(spark, sf_dir).select(F.col("pixels").alias("image"), F.array("label").alias("label"),
                                      F.array("example_id").alias("id"))
    tfrecord.write_tfrecords(rows, path, ["image", "label", "id"])
    back = tfrecord.read_tfrecords(spark, path, ["image", "label", "id"])
    flat = back.select(F.col("id")[0].alias("example_id"), F.col("label")[0].alias("label"), "image")
    return cells(flat, ["example_id", "label"], "image")


@query
def read_tfrecord_ranges(spark, sf_dir):
    """The same files, larger ones read in ranges of 32 KB; every record has its number in its file."""
    path = shared_dir(spark, "tfr-ranges")
    rows = img8(spark, sf_dir).select(F.col("pixels").alias("image"), F.array("label").alias("label"),
                                      F.array("example_id").alias("id"))
    tfrecord.write_tfrecords(rows, path, ["image", "label", "id"])
    back = tfrecord.read_tfrecords(spark, path, ["image", "label", "id"], target_bytes=1 << 15)
    flat = back.select(F.col("id")[0].alias("example_id"), F.col("label")[0].alias("label"), "image")
    return cells(flat, ["example_id", "label"], "image")


def wav_header(channels: int):
    """Header of a 16-bit PCM file as a function of its number of frames."""
    def header(frames: int) -> bytes:
        size = frames * channels * 2
        return (b"RIFF" + struct.pack("<I", size + 36) + b"WAVEfmt "
                + struct.pack("<IHHIIHH", 16, 1, channels, FS, FS * channels * 2, channels * 2, 16)
                + b"data" + struct.pack("<I", size))
    return header


@query
def read_wav_chunks(spark, sf_dir):
    """Events as four-channel audio: the value, and the event number in three parts of 15 bits."""
    def little(value: Column) -> Column:
        digits = F.lpad(F.hex(value.cast("long")), 4, "0")
        return F.concat(F.substring(digits, 3, 2), F.substring(digits, 1, 2))

    events, number = table(spark, sf_dir, "events"), F.col("event_id")
    frame = F.concat(little(F.floor(F.col("value") * 10)),
                     *[little(F.shiftright(number, 15 * k) % 32768) for k in range(3)])
    path = write_blocks(events.select(F.unhex(frame).alias("frame")), shared_dir(spark, "wav"), "frame", ".wav",
                        wav_header(4), 1 << 16)
    chunks = wav.read_wav_chunks(spark, path, chunk=1000)
    channel = [F.max(F.when(F.col("channel") == k, F.col("samples"))).alias(f"c{k}") for k in range(4)]
    together = chunks.groupBy("file", "chunk_no", "fs").agg(*channel)
    frames = together.select("fs", F.explode(F.arrays_zip(*[f"c{k}" for k in range(4)])).alias("f"))
    number = sum((F.col(f"f.c{k + 1}").cast("long") * (1 << 15 * k) for k in range(3)), F.lit(0))
    return frames.select(number.alias("event_id"), "fs", F.col("f.c0").cast("int").alias("sample"))


@query
def read_subtitles(spark, sf_dir):
    """Subtitle files, one per conversation, written and read back by lines."""
    lines = subtitle_lines(spark, sf_dir)
    text_of = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: F.concat(x["line"], F.lit("\n"))), "")
    path = write_texts(lines.groupBy("episode").agg(text_of.alias("text")), shared_dir(spark, "subtitles"), "episode", "text", ".ass")
    back = text.read_subtitles(spark, path)
    episode = F.col("episode").cast("long")
    return back.select(episode.alias("episode"), "num", "dialogue", "start_tc", "end_tc")


@query
def label_from_path(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    paths = talk.select("conv_id", "turn", F.concat(F.lit("/audio/"), "role", F.lit("/"),
                                                    F.col("conv_id").cast("string"), F.lit(".wav")).alias("path"))
    return pairing.label_from_path(paths, "path", ["assistant", "user"])


@query
def label_lookup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return pairing.label_lookup(events, "event_type", ["view", "click", "purchase"])


# ---- sinks ------------------------------------------------------------------

@query
def write_csv_vectors(spark, sf_dir):
    path = shared_dir(spark, "csv-out")
    sinks.write_csv_vectors(images.one_hot(img8(spark, sf_dir)), path)
    part = lambda name: spark.read.text(f"{path}/{name}").select(F.lit(name).alias("part"), "value")
    # 1.0 and 0.0 of the label vectors print differently in the two engines
    return part("images").union(part("labels").withColumn("value", F.replace("value", F.lit(".0"), F.lit(""))))


@query
def write_labelled_csv(spark, sf_dir):
    path = shared_dir(spark, "csv2-out")
    sinks.write_labelled_csv(images.one_hot(img8(spark, sf_dir)), path)
    return spark.read.text(path).select(F.replace("value", F.lit(".0"), F.lit("")).alias("value"))


@query
def write_tfrecords(spark, sf_dir):
    path = shared_dir(spark, "tfr")
    rows = img8(spark, sf_dir).select(F.col("pixels").alias("image"), F.array("label").alias("label"))
    tfrecord.write_tfrecords(rows, path)
    back = tfrecord.read_tfrecords(spark, path)
    return back.select(F.col("label")[0].alias("label"), F.array_join("image", ",").alias("pixels"))


@query
def write_examples(spark, sf_dir):
    path = shared_dir(spark, "examples")
    sinks.write_examples(pairing.split_validation(img8(spark, sf_dir), 120), path)
    return cells(spark.read.parquet(path), ["example_id", "label", "split"])


def clip_spans(spark, sf_dir) -> DataFrame:
    """Subtitle intervals at two samples a second, so that files end inside and before some of them."""
    lines = text.parse_subtitle_lines(subtitle_lines(spark, sf_dir))
    return audio.timecode_to_sample(lines, 2).select(
        "episode", F.col("line_no").alias("num"), "dialogue", "start_sample", "end_sample")


@query
def write_clips(spark, sf_dir):
    path = shared_dir(spark, "clips")
    sinks.write_clips(audio.extract_clips(clip_spans(spark, sf_dir), sig_chunks(spark, sf_dir), CHUNK, "episode"), path)
    back = spark.read.parquet(path)
    return (back.select("episode", "num", "name", "part_no", F.posexplode_outer("samples").alias("pos", "sample"))
            .withColumn("sample", r6("sample")))


@query
def write_predictions(spark, sf_dir):
    stamped = pred(spark, sf_dir).withColumn("ts", F.lit("2024-01-01T00:00:00"))
    path = shared_dir(spark, "predictions")
    sinks.write_predictions(stamped.select("example_id", "ts", "label", "prediction"), path)
    lines = spark.read.text(f"{path}/text").withColumnRenamed("value", "line")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def checkpoint_weights(spark, sf_dir):
    path = shared_dir(spark, "weights")
    rows = img8(spark, sf_dir)
    # the mean image of each class as a small model, saved as two steps
    means = (rows.select("label", F.posexplode("pixels").alias("idx", "value")).groupBy("label", "idx")
             .agg(F.avg("value").alias("v")).groupBy("label")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "v"))), lambda x: x["v"]).alias("values")))
    classes = means.count()
    for step in (1, 2):
        sinks.checkpoint_weights(means.select(
            F.lit("mean").alias("model"), F.lit(step).cast("long").alias("step"),
            F.concat(F.lit("class"), F.col("label").cast("string")).alias("tensor"),
            F.array(F.lit(64)).alias("shape"), F.lit(0).alias("chunk"),
            F.lit(classes).alias("parts"), F.transform("values", lambda v: v * step).alias("values")), path)
    return cells(sinks.restore_weights(spark, path, "mean"), ["step", "tensor"], "values")


@query
def write_metrics(spark, sf_dir):
    path = shared_dir(spark, "metrics")
    log = train_log(spark, sf_dir)
    sinks.write_metrics(log.select(F.col("run").alias("tag"), "step", F.col("loss").alias("value")), path, "run-1")
    return (spark.read.parquet(path).groupBy("run", "step")
            .agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value")).alias("total")))


@query
def verify_examples(spark, sf_dir):
    first = sinks.verify_examples(img8(spark, sf_dir))
    return first.select("example_id", "num_images", "num_labels", "label")


# ---- preparation ---------------------------------------------------------------

@query
def split_record(spark, sf_dir):
    rows = img8(spark, sf_dir)
    packed = rows.select("example_id", F.concat(F.array("label"), F.col("pixels")).alias("record"))
    return cells(images.split_record(packed), ["example_id", "label"])


@query
def to_channel_last(spark, sf_dir):
    return cells(images.to_channel_last(img8(spark, sf_dir), (4, 4, 4)), ["example_id"])


@query
def flatten_images(spark, sf_dir):
    nested = img8(spark, sf_dir).withColumn("pixels", F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda y: F.slice("pixels", y * 8 + 1, F.lit(8))))
    return cells(images.flatten_images(nested), ["example_id"])


@query
def rescale_pixels(spark, sf_dir):
    return cells(images.rescale_pixels(img8(spark, sf_dir)), ["example_id"])


@query
def one_hot(spark, sf_dir):
    return cells(images.one_hot(img8(spark, sf_dir)), ["example_id"], "target")


@query
def argmax_decode(spark, sf_dir):
    return metrics.argmax_decode(pred(spark, sf_dir).drop("prediction")).select("example_id", "prediction")


@query
def random_crop(spark, sf_dir):
    return cells(images.random_crop(img8(spark, sf_dir), 6, 6, SEED, 1), ["example_id"])


@query
def random_flip_lr(spark, sf_dir):
    return cells(images.random_flip_lr(img8(spark, sf_dir), SEED, 1), ["example_id"])


@query
def random_brightness(spark, sf_dir):
    return cells(images.random_brightness(img8(spark, sf_dir), 63, SEED, 1), ["example_id"])


@query
def random_contrast(spark, sf_dir):
    channels = images.to_channel_last(img8(spark, sf_dir), (4, 4, 4))
    return cells(images.random_contrast(channels, 0.2, 1.8, SEED, 1), ["example_id"])


@query
def standardize_image(spark, sf_dir):
    return cells(images.standardize_image(img8(spark, sf_dir)), ["example_id"])


@query
def center_crop_or_pad(spark, sf_dir):
    return cells(images.center_crop_or_pad(img8(spark, sf_dir), 5, 11), ["example_id"])


@query
def distorted_inputs(spark, sf_dir):
    epochs = batching.repeat_epochs(img8(spark, sf_dir), 2)
    return cells(images.distorted_inputs(epochs, SEED, "epoch", 6, 6), ["epoch", "example_id"])


@query
def eval_inputs(spark, sf_dir):
    return cells(images.eval_inputs(img8(spark, sf_dir), 6, 6), ["example_id"])


@query
def timecode_to_sample(spark, sf_dir):
    lines = text.parse_subtitle_lines(subtitle_lines(spark, sf_dir))
    return audio.timecode_to_sample(lines, 44100).select("episode", "line_no", "start_sample", "end_sample")


@query
def select_channel(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 2).alias("channel"), "value")
    return audio.select_channel(events, 0)


@query
def softmax_probs(spark, sf_dir):
    return cells(metrics.softmax_probs(pred(spark, sf_dir)), ["example_id"], "probabilities")


@query
def lr_schedule(spark, sf_dir):
    scheduled = metrics.lr_schedule(train_log(spark, sf_dir), 0.1, 0.5, 350)
    return scheduled.select("run", "step", r6("learning_rate", 12).alias("learning_rate"))


@query
def clean_metric_tag(spark, sf_dir):
    tag = F.concat(F.lit("tower_"), F.col("user_id").cast("string"), F.lit("/"), "event_type", F.lit("/tower_/loss"))
    return metrics.clean_metric_tag(table(spark, sf_dir, "events").select("event_id", tag.alias("tag")))


@query
def every_n_steps(spark, sf_dir):
    return metrics.every_n_steps(train_log(spark, sf_dir), 10).select("run", "step", "loss")


@query
def hash_uniform(spark, sf_dir):
    drawn = table(spark, sf_dir, "events").select("event_id", draw(SEED, 2, "test", "event_id").alias("u"))
    return drawn.select("event_id", r6("u", 9).alias("u"))


# ---- pairing, splits, batches ------------------------------------------------------

@query
def zip_by_position(spark, sf_dir):
    rows = img8(spark, sf_dir)
    left = rows.select("example_id", F.element_at("pixels", 1).alias("first_pixel"))
    right = rows.select((F.col("example_id") * 3 + 1).alias("label_id"), F.col("label").alias("paired_label"))
    return pairing.zip_by_position(left, right, "example_id", "label_id")


@query
def global_index(spark, sf_dir):
    """Orders numbered in key order, over the whole table and within each customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    numbered = index.global_index(orders, "o_orderkey", "idx", total="n_rows")
    return index.global_index(numbered, "o_orderkey", "idx_in_customer", by=["o_custkey"])


@query
def extract_clips(spark, sf_dir):
    clips = audio.extract_clips(clip_spans(spark, sf_dir), sig_chunks(spark, sf_dir), CHUNK, "episode")
    return (clips.select("episode", "num", F.posexplode_outer("samples").alias("i", "sample"))
            .groupBy("episode", "num").agg(F.count("sample").alias("n"), r6(F.sum("sample")).alias("total"),
                                           F.min("sample").alias("lowest"), F.max("sample").alias("highest")))


@query
def union_batches(spark, sf_dir):
    rows = img8(spark, sf_dir).select("example_id", "label", "pixels")
    return cells(pairing.union_batches(rows, rows.withColumn("label", F.lit(0)), source="batch"),
                 ["batch", "example_id", "label"])


@query
def split_validation(spark, sf_dir):
    return pairing.split_validation(img8(spark, sf_dir), 120).select("example_id", "split")


@query
def shuffle_epoch(spark, sf_dir):
    return batching.shuffle_epoch(img8(spark, sf_dir), "example_id", SEED, 3).select("example_id", "rank")


@query
def assign_batches(spark, sf_dir):
    return batching.assign_batches(img8(spark, sf_dir), 128, 3, SEED).select("example_id", "epoch", "step", "slot")


@query
def assign_batches_partial(spark, sf_dir):
    rows = batching.assign_batches(img8(spark, sf_dir), 128, 2, SEED, "partial", False)
    return rows.select("example_id", "epoch", "step", "slot")


@query
def bootstrap_batches(spark, sf_dir):
    rows = img8(spark, sf_dir)
    steps = -(-rows.count() // 50)
    return batching.bootstrap_batches(rows, 50, steps, SEED).select("step", "slot", "example_id", "label")


@query
def repeat_epochs(spark, sf_dir):
    return batching.repeat_epochs(img8(spark, sf_dir), 3).select("example_id", "epoch", "label")


@query
def preview(spark, sf_dir):
    return batching.preview(img8(spark, sf_dir), 10).select("example_id", "label")


# ---- audio ---------------------------------------------------------------------------

def files(spark, sf_dir) -> DataFrame:
    return sig(spark, sf_dir).groupBy("file").agg((F.max("pos") + 1).alias("n_frames")).withColumn("fs", F.lit(FS))


@query
def filter_short_audio(spark, sf_dir):
    return audio.filter_short_audio(files(spark, sf_dir), MINTIME).select("file", "n_frames")


@query
def count_short_audio(spark, sf_dir):
    return audio.count_short_audio(files(spark, sf_dir), MINTIME)


@query
def spectrogram(spark, sf_dir):
    return cells(audio.spectrogram(sig_chunks(spark, sf_dir)), ["file", "frame"], "psd")


@query
def crop_frequencies(spark, sf_dir):
    frames = audio.crop_frequencies(audio.spectrogram(sig_chunks(spark, sf_dir)), MAX_FREQUENCY)
    return cells(frames, ["file", "frame"], "psd")


def _pieces(spark, sf_dir, tail):
    kept = audio.filter_short_audio(sig_chunks(spark, sf_dir), MINTIME)
    frames = audio.crop_frequencies(audio.spectrogram(kept), MAX_FREQUENCY)
    return cells(audio.spectrogram_pieces(frames, MINTIME, tail), ["file", "piece_no", "n_freq", "n_time"], "values")


@query
def spectrogram_pieces(spark, sf_dir):
    return _pieces(spark, sf_dir, "correct")


@query
def spectrogram_pieces_reference_tail(spark, sf_dir):
    return _pieces(spark, sf_dir, "reference")


# ---- aggregates ------------------------------------------------------------------------

@query
def accuracy(spark, sf_dir):
    rows = pred(spark, sf_dir).withColumn("step", F.floor(F.col("example_id") / 100))
    return metrics.accuracy(rows, "step").select("step", r6("accuracy").alias("accuracy"))


@query
def cross_entropy(spark, sf_dir):
    rows = images.one_hot(pred(spark, sf_dir))
    sparse, onehot = metrics.cross_entropy(rows), metrics.cross_entropy(rows, "target", onehot=True)
    return sparse.select(r6("cross_entropy").alias("sparse"), r6(onehot.scalar()).alias("onehot"))


@query
def total_loss(spark, sf_dir):
    model, params = dense_model()
    weights = training.weights_frame(spark, params, "dense", 0)
    loss = metrics.total_loss(pred(spark, sf_dir), weights, {"w0": 0.004})
    return loss.select(r6("total_loss").alias("total_loss"))


def pixel_rows(spark, sf_dir) -> DataFrame:
    standard = images.standardize_image(img8(spark, sf_dir))
    return standard.select("label", F.explode_outer("pixels").alias("value"))


@query
def tensor_summary(spark, sf_dir):
    out = metrics.tensor_summary(pixel_rows(spark, sf_dir), "label", "value")
    return out.select("label", *[r6(c).alias(c) for c in ("mean", "stddev", "min", "max")])


@query
def histogram(spark, sf_dir):
    out = metrics.histogram(train_log(spark, sf_dir), "run", "loss", 30)
    return out.select("run", "bucket", r6("lower").alias("lower"), r6("upper").alias("upper"), "n")


@query
def exponent_histogram(spark, sf_dir):
    return metrics.exponent_histogram(table(spark, sf_dir, "events"), "event_type", "value")


@query
def sparsity(spark, sf_dir):
    relu = pixel_rows(spark, sf_dir).withColumn("value", F.greatest("value", F.lit(0.0)))
    return metrics.sparsity(relu, "label", "value").select("label", r6("sparsity", 12).alias("sparsity"))


@query
def activation_summary(spark, sf_dir):
    model, params = cnn_model()
    out = scoring.activation_summary(img8(spark, sf_dir), model, params)
    return out.select("tag", *[r6(c).alias(c) for c in ("mean", "stddev", "min", "max")],
                      r6("sparsity", 12).alias("sparsity"))


@query
def validate_examples(spark, sf_dir):
    return metrics.validate_examples(img8(spark, sf_dir))


@query
def nan_guard(spark, sf_dir):
    loss = F.when(F.col("value") > 100, F.lit(float("nan"))).otherwise(F.col("value"))
    return metrics.nan_guard(table(spark, sf_dir, "events").withColumn("loss", loss), "loss")


@query
def evaluate_model(spark, sf_dir):
    model, params = dense_model()
    out = scoring.evaluate_model(images.standardize_image(img8(spark, sf_dir)), model, params, 1000)
    return out.select(r6("accuracy").alias("accuracy"), r6("loss").alias("loss"), "n", "global_step")


# ---- series -------------------------------------------------------------------------------

@query
def ema_losses(spark, sf_dir):
    out = series.ema_losses(train_log(spark, sf_dir), "run", "step", "loss")
    return out.select("run", "step", "loss", r6("ema").alias("ema"))


@query
def ema_variables(spark, sf_dir):
    out = series.ema_variables(train_log(spark, sf_dir), "run", "step", "loss")
    return out.select("run", "step", r6("ema").alias("ema"))


@query
def throughput(spark, sf_dir):
    out = series.throughput(train_log(spark, sf_dir))
    return out.select("run", "step", r6("sec_per_batch").alias("sec_per_batch"),
                      r6("examples_per_sec").alias("examples_per_sec"))


@query
def log_lines(spark, sf_dir):
    return series.log_lines(series.throughput(train_log(spark, sf_dir))).select("run", "step", "line")


# ---- learning -------------------------------------------------------------------------------

@query
def score_dense(spark, sf_dir):
    return cells(pred(spark, sf_dir), ["example_id"], "logits")


@query
def score_cnn(spark, sf_dir):
    model, params = cnn_model()
    scored = scoring.score_cnn(img8(spark, sf_dir), model, params)
    return cells(scored, ["example_id"], "logits")


def _predictions(df: DataFrame) -> DataFrame:
    top = F.array_max("probabilities")
    return df.select("example_id", "label", "prediction", r6(top).alias("probability"))


@query
def predict_batches(spark, sf_dir):
    model, params = dense_model()
    return _predictions(scoring.predict_batches(images.standardize_image(img8(spark, sf_dir)), model, params))


@query
def train_softmax_step(spark, sf_dir):
    model, params = dense_model()
    out = training.train_softmax_step(images.rescale_pixels(img8(spark, sf_dir)), params, 0.5)
    return out.select("tensor", "row", "col", r6("gradient").alias("gradient"), r6("value").alias("value"))


@query
def train_parallel(spark, sf_dir):
    """Three rounds on shards of about 32,768 rows, eight at least; each takes one step a round, so a round is a gradient step."""
    rows = images.rescale_pixels(img8(spark, sf_dir))
    trained = training.train_parallel(rows, layers.softmax_model(64), "sgd", 1 << 16, 3, _one_step_shards(rows), SEED, lr=0.5, dtype=np.float64)
    return _weights(training.weight_rows(spark, trained.params))


def _one_step_shards(rows: DataFrame) -> int:
    return max(8, rows.count() >> 15)


def _weights(rows: DataFrame) -> DataFrame:
    return rows.select("tensor", "row", "col", r6("value").alias("value"))


@query
def stream_score(spark, sf_dir):
    model, params = dense_model()
    base = shared_dir(spark, "stream")
    images.standardize_image(img8(spark, sf_dir)).repartition(2 * workers(spark)).write.parquet(f"{base}/in")
    learning.stream_score(spark, f"{base}/in", f"{base}/out", model, params, checkpoint=f"{base}/state",
                          files_per_trigger=workers(spark))
    return _predictions(spark.read.parquet(f"{base}/out"))


@query
def stream_score_tfrecords(spark, sf_dir):
    """Images written as TFRecord files, streamed from them, standardised and scored."""
    model, params = dense_model()
    base = shared_dir(spark, "stream-tfr")
    rows = img8(spark, sf_dir).select(F.col("pixels").alias("image"), F.array("label").alias("label"), F.array("example_id").alias("id"))
    tfrecord.write_tfrecords(rows.repartition(2 * workers(spark)), f"{base}/in", ["image", "label", "id"])
    feed = images.standardize_image(feeds.tfrecord_feed(spark, f"{base}/in", (8, 8, 1), ident="id", files_per_trigger=workers(spark)))
    learning.stream_score(spark, "", f"{base}/out", model, params, checkpoint=f"{base}/state", feed=feed)
    return _predictions(spark.read.parquet(f"{base}/out"))


@query
def training_events(spark, sf_dir):
    """Rows and steps of every shard of a round, from the events that its tasks wrote: every row is learned once."""
    rows = images.rescale_pixels(img8(spark, sf_dir))
    trained = training.train_parallel(rows, layers.softmax_model(64), "sgd", 50, 1, 4, SEED, lr=0.1)
    events = training.step_events(spark, trained)
    return events.groupBy("shard").agg(F.sum("n").alias("n_rows"), F.max("step").alias("steps"), F.count_if(F.expr("ts is null or seconds < 0")).alias("untimed"))


@query
def stream_train(spark, sf_dir):
    """Four feeds, each with its own folder and checkpoint, train one model; each feed is one micro-batch and one step."""
    base = shared_dir(spark, "stream-train")
    rows = images.rescale_pixels(img8(spark, sf_dir)).withColumn("feed", F.col("example_id") % 4)
    rows.write.partitionBy("feed").parquet(f"{base}/in")
    shards = _one_step_shards(rows)
    for feed in range(4):
        learning.stream_train(spark, f"{base}/in/feed={feed}", layers.softmax_model(64), None, f"{base}/weights",
                              checkpoint=f"{base}/state-{feed}", files_per_trigger=1 << 20, size=1 << 16, shards=shards, lr=0.5,
                              dtype=np.float64)
    state = training.collect_state(sinks.restore_weights(spark, f"{base}/weights", "softmax"))
    return _weights(training.weight_rows(spark, {k: v for k, v in state.items() if k in ("w0", "b0")}))
