"""spark-submit job: cut audio by subtitles, or turn an audio tree into labelled spectrogram pieces.

    spark-submit --py-files pixwave.zip pixwave/jobs/audio.py clip -i wav/ --subtitles subs/ -o clips/
    spark-submit --py-files pixwave.zip pixwave/jobs/audio.py pieces -i tree/ --classes anna,ben -o pieces/

Pieces are examples for the train job: `-f parquet --net audio --shape 500,28,1`.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixwave.functions.hashing import hash_key, key_uniform
from pixwave.functions.text import file_stem
from pixwave.operators import audio, pairing
from pixwave.operators.index import default_buckets, global_index, hash_bucket
from pixwave.session import build_session, shared_dir
from pixwave.sources import sinks, text, wav


def arguments(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("mode", choices=["clip", "pieces"])
    p.add_argument("-i", "--input", required=True, help="folder of WAV files; for pieces one folder per class")
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--subtitles", help="folder of subtitle files with the names of the WAV files")
    p.add_argument("--timecodes", choices=["correct", "reference"], default="correct")
    p.add_argument("--classes", default="", help="class folders in label order, joined by commas")
    p.add_argument("--split", default="train")
    p.add_argument("--max-frequency", type=int, default=5000)
    p.add_argument("--mintime", type=int, default=28, help="frames per piece")
    p.add_argument("--tres", type=int, default=100, help="frame length in milliseconds")
    p.add_argument("--tail", choices=["correct", "reference"], default="correct")
    p.add_argument("--chunk", type=int, default=65536)
    return p.parse_args(argv)


def clips(spark: SparkSession, args) -> DataFrame:
    """Samples of every subtitle line, matched to the audio by file name."""
    chunks = wav.read_wav_chunks(spark, args.input, args.chunk, channel=0).withColumn("file", file_stem("file"))
    lines = text.read_subtitles(spark, args.subtitles).drop("file")
    files = wav.read_wav_files(spark, args.input).withColumn("file", file_stem("file"))
    rates = files.select("file", "fs")
    spans = lines.join(rates, lines.episode == rates.file, "left").drop("file")
    timed = audio.timecode_to_sample(spans, "fs", args.timecodes)
    return audio.extract_clips(timed, chunks, args.chunk, "episode", files)


def pieces(spark: SparkSession, args) -> DataFrame:
    """Labelled spectrogram pieces as examples: example_id, height, width, depth, label, pixels, split."""
    chunks = wav.read_wav_chunks(spark, args.input, args.chunk, channel=0)
    labelled = pairing.label_from_path(audio.select_channel(chunks), "file", args.classes.split(","))
    kept = audio.filter_short_audio(labelled, args.mintime)
    frames = audio.spectrogram(kept, args.tres, ("file", "label"), args.max_frequency)
    # numbering counts its input before it numbers it: the transform is done once, and its result written
    path = shared_dir(spark, "pieces")
    audio.spectrogram_pieces(frames, args.mintime, args.tail, ("file", "label")).write.parquet(path)
    made = spark.read.parquet(path)
    key = hash_key(0, 0, "piece", F.concat_ws("#", "file", "piece_no"))
    numbered = global_index(made.withColumn("__key", key), ["__key", "file", "piece_no"], "example_id",
                            bucket=hash_bucket(key_uniform(key), default_buckets(made)))
    return numbered.select(
        "example_id", F.col("n_freq").alias("height"), F.col("n_time").alias("width"), F.lit(1).alias("depth"),
        "label", F.col("values").alias("pixels"), F.lit(args.split).alias("split"), "file", "piece_no")


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or build_session("audio")
    if args.mode == "clip":
        sinks.write_clips(clips(spark, args), args.output)
        return
    pieces(spark, args).write.mode("append").partitionBy("split").parquet(args.output)


if __name__ == "__main__":
    main()
