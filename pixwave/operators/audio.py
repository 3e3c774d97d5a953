"""Audio: channels, clips by subtitle interval, spectrograms and their pieces.

A waveform is a set of chunk rows (file, fs, n_frames, start_sample, samples);
no operator holds a whole file in one row.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.text import clip_name, timecode_sample
from .images import DOUBLES, list_array

EMIT_VALUES = 1 << 20


def pack_samples(df: DataFrame, file: str, position: str, value: str, fs: int, chunk: int = 4096,
                 n_frames: str = "n_frames") -> DataFrame:
    """One row per sample -> chunk rows of at most `chunk` samples.

    Positions are dense from 0, and `n_frames` holds the length of the file.
    """
    packed = df.groupBy(F.col(file), F.floor(F.col(position) / chunk).alias("chunk_no")).agg(
        F.max(n_frames).cast("long").alias("n_frames"),
        F.transform(F.array_sort(F.collect_list(F.struct(position, value))), lambda s: s[value]).alias("samples"))
    return packed.select(
        F.col(file).alias("file"), F.lit(fs).alias("fs"), F.lit(0).alias("channel"), "n_frames",
        F.col("chunk_no").cast("long").alias("chunk_no"),
        (F.col("chunk_no") * chunk).cast("long").alias("start_sample"), "samples")


def select_channel(df: DataFrame, channel: int = 0) -> DataFrame:
    return df.filter(F.col("channel") == channel)


def timecode_to_sample(df: DataFrame, fs, mode: str = "correct") -> DataFrame:
    """`start_tc`, `end_tc` -> `start_sample`, `end_sample`."""
    return df.withColumns({"start_sample": timecode_sample("start_tc", fs, mode),
                           "end_sample": timecode_sample("end_tc", fs, mode)})


def extract_clips(intervals: DataFrame, chunks: DataFrame, chunk: int = 65536, file: str = "file",
                  files: DataFrame | None = None) -> DataFrame:
    """Samples [start, end) of each interval, as ordered parts.

    intervals: `file`, num, dialogue, start_sample, end_sample; chunks: rows of
    one channel, cut every `chunk` samples. Returns the interval columns plus
    `name`, `part_no`, `samples`. The interval is cut to the file, spread over
    the chunk numbers it touches, and meets the chunks in an equi-join on
    (file, chunk_no), so neither a long file nor a long clip is ever one row.
    An empty interval, or one past the end, keeps one row with no samples.
    `files` (file, n_frames) gives the lengths; without it they are taken from
    the chunks, which are then read twice.
    """
    facts = (chunks.groupBy("file").agg(F.max("n_frames").alias("n_frames")) if files is None else files).select(
        F.col("file").alias("__file"), F.col("n_frames").alias("__frames"))
    known = intervals.join(facts, intervals[file] == F.col("__file"), "left").drop("__file")
    frames = F.coalesce("__frames", F.lit(0).cast("long"))

    def bound(position: Column) -> Column:
        # a negative position counts from the end, as in an array slice
        return F.greatest(F.lit(0), F.least(F.when(position < 0, position + frames).otherwise(position), frames))

    cut = known.withColumns({"__start": bound(F.col("start_sample")), "__end": bound(F.col("end_sample"))})
    first = F.floor(F.col("__start") / chunk)
    numbers = F.when(F.col("__end") > F.col("__start"),
                     F.sequence(first, F.floor((F.col("__end") - 1) / chunk)))
    spread = cut.withColumn("__chunk", F.explode_outer(numbers)).withColumn(
        "part_no", F.coalesce(F.col("__chunk") - first, F.lit(0)))
    audio = chunks.select(F.col("file").alias("__file"), F.col("chunk_no").alias("__no"),
                          F.col("start_sample").alias("__from"), F.col("samples").alias("__samples"))
    met = spread.join(audio, (F.col(file) == F.col("__file")) & (F.col("__chunk") == F.col("__no")), "left")
    begin = F.greatest(F.col("__start") - F.col("__from"), F.lit(0))
    stop = F.least(F.col("__end") - F.col("__from"), F.size("__samples").cast("long"))
    kind = chunks.schema["samples"].dataType.simpleString()
    part = F.when(F.col("__no").isNotNull(),
                  F.slice("__samples", (begin + 1).cast("int"), F.greatest(stop - begin, F.lit(0)).cast("int"))
                  ).otherwise(F.array().cast(kind))
    return met.select(*intervals.columns, clip_name("num", "dialogue").alias("name"),
                      F.col("part_no").cast("long").alias("part_no"), part.alias("samples"))


def long_enough(n_frames, fs, mintime: int = 28) -> Column:
    """A file is kept if it lasts at least (mintime + 1) half frames of 50 ms."""
    return F.col(n_frames) / F.col(fs) >= F.lit((mintime + 1) * 0.05)


def filter_short_audio(df: DataFrame, mintime: int = 28) -> DataFrame:
    return df.filter(long_enough("n_frames", "fs", mintime))


def count_short_audio(df: DataFrame, mintime: int = 28) -> DataFrame:
    """Number of dropped files; `df` has one row per file."""
    return df.agg(F.count_if(~long_enough("n_frames", "fs", mintime)).alias("dropped"))


def frame_length(fs, tres: int = 100) -> Column:
    return F.floor(F.lit(tres / 1000.0) * F.col(fs))


def power_density(frames: np.ndarray, fs: float) -> np.ndarray:
    """[n, L] samples -> [n, L//2+1] one-sided power density of Hann-windowed, mean-free frames."""
    length = frames.shape[1]
    window = np.hanning(length)
    spectrum = np.fft.rfft((frames - frames.mean(axis=1, keepdims=True)) * window, axis=1)
    power = (spectrum.real ** 2 + spectrum.imag ** 2) / (fs * (window ** 2).sum())
    power[:, 1:(length + 1) // 2] *= 2
    return power


def _frame_spectra(tres: int, carry: list[str], bins: int | None):
    """mapInArrow body: all frames that lie wholly inside their chunk row; their first `bins` frequencies."""

    def emit(rows):
        names, spectra = [*carry, "fs", "n_frames"], []
        columns = {n: [] for n in [*names, "frame_count", "frame"]}
        for row, first, count, psd in rows:
            for n in names:
                columns[n] += [row[n]] * len(psd)
            columns["frame_count"] += [count] * len(psd)
            columns["frame"] += range(first, first + len(psd))
            spectra += list(psd)
        return columns, list_array(spectra)

    def run(batches):
        for batch in batches:
            schema = batch.schema
            held, values = [], 0
            small = batch.drop_columns(["samples"]).to_pylist()
            samples = batch.column("samples")
            for i, row in enumerate(small):
                length = int(np.floor(tres / 1000.0 * row["fs"]))
                hop = length - length // 2
                count = max(0, (row["n_frames"] - length // 2) // hop)
                x = np.asarray(samples[i].values).astype(np.float64)
                first = -(-row["start_sample"] // hop)
                lead = first * hop - row["start_sample"]
                if len(x) - lead < length or first >= count:
                    continue
                frames = np.lib.stride_tricks.sliding_window_view(x[lead:], length)[::hop][:count - first]
                psd = power_density(frames, row["fs"])[:, :bins]
                held.append((row, first, count, psd))
                values += psd.size
                if values >= EMIT_VALUES:
                    yield _to_batch(*emit(held), schema)
                    held, values = [], 0
            if held:
                yield _to_batch(*emit(held), schema)

    def _to_batch(columns, spectra, schema):
        arrays = {n: pa.array(v, schema.field(n).type if n in schema.names else pa.int64())
                  for n, v in columns.items()}
        return pa.RecordBatch.from_pydict({**arrays, "psd": spectra})

    return run


def border_frames(chunks: DataFrame, tres: int, carry: list[str]) -> DataFrame:
    """Frames that cross chunk borders, each as a chunk row of one frame.

    Only the samples of such frames are shuffled: about one frame per border.
    """
    length = frame_length("fs", tres)
    hop = length - F.floor(length / 2)
    size = F.size("samples")
    start, end = F.col("start_sample"), F.col("start_sample") + size
    count = F.floor((F.col("n_frames") - F.floor(length / 2)) / hop)
    first_whole = F.ceil(start / hop)
    after_whole = F.floor((end - length) / hop) + 1
    lowest = F.greatest(F.lit(0), F.floor((start - length) / hop) + 1)
    highest = F.least(count - 1, F.ceil(end / hop) - 1)
    before = F.least(first_whole - 1, highest)
    behind = F.greatest(after_whole, first_whole, lowest)
    none = F.array().cast("array<bigint>")
    numbers = F.concat(F.when(before >= lowest, F.sequence(lowest, before)).otherwise(none),
                       F.when(highest >= behind, F.sequence(behind, highest)).otherwise(none))
    spread = chunks.select("*", F.explode(numbers).alias("__frame"))
    begin = F.greatest(F.col("__frame") * hop, start)
    stop = F.least(F.col("__frame") * hop + length, end)
    parts = spread.select(*carry, "fs", "n_frames", "__frame", begin.alias("__begin"),
                          F.slice("samples", (begin - start + 1).cast("int"), (stop - begin).cast("int")).alias("__part"))
    joined = parts.groupBy(*carry, "fs", "n_frames", "__frame").agg(
        F.array_sort(F.collect_list(F.struct("__begin", "__part"))).alias("__parts"))
    return joined.select(*carry, "fs", "n_frames", (F.col("__frame") * hop).cast("long").alias("start_sample"),
                         F.flatten(F.transform("__parts", lambda p: p["__part"])).alias("samples"))


def spectrogram(chunks: DataFrame, tres: int = 100, carry: tuple[str, ...] = ("file",),
                max_frequency: int | None = None) -> DataFrame:
    """Frames of floor(tres/1000 * fs) samples, half overlapping -> power density per frequency.

    Returns `carry`, fs, n_frames, frame_count, frame, psd (one value per
    frequency bin). Chunks are transformed where they are; only frames over a
    chunk border are put together by a shuffle. `max_frequency` keeps the bins
    of `crop_frequencies`; the others do not leave the transform.
    """
    carry = list(carry)
    columns = [*carry, "fs", "n_frames", "start_sample", "samples"]
    whole = chunks.select(*columns).withColumn("n_frames", F.col("n_frames").cast("long"))
    rows = whole.unionByName(border_frames(whole, tres, carry))
    kinds = {f.name: f.dataType.simpleString() for f in whole.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in [*carry, "fs", "n_frames"]),
                        "frame_count bigint", "frame bigint", "psd array<double>"])
    return rows.mapInArrow(_frame_spectra(tres, carry, _bins(max_frequency) if max_frequency else None), schema)


def _bins(max_frequency: int) -> int:
    return int(max_frequency / 10)


def crop_frequencies(df: DataFrame, max_frequency: int = 5000) -> DataFrame:
    """The first max_frequency/10 bins (bins are 10 Hz wide at 100 ms frames)."""
    return df.withColumn("psd", F.slice("psd", 1, _bins(max_frequency)))


@arrow_udf(DOUBLES)
def _frequency_major(frames: pa.Array) -> pa.Array:
    """Lists of frames -> [frequency, time] values, flat."""
    return list_array([np.stack([np.asarray(f.values) for f in piece]).T for piece in frames])


def spectrogram_pieces(df: DataFrame, mintime: int = 28, tail: str = "correct",
                       keys: tuple[str, ...] = ("file",)) -> DataFrame:
    """Consecutive pieces of `mintime` frames, and one tail piece of the last `mintime` frames.

    The tail piece is added when frames remain; `tail='reference'` adds it when
    the squared number of pieces is below the number of frames. Files of fewer
    frames give no piece. Returns keys, piece_no, n_freq, n_time, values
    ([frequency, time], flat).
    """
    if tail not in ("correct", "reference"):
        raise ValueError(f"unknown tail: {tail}")
    total, frame = F.col("frame_count"), F.col("frame")
    pieces = F.floor(total / mintime)
    has_tail = pieces * mintime < total if tail == "correct" else pieces * pieces < total
    regular = F.when(frame < pieces * mintime,
                     F.struct(F.floor(frame / mintime).alias("piece_no"), (frame % mintime).alias("place")))
    last = F.when(has_tail & (frame >= total - mintime),
                  F.struct(pieces.alias("piece_no"), (frame - total + mintime).alias("place")))
    spread = (df.filter(total >= mintime)
              .withColumn("__at", F.explode(F.array_compact(F.array(regular, last)))))
    grouped = spread.groupBy(*keys, F.col("__at.piece_no").alias("piece_no")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__at.place").alias("place"), "psd"))).alias("__frames"),
        F.max(F.size("psd")).alias("n_freq"))
    return grouped.select(*keys, "piece_no", "n_freq", F.lit(mintime).alias("n_time"),
                          _frequency_major(F.transform("__frames", lambda f: f["psd"])).alias("values"))
