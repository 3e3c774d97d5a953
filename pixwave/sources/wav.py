"""PCM16 WAV files as a Spark data source of sample chunks."""

import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from .files import TARGET_BYTES, Slice, filesystem, list_files, pack, pack_files, qualified

WAV_SCHEMA = ("file string, fs int, channel int, n_frames long, chunk_no long, start_sample long, "
              "samples array<short>")
FILES_SCHEMA = "file string, fs int, channels int, n_frames long"
# Files whose headers one task reads.
HEADERS = 4096
# Bytes to round a file size down by before cutting it: the smallest PCM header.
HEADER = 44


class WavChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pixwave_wav"

    def schema(self) -> str:
        return WAV_SCHEMA

    def reader(self, schema) -> "WavReader":
        return WavReader(self.options)


class WavReader(DataSourceReader):
    """The driver only lists files; headers are read by the tasks.

    A slice is a run of byte blocks of 2 * chunk bytes. A task owns the chunks
    whose first byte lies in its blocks, whatever the channel count.
    """

    def __init__(self, options):
        self.path = options["path"]
        self.chunk = int(options.get("chunk", "65536"))
        self.channel = int(options["channel"]) if options.get("channel") else None
        self.target = int(options.get("target_bytes", str(TARGET_BYTES)))

    def partitions(self):
        block = 2 * self.chunk
        slices = [Slice(p, 0, max(1, -(-(size - HEADER) // block))) for p, size in list_files(self.path)]
        return pack(slices, block, self.target)

    def read(self, partition):
        for s in partition.slices:
            system, inner = filesystem(s.path)
            with system.open_input_file(inner) as f:
                header = wave.open(f, "rb")
                if header.getsampwidth() != 2:
                    raise ValueError(f"{s.path}: only 16-bit PCM is read")
                data, channels = f.tell(), header.getnchannels()
                n_frames, fs = header.getnframes(), header.getframerate()
                width = 2 * channels
                first, last = s.first * 2 * self.chunk, (s.first + s.count) * 2 * self.chunk
                for chunk_no in range(-(-first // (width * self.chunk)), -(-last // (width * self.chunk))):
                    start = chunk_no * self.chunk
                    n = min(self.chunk, n_frames - start)
                    if n <= 0 and chunk_no > 0:
                        break
                    raw = f.read_at(n * width, data + start * width)
                    if len(raw) != n * width:
                        raise ValueError(f"{s.path} ends early")
                    samples = np.frombuffer(raw, "<i2").reshape(n, channels)
                    picked = range(channels) if self.channel is None else [self.channel]
                    yield pa.RecordBatch.from_pydict({
                        "file": [s.path] * len(picked),
                        "fs": pa.array([fs] * len(picked), pa.int32()),
                        "channel": pa.array(list(picked), pa.int32()),
                        "n_frames": [n_frames] * len(picked),
                        "chunk_no": [chunk_no] * len(picked),
                        "start_sample": [start] * len(picked),
                        "samples": pa.array([samples[:, c] for c in picked], pa.list_(pa.int16())),
                    })


class WavFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pixwave_wav_files"

    def schema(self) -> str:
        return FILES_SCHEMA

    def reader(self, schema) -> "WavFilesReader":
        return WavFilesReader(self.options["path"])


class WavFilesReader(DataSourceReader):
    """Headers alone, a few thousand files per task."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return pack_files([(p, 1) for p, _ in list_files(self.path)], HEADERS)

    def read(self, partition):
        for s in partition.slices:
            system, inner = filesystem(s.path)
            with system.open_input_file(inner) as f:
                header = wave.open(f, "rb")
                yield (s.path, header.getframerate(), header.getnchannels(), header.getnframes())


def read_wav_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per WAV file: file, fs, channels, n_frames. No sample is read."""
    spark.dataSource.register(WavFiles)
    return spark.read.format("pixwave_wav_files").load(qualified(spark, path))


def read_wav_chunks(spark: SparkSession, path: str, chunk: int = 65536, channel: int | None = None,
                    target_bytes: int = TARGET_BYTES) -> DataFrame:
    """WAV files -> one row per (file, channel, chunk) with the header facts on each row.

    A long file is cut into ranges read by different tasks. `channel` reads one
    channel only. An empty file gives one empty chunk.
    """
    spark.dataSource.register(WavChunks)
    reader = spark.read.format("pixwave_wav").option("chunk", chunk).option("target_bytes", target_bytes)
    if channel is not None:
        reader = reader.option("channel", channel)
    return reader.load(qualified(spark, path))
