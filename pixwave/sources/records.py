"""Fixed-length labelled image records and IDX files as Spark data sources."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from .files import TARGET_BYTES, Slice, Slices, filesystem, list_files, pack, qualified

RECORD_SCHEMA = "example_id long, key string, height int, width int, depth int, label int, pixels array<short>"
BATCH_BYTES = 4 << 20


def pixel_lists(pixels: np.ndarray) -> pa.Array:
    """[n, p] array -> list<int16> column."""
    n, p = pixels.shape
    offsets = pa.array((np.arange(n + 1) * p).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(pixels.astype(np.int16).ravel()))


def pick_fields(schema: str, columns) -> str:
    """DDL of the chosen columns, in the order of `schema`."""
    fields = schema.split(", ")
    unknown = set(columns) - {f.split()[0] for f in fields}
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return ", ".join(f for f in fields if f.split()[0] in columns)


def _ints(n: int, value) -> pa.Array:
    return pa.array(np.broadcast_to(np.asarray(value), n).astype(np.int32))


class FixedRecords(DataSource):
    """Files of label bytes followed by depth-major pixel bytes, without header or footer."""

    @classmethod
    def name(cls) -> str:
        return "pixwave_records"

    def schema(self) -> str:
        return RECORD_SCHEMA

    def reader(self, schema) -> "FixedRecordReader":
        return FixedRecordReader(self.options, schema.names)


class FixedRecordReader(DataSourceReader):
    def __init__(self, options, columns):
        self.columns = columns
        self.path = options["path"]
        self.shape = tuple(int(x) for x in options.get("shape", "3,32,32").split(","))
        self.label_bytes = int(options.get("label_bytes", "1"))
        self.target = int(options.get("target_bytes", str(TARGET_BYTES)))
        self.record = self.label_bytes + int(np.prod(self.shape))

    def partitions(self):
        slices, base = [], 0
        for path, size in list_files(self.path):
            count, rest = divmod(size, self.record)
            if rest:
                raise ValueError(f"{path}: {size} bytes are not whole records of {self.record} bytes")
            slices.append(Slice(path, 0, count, base))
            base += count
        return pack(slices, self.record, self.target) or [Slices([])]

    def read(self, partition):
        depth, height, width = self.shape
        per_batch = max(1, BATCH_BYTES // self.record)
        for s in partition.slices:
            system, inner = filesystem(s.path)
            with system.open_input_file(inner) as f:
                for done in range(0, s.count, per_batch):
                    n = min(per_batch, s.count - done)
                    first = s.first + done
                    raw = f.read_at(n * self.record, first * self.record)
                    rows = np.frombuffer(raw, np.uint8).reshape(n, self.record)
                    make = {
                        "example_id": lambda: pa.array(s.base + done + np.arange(n, dtype=np.int64)),
                        "key": lambda: pa.array([f"{s.path}:{first + i}" for i in range(n)]),
                        "height": lambda: _ints(n, height), "width": lambda: _ints(n, width),
                        "depth": lambda: _ints(n, depth),
                        "label": lambda: _ints(n, rows[:, self.label_bytes - 1]),
                        "pixels": lambda: pixel_lists(
                            rows[:, self.label_bytes:].reshape(n, depth, height, width)
                            .transpose(0, 2, 3, 1).reshape(n, -1)),
                    }
                    yield pa.RecordBatch.from_pydict({c: make[c]() for c in self.columns})


def read_fixed_records(spark: SparkSession, path: str, shape=(3, 32, 32), label_bytes: int = 1,
                       target_bytes: int = TARGET_BYTES, columns=None) -> DataFrame:
    """Fixed-length records over one or many files -> dense `example_id`, key, label, [H,W,D] pixels.

    Tasks read record-aligned byte ranges of about `target_bytes`. With several
    label bytes the last one is the class. `columns` leaves out the others: labels
    alone need no decoding of pixels.
    """
    spark.dataSource.register(FixedRecords)
    wanted = pick_fields(RECORD_SCHEMA, columns) if columns else RECORD_SCHEMA
    return (spark.read.schema(wanted).format("pixwave_records").option("shape", ",".join(map(str, shape)))
            .option("label_bytes", label_bytes).option("target_bytes", target_bytes)
            .load(qualified(spark, path)))


# ---- IDX -----------------------------------------------------------------

IMAGE_MAGIC, LABEL_MAGIC = 2051, 2049
IDX_SCHEMA = "example_id long, file string, idx long, height int, width int, depth int, pixels array<short>"


def _open(path: str):
    system, inner = filesystem(path)
    if path.endswith(".gz"):
        return system.open_input_stream(inner, compression="gzip", buffer_size=1 << 20)
    return system.open_input_file(inner)


def _header(f, path: str, magic: int, words: int) -> list[int]:
    raw = f.read(4 * words)
    head = np.frombuffer(raw, ">u4").astype(int).tolist()
    if len(head) < words or head[0] != magic:
        raise ValueError(f"invalid magic number {head[:1]} in {path}, expected {magic}")
    return head[1:]


@dataclass
class IdxSlice(Slice):
    """Images of one file, their shape and the file of their labels."""
    shape: tuple[int, int] = (0, 0)
    labels: str | None = None


class IdxFiles(DataSource):
    """IDX image files, with the label file of the same rank read alongside."""

    @classmethod
    def name(cls) -> str:
        return "pixwave_idx"

    def schema(self) -> str:
        label = ", label int" if self.options.get("labels") else ""
        return IDX_SCHEMA.replace(", pixels", f"{label}, pixels")

    def reader(self, schema) -> "IdxReader":
        return IdxReader(self.options, schema.names)


class IdxReader(DataSourceReader):
    def __init__(self, options, columns=None):
        self.columns = columns
        self.images = options["path"]
        self.labels = options.get("labels") or None
        self.target = int(options.get("target_bytes", str(TARGET_BYTES)))

    def partitions(self):
        images = list_files(self.images)
        labels = list_files(self.labels) if self.labels else [(None, 0)] * len(images)
        if len(images) != len(labels):
            raise ValueError(f"{len(images)} image files but {len(labels)} label files")
        # ids count on over the files, so their counts are needed first: 16 bytes per file, many files at a time
        with ThreadPoolExecutor(32) as threads:
            shapes = list(threads.map(self._shape, [p for p, _ in images], [p for p, _ in labels]))
        tasks, base, room = [Slices([])], 0, self.target
        for (path, _), (label_path, _), (count, rows, cols) in zip(images, labels, shapes):
            whole = IdxSlice(path, 0, count, base, (rows, cols), label_path)
            zipped = path.endswith(".gz") or (label_path or "").endswith(".gz")
            parts = [Slices([whole])] if zipped else pack([whole], max(1, rows * cols), self.target)
            for part in parts:
                cut = [replace(whole, first=s.first, count=s.count, base=s.base) for s in part.slices]
                size = sum(s.count for s in cut) * rows * cols
                if size > room and tasks[-1].slices:
                    tasks.append(Slices([]))
                    room = self.target
                tasks[-1].slices += cut
                room -= size
            base += count
        return tasks

    @staticmethod
    def _shape(path: str, label_path: str | None) -> tuple[int, int, int]:
        with _open(path) as f:
            count, rows, cols = _header(f, path, IMAGE_MAGIC, 4)
        if label_path:
            with _open(label_path) as f:
                (n_labels,) = _header(f, label_path, LABEL_MAGIC, 2)
            if n_labels != count:
                raise ValueError(f"{path}: {count} images but {n_labels} labels in {label_path}")
        return count, rows, cols

    def read(self, partition):
        for s in partition.slices:
            rows, cols = s.shape
            size = rows * cols
            per_batch = max(1, BATCH_BYTES // max(1, size))
            wants = lambda name: self.columns is None or name in self.columns
            images = _open(s.path) if wants("pixels") else None
            labels = _open(s.labels) if s.labels and wants("label") else None
            if images:
                _skip(images, 16 + s.first * size, s.path)
            if labels:
                _skip(labels, 8 + s.first, s.labels)
            for done in range(0, s.count, per_batch):
                n = min(per_batch, s.count - done)
                place = np.arange(n, dtype=np.int64) + done
                columns = {
                    "example_id": pa.array(s.base + place), "file": pa.array([s.path] * n),
                    "idx": pa.array(s.first + place), "height": _ints(n, rows), "width": _ints(n, cols),
                    "depth": _ints(n, 1),
                }
                if labels:
                    columns["label"] = _ints(n, np.frombuffer(_exactly(labels, n, s.labels), np.uint8))
                if images:
                    columns["pixels"] = pixel_lists(np.frombuffer(_exactly(images, n * size, s.path), np.uint8).reshape(n, size))
                yield pa.RecordBatch.from_pydict({c: columns[c] for c in self.columns or columns})
            for f in (images, labels):
                if f:
                    f.close()


def _exactly(f, n: int, path: str) -> bytes:
    raw = f.read(n)
    if len(raw) != n:
        raise ValueError(f"{path} ends early")
    return raw


def _skip(f, n: int, path: str) -> None:
    if not path.endswith(".gz"):
        f.seek(n)
        return
    while n > 0:
        n -= len(_exactly(f, min(n, 1 << 20), path))


def read_idx(spark: SparkSession, images_path: str, labels_path: str | None = None,
             target_bytes: int = TARGET_BYTES, columns=None) -> DataFrame:
    """IDX images (and labels) -> example_id, file, idx, shape, [label], pixels.

    The magic must be 2051 for images and 2049 for labels, and the counts must
    agree. Plain files are cut by record ranges; images and labels of a range
    are read by the same task, so no join is needed. Gzip cannot be cut: one
    task per file, spread afterwards. `columns` leaves out the others: without pixels the images are not
    read but for their headers.
    """
    spark.dataSource.register(IdxFiles)
    images_path = qualified(spark, images_path)
    reader = spark.read.format("pixwave_idx").option("target_bytes", target_bytes)
    if labels_path:
        reader = reader.option("labels", qualified(spark, labels_path))
    if columns:
        label = ", label int" if labels_path else ""
        reader = reader.schema(pick_fields(IDX_SCHEMA.replace(", pixels", f"{label}, pixels"), columns))
    df = reader.load(images_path)
    zipped = any(p.endswith(".gz") for p, _ in list_files(images_path))
    return df.repartition("example_id") if zipped and (not columns or "example_id" in columns) else df
