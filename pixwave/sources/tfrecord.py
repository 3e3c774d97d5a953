"""TFRecord files of Example messages with int64 lists, as a Spark source and sink."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, WriterCommitMessage

from ..session import shared_dir
from .files import TARGET_BYTES, Slice, Slices, filesystem, list_files, qualified
from .tfsplit import split_files

# Fixed values of the file format: reversed CRC-32C polynomial and mask constant.
CRC32C_POLYNOMIAL = 0x82F63B78
CRC_MASK_DELTA = 0xA282EAD8
READ_BYTES = 2 << 20


def _crc_table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(CRC32C_POLYNOMIAL), crc >> 1).astype(np.uint32)
    return crc


def masked_crcs(messages: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each message.

    Messages are taken together by the power of two of their length, so that one
    long message does not widen the buffer of many short ones.
    """
    out = np.empty(len(messages), np.uint32)
    classes = np.array([len(m).bit_length() for m in messages])
    for size in np.unique(classes):
        places = np.flatnonzero(classes == size)
        out[places] = _crcs_together([messages[i] for i in places])
    return out


def _crcs_together(messages: list[bytes]) -> np.ndarray:
    """One numpy step per byte position over all messages."""
    lengths = np.array([len(m) for m in messages])
    order = np.argsort(-lengths, kind="stable")
    buffer = np.zeros((int(lengths.max(initial=0)), len(messages)), np.uint8)
    for place, i in enumerate(order):
        buffer[:lengths[i], place] = np.frombuffer(messages[i], np.uint8)
    alive = len(messages) - np.searchsorted(np.sort(lengths), np.arange(len(buffer)), side="right")
    table, crc = _crc_table(), np.full(len(messages), 0xFFFFFFFF, np.uint32)
    for column, n in zip(buffer, alive):
        head = crc[:n]
        crc[:n] = table[(head ^ column[:n]) & 0xFF] ^ (head >> np.uint32(8))
    crc = ~crc
    masked = ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(CRC_MASK_DELTA)
    out = np.empty_like(masked)
    out[order] = masked
    return out


def varint(value: int) -> bytes:
    """One non-negative number as a varint."""
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def encode_lists(values: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """int64 values of several lists, one after the other -> the varints of each list."""
    bits = values.astype(np.int64).view(np.uint64)
    width = max(1, -(-int(bits.max(initial=0)).bit_length() // 7))
    groups = bits[:, None] >> (np.arange(width, dtype=np.uint64) * np.uint64(7))
    size = np.maximum(1, (groups != 0).sum(axis=1))
    place = np.arange(width)
    more = (place < size[:, None] - 1) * np.uint8(0x80)
    raw = ((groups & np.uint64(0x7F)).astype(np.uint8) | more)[place < size[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(lengths)].tolist()
    return [raw[i:j] for i, j in zip([0, *ends], ends)]


def decode_varints(raw: bytes) -> np.ndarray:
    """Concatenated varints -> int64 values."""
    if not raw:
        return np.zeros(0, np.int64)
    data = np.frombuffer(raw, np.uint8)
    starts = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    shift = (np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))) * 7
    parts = (data & 0x7F).astype(np.uint64) << shift.astype(np.uint64)
    return np.bitwise_or.reduceat(parts, starts).view(np.int64)


def _field(number: int, payload: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def encode_example(lists: dict[str, bytes]) -> bytes:
    """Example message with one packed list of varints per name."""
    entries = b"".join(
        _field(1, _field(1, name.encode()) + _field(2, _field(3, _field(1, packed))))
        for name, packed in lists.items())
    return _field(1, entries)


def encode_batch(names: list[str], columns: list[pa.Array], values: int = 1 << 18):
    """Lists of Example messages for an Arrow batch, about `values` list values at a time."""
    rows = len(columns[0])
    step = max(1, int(values * max(rows, 1) / max(1, sum(len(c.values) for c in columns))))
    for at in range(0, rows, step):
        packed = []
        for column in columns:
            part = column.slice(at, step)
            lengths = np.asarray(part.value_lengths().fill_null(0))
            packed.append(encode_lists(np.asarray(part.flatten()), lengths))
        yield [encode_example(dict(zip(names, row))) for row in zip(*packed)]


def _varint_at(raw: bytes, at: int) -> tuple[int, int]:
    """The varint at a place, and the place after it."""
    byte = raw[at]
    if byte < 128:
        return byte, at + 1
    value, shift = byte & 0x7F, 7
    while byte > 127:
        at += 1
        byte = raw[at]
        value |= (byte & 0x7F) << shift
        shift += 7
    return value, at + 1


def _fields(raw: bytes):
    """(number, wire type, payload) of each field of a message."""
    at = 0
    while at < len(raw):
        key, at = _varint_at(raw, at)
        wire = key & 7
        if wire == 0:
            _, end = _varint_at(raw, at)
        elif wire == 2:
            size, at = _varint_at(raw, at)
            end = at + size
        else:
            end = at + {1: 8, 5: 4}[wire]
        yield key >> 3, wire, raw[at:end]
        at = end


def packed_lists(raw: bytes) -> dict[str, bytes]:
    """Varints of the int64 lists of an Example message, packed or not."""
    out = {}
    for _, _, features in (f for f in _fields(raw) if f[0] == 1):
        for _, _, entry in _fields(features):
            pair = {number: payload for number, _, payload in _fields(entry)}
            for number, _, int64_list in _fields(pair.get(2, b"")):
                if number == 3:
                    out[pair[1].decode()] = b"".join(p for n, _, p in _fields(int64_list) if n == 1)
    return out


def decode_column(packed: list[bytes | None]) -> pa.Array:
    """Varints of one list per row -> list<int64> column; None is a missing list."""
    sizes = np.array([len(p or b"") for p in packed], dtype=np.int64)
    raw = b"".join(p or b"" for p in packed)
    counts = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint8) < 128)])
    offsets = np.concatenate([[0], counts[np.cumsum(sizes)]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(decode_varints(raw)),
                                    mask=pa.array([p is None for p in packed]))


class TFRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pixwave_tfrecord"

    def _names(self) -> list[str]:
        return self.options["fields"].split(",")

    def schema(self) -> str:
        return "file_no int, record_no long, " + ", ".join(f"`{n}` array<long>" for n in self._names())

    def reader(self, schema) -> "TFRecordReader":
        return TFRecordReader(self.options["path"], self._names(),
                              int(self.options.get("target_bytes", str(TARGET_BYTES))), self.options.get("plan"))

    def writer(self, schema, overwrite) -> "TFRecordWriter":
        return TFRecordWriter(self.options["path"], schema.names, overwrite)


@dataclass
class RecordSlice(Slice):
    """`count` records of a file from the byte `first` on (all of them, if negative); `base` is the number of the first one."""
    file_no: int = 0


class TFRecordReader(DataSourceReader):
    """One task per group of small files or range of a large one, as planned by `read_tfrecords`."""

    def __init__(self, path: str, names: list[str], target: int, plan: str | None):
        self.path, self.names, self.target, self.plan = path, names, target, plan

    def _ranges(self) -> dict[int, list[RecordSlice]]:
        out: dict[int, list[RecordSlice]] = {}
        if self.plan:
            system, inner = filesystem(self.plan)
            for info in system.get_file_info(fs.FileSelector(inner)):
                if info.is_file and info.base_name[0] not in "._":
                    with system.open_input_file(info.path) as f:
                        for r in pq.read_table(f).to_pylist():
                            out.setdefault(r["file_no"], []).append(RecordSlice(r["path"], r["first"], r["records"], r["record_no"], r["file_no"]))
        return out

    def partitions(self):
        ranges, tasks, room = self._ranges(), [], 0
        for no, (path, size) in enumerate(list_files(self.path)):
            for s in sorted(ranges.get(no, []), key=lambda s: s.base):
                if s.count:
                    tasks.append(Slices([s]))
                    room = 0
            if no not in ranges:
                if room <= 0:
                    tasks.append(Slices([]))
                    room = self.target
                tasks[-1].slices.append(RecordSlice(path, 0, -1, 0, no))
                room -= size
        return tasks or [Slices([])]

    def read(self, partition):
        for s in partition.slices:
            record_no = s.base
            for messages in _messages(s.path, s.first, s.count):
                lists = [packed_lists(m) for m in messages]
                columns = {
                    "file_no": pa.array([s.file_no] * len(lists), pa.int32()),
                    "record_no": pa.array(record_no + np.arange(len(lists), dtype=np.int64)),
                }
                for name in self.names:
                    columns[name] = decode_column([d.get(name) for d in lists])
                record_no += len(lists)
                yield pa.RecordBatch.from_pydict(columns)


def _messages(path: str, first: int = 0, count: int = -1):
    """Checked payloads of `count` records (or all) of a file from a byte on, about READ_BYTES at a time."""
    system, inner = filesystem(path)
    with system.open_input_file(inner) as plain:
        plain.seek(first)
        f = pa.BufferedInputStream(plain, 1 << 20)
        batch, sizes, crcs, held = [], [], [], 0
        while True:
            head = f.read(12) if count else b""
            count -= 1
            if not head and count >= 0:
                raise ValueError(f"{path} ends early")
            if head:
                size = int.from_bytes(head[:8], "little")
                body = f.read(size + 4) if len(head) == 12 else b""
                if len(body) != size + 4:
                    raise ValueError(f"{path} ends early")
                batch.append(bytes(body[:size]))
                sizes.append(bytes(head[:8]))
                crcs += [int.from_bytes(head[8:], "little"), int.from_bytes(body[size:], "little")]
                held += size
            if batch and (held >= READ_BYTES or not head):
                expected = np.stack([masked_crcs(sizes), masked_crcs(batch)], axis=1).ravel()
                if not np.array_equal(expected, np.array(crcs, np.uint32)):
                    raise ValueError(f"{path}: record checksum mismatch")
                yield batch
                batch, sizes, crcs, held = [], [], [], 0
            if not head:
                return


@dataclass
class PartFile(WriterCommitMessage):
    name: str | None


class TFRecordWriter(DataSourceArrowWriter):
    """Each task attempt writes its own file; the commit moves the files of the winning attempts."""

    def __init__(self, path: str, names: list[str], overwrite: bool):
        self.path, self.names, self.overwrite = path, names, overwrite
        self.job = uuid.uuid4().hex[:12]

    def _staging(self) -> str:
        return f"{self.path.rstrip('/')}/_staging-{self.job}"

    def write(self, iterator):
        system, folder = filesystem(self._staging())
        system.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.tfrecord"
        rows = 0
        with system.open_output_stream(f"{folder}/{name}") as f:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(n)) for n in self.names]
                for messages in encode_batch(self.names, columns):
                    sizes = [len(m).to_bytes(8, "little") for m in messages]
                    framed = zip(sizes, masked_crcs(sizes), messages, masked_crcs(messages))
                    f.write(b"".join(s + int(sc).to_bytes(4, "little") + m + int(mc).to_bytes(4, "little")
                                     for s, sc, m, mc in framed))
                    rows += len(messages)
        if rows == 0:
            system.delete_file(f"{folder}/{name}")
        return PartFile(name if rows else None)

    def commit(self, messages):
        system, target = filesystem(self.path.rstrip("/"))
        _, staging = filesystem(self._staging())
        system.create_dir(target, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(target)):
                if info.is_file:
                    system.delete_file(info.path)
        # one name per partition number, so the order of the files is that of the partitions
        names = [m.name for m in messages if m is not None and m.name]
        with ThreadPoolExecutor(32) as threads:  # an object store copies for each move
            list(threads.map(lambda name: system.move(f"{staging}/{name}", f"{target}/{name}"), names))
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)

    def abort(self, messages):
        system, staging = filesystem(self._staging())
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)


def read_tfrecords(spark: SparkSession, path: str, fields=("image", "label"),
                   target_bytes: int = TARGET_BYTES) -> DataFrame:
    """TFRecord files -> file_no, record_no and one array<long> column per field.

    A file over `target_bytes` is read by several tasks; a job finds the ranges beforehand from the headers of its
    records (see `tfsplit`).
    """
    spark.dataSource.register(TFRecords)
    path = qualified(spark, path)
    reader = spark.read.format("pixwave_tfrecord").option("fields", ",".join(fields)).option("target_bytes", target_bytes)
    large = [(no, name, size) for no, (name, size) in enumerate(list_files(path)) if size > target_bytes]
    if large:
        plan = qualified(spark, shared_dir(spark, "tfrecord-plan"))
        spark.createDataFrame(split_files(spark, large, target_bytes), "file_no int, path string, first long, records long, record_no long").write.parquet(plan)
        reader = reader.option("plan", plan)
    return reader.load(path)


def write_tfrecords(df: DataFrame, path: str, fields=("image", "label"), mode: str = "append") -> None:
    """Write the array columns `fields` as Example messages, one part file per task."""
    df.sparkSession.dataSource.register(TFRecords)
    lists = df.select(*[df[f].cast("array<long>").alias(f) for f in fields])
    (lists.write.format("pixwave_tfrecord").option("fields", ",".join(fields)).mode(mode)
     .save(qualified(df.sparkSession, path)))
