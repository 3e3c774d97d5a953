"""Documents as written blocks, and questions that blocks ask each other by hash.

A block is a few megabytes of whole rows (all columns, compressed Arrow stream),
written once to the shared scratch folder. Stages that need the texts again join
on the block id, so what travels between stages is a compact array per block and
bucket instead of a row per word. A key that a third of all rows share is sent
once per block, never once per row.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

BLOCK_BYTES = 4 << 20


def default_buckets(df: DataFrame) -> int:
    """Hash buckets of a round: a few per shuffle partition, so that they grow with the cluster's setting."""
    return 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def to_ipc(table: pa.Table | pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def from_ipc(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor().compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_strings(strings: list[str]) -> bytes:
    """Strings as one compressed value: their number, their lengths in bytes, and their bytes."""
    raw = [s.encode() for s in strings]
    sizes = np.fromiter(map(len, raw), np.uint32, len(raw))
    return squeeze(np.uint32(len(raw)).tobytes() + sizes.tobytes() + b"".join(raw))


def unpack_strings(data: bytes) -> pa.LargeStringArray:
    raw = unsqueeze(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64))])
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[4 + 4 * n:]))


def texts_of(rows: pa.Table | pa.RecordBatch, text: str) -> list[bytes]:
    """UTF-8 texts of a column; null is empty."""
    column = rows.column(text)
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def cut_blocks(batch: pa.RecordBatch, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about `size` bytes of text each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(lengths + 64) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_blocks(df: DataFrame, text: str, make: Callable[[int, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
                 name: str, size: int = BLOCK_BYTES) -> DataFrame:
    """Write `make(block id, rows)` of every block of `df` and read it back.

    Block ids hold for what was written, whatever order a later run would read the rows in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in cut_blocks(batch, text, size):
                yield from make(block, rows)
                block += 1

    return saved(df.mapInArrow(run, schema), name)


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back: computed once, and without its lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_rows(block: int, kind: int, keys: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket: the keys ([n, 1 or 2] of uint64) that fall in it, and their places in the block."""
    bucket = (keys[:, 0] % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, places, bucket = keys[order], places[order].astype(np.uint32), bucket[order]
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    rows = [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]
    return pa.RecordBatch.from_arrays([
        pa.array([kind] * len(rows), pa.int32()),
        pa.array([int(bucket[a]) for a, _ in rows], pa.int32()),
        pa.array([block] * len(rows), pa.int64()),
        pa.array([keys[a:b].tobytes() for a, b in rows], pa.binary()),
        pa.array([places[a:b].tobytes() for a, b in rows], pa.binary()),
    ], names=["kind", "bucket", "block", "keys", "places"])


ASKED = "kind int, bucket int, block long, keys binary, places binary"


def repeated(asked: DataFrame, width: Callable[[int], int]) -> DataFrame:
    """Of the keys that blocks sent, the places of those that more than one block has.

    Returns (block, kind, places, first): `first` marks one byte per place, 1 in the smallest block that has the key.
    """
    def meet(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind")[0].as_py()
        blocks = rows.column("block").to_numpy()
        keys = [np.frombuffer(k, np.uint64).reshape(-1, width(kind)) for k in rows.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        keys = np.concatenate(keys)
        owner = np.repeat(np.arange(len(blocks)), sizes)
        order = np.lexsort((blocks[owner], *keys.T[::-1]))
        same = (keys[order][1:] == keys[order][:-1]).all(axis=1)
        again, first = np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8)
        again[order[1:]] = same
        first[order] = np.concatenate([[True], ~same])
        again[order[:-1]] |= same
        out = []
        ends = np.cumsum(sizes)
        for k, (end, n, places) in enumerate(zip(ends, sizes, rows.column("places").to_pylist())):
            hit = again[end - n:end]
            if hit.any():
                out.append((int(blocks[k]), kind, np.frombuffer(places, np.uint32)[hit].tobytes(), first[end - n:end][hit].tobytes()))
        return pa.Table.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
            names=["block", "kind", "places", "first"])

    return asked.groupBy("kind", "bucket").applyInArrow(meet, "block long, kind int, places binary, first binary")


def per_block(found: DataFrame) -> DataFrame:
    """All answers to a block in one row; their size is bounded by the block's."""
    return found.groupBy("block").agg(F.collect_list(F.struct("kind", "places", "first")).alias("found"))


def places_of(found: list[dict] | None, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and first-marks of one kind."""
    mine = [f for f in found or [] if f["kind"] == kind]
    if not mine:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    return (np.concatenate([np.frombuffer(f["places"], np.uint32) for f in mine]).astype(np.int64),
            np.concatenate([np.frombuffer(f["first"], np.uint8) for f in mine]).astype(bool))
