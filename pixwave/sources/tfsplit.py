"""Record boundaries inside large TFRecord files, so that byte ranges of one file are tasks.

Where a record begins stand eight bytes of its length and their masked CRC. Every range looks for the first such place and
follows the lengths to its end, headers alone. Ranges are then stitched: a range that does not begin where the one
before it ended has met bytes inside a record that look like a record, and is followed again from the right place.
So the result is that of reading the file from its beginning, whatever the records hold.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .files import filesystem

WINDOW = 1 << 20
HEAD, FRAME = 12, 16  # bytes before the payload of a record, and beside it
RANGES = "file_no int, path string, size long, start long, stop long, known boolean"
FOUND = "file_no int, start long, stop long, first long, records long, next long, broken long"


def find_boundary(f, at: int, stop: int, size: int) -> int | None:
    """First place from `at` on and before `stop` that holds a length with its masked CRC, for a record that fits the file."""
    from .tfrecord import masked_crcs
    while at < stop:
        raw = f.read_at(min(WINDOW + HEAD - 1, size - at), at)
        n = min(len(raw) - HEAD + 1, stop - at)
        if n <= 0:
            return None
        lengths = np.ndarray((n,), "<u8", raw, strides=(1,))
        crcs = np.ndarray((n,), "<u4", raw, 8, strides=(1,))
        fits = np.flatnonzero(lengths <= np.maximum(size - FRAME - at - np.arange(n), -1).astype(np.int64).clip(0).astype(np.uint64))
        if len(fits):
            right = fits[masked_crcs([raw[i:i + 8] for i in fits.tolist()]) == crcs[fits]]
            if len(right):
                return at + int(right[0])
        at += n
    return None


def follow(f, at: int, stop: int, size: int) -> tuple[int, int, int | None]:
    """Records that begin from `at` on and before `stop`, where the next one begins, and the first place whose header is wrong."""
    from .tfrecord import masked_crcs
    records, raw, base, places, heads = 0, b"", 0, [], []

    def wrong() -> int | None:
        bad = np.flatnonzero(masked_crcs([h[:8] for h in heads]) != np.array([int.from_bytes(h[8:], "little") for h in heads], np.uint32)) if heads else []
        return int(bad[0]) if len(bad) else None

    while at < stop:
        if not base <= at <= base + len(raw) - HEAD:
            raw, base = f.read_at(min(WINDOW, size - at), at), at
        head = raw[at - base:at - base + HEAD]
        places.append(at)
        heads.append(head.ljust(HEAD, b"\0"))
        length = int.from_bytes(head[:8], "little")
        if len(head) < HEAD or at + FRAME + length > size:  # a record that the file does not hold; an earlier header may be wrong too
            bad = wrong()
            k = len(heads) - 1 if bad is None else bad
            return records + k, places[k], places[k]
        at += FRAME + length
        if len(heads) == 4096 or at >= stop:
            bad = wrong()
            if bad is not None:
                return records + bad, places[bad], places[bad]
            records += len(heads)
            places, heads = [], []
    return records, at, None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            system, inner = filesystem(r["path"])
            with system.open_input_file(inner) as f:
                first = r["start"] if r["known"] else find_boundary(f, r["start"], r["stop"], r["size"])
                records, following, broken = (0, None, None) if first is None else follow(f, first, r["stop"], r["size"])
            out.append((r["file_no"], r["start"], r["stop"], first, records, following, broken))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*out))],
                                             names=[c.split()[0] for c in FOUND.split(", ")])


def _found(spark: SparkSession, ranges: list[tuple]) -> list:
    """One row per range; a task takes one range at a time. A row stands for `target` bytes of a file, so they are few."""
    frame: DataFrame = spark.createDataFrame(ranges, RANGES)
    return frame.repartition(len(ranges), "file_no", "start").mapInArrow(_scan, FOUND).collect()


def split_files(spark: SparkSession, files: list[tuple[int, str, int]], target: int) -> list[tuple[int, str, int, int, int]]:
    """(file_no, path, first byte, records, number of the first record) of the ranges of files (file_no, path, size)."""
    paths = {no: (path, size) for no, path, size in files}
    rows = _found(spark, [(no, path, size, at, min(size, at + target), at == 0) for no, path, size in files for at in range(0, size, target)])
    found = {(r.file_no, r.stop): r for r in rows}
    stops = {no: sorted(stop for n, stop in found if n == no) for no in paths}
    while True:
        plan, again = [], []
        for no, (path, size) in paths.items():
            at, record = 0, 0
            for stop in stops[no]:
                if at >= stop:
                    continue
                r = found[no, stop]
                if r.first != at:
                    again.append((no, path, size, at, stop, True))
                    break
                if r.broken is not None:
                    raise ValueError(f"{path}: " + ("it ends early, or a" if r.broken + FRAME > size else "a") + f" record length is wrong at byte {r.broken}")
                plan.append((no, path, at, r.records, record))
                at, record = r.next, record + r.records
        if not again:
            return plan
        found |= {(r.file_no, r.stop): r for r in _found(spark, again)}
