"""Repeated passages, found by difference-cover anchors and cut out of every document.

Any two positions i, j have an offset d below the period with i + d and j + d both
on the difference cover. So two equal passages of `length` words share an anchor
of `length - period + 1` words that starts on the cover in both, and only windows
at cover positions are hashed in search of candidates. Passages around shared
anchors are then extended: windows of the full length are compared by 128 bits,
made from two independent keyed hashes of each word under a key that every run draws.

Rounds, on blocks of whole rows (see `blocks`):
  1. every block sends each distinct anchor and each distinct text digest once;
     buckets answer which of them other blocks have too;
  2. windows around such anchors are sent once per block; buckets answer likewise;
  3. a block marks words covered by windows that it holds twice itself or that
     another block holds, and cuts them out.
Texts that are exact copies of each other are all repeated windows; only one of
them takes part in round 2.
"""

import hashlib
import secrets
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import words as W
from .blocks import (ASKED, BLOCK_BYTES, bucket_rows, default_buckets, from_ipc, per_block, places_of, repeated, saved, texts_of,
                     to_ipc, write_blocks)

ANCHOR, COPY, WINDOW = 0, 1, 2
KEYS = {ANCHOR: 1, COPY: 2, WINDOW: 2}  # 64-bit words of a key


def is_cover(period: int, cover: Sequence[int]) -> bool:
    """Whether the differences of `cover` reach every residue of `period`."""
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


class _Block:
    """Words of the rows of one block."""

    def __init__(self, rows: pa.Table, text: str, length: int, period: int, cover: Sequence[int], key: bytes):
        self.texts = texts_of(rows, text)
        parts, starts = [], [0]
        for few in W.batches(self.texts):
            hashes, begin = W.hash_words(few, key)
            parts.append(hashes)
            starts.extend((begin[1:] + starts[-1]).tolist())
        self.words = np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)  # both hashes of each word
        self.starts = np.array(starts)
        self.counts = np.diff(self.starts)
        self.doc = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        self.length, self.period, self.cover = length, period, cover

    def places(self, length: int) -> np.ndarray:
        """Positions of the block from which `length` words lie in one document."""
        n = len(self.words) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.arange(n)
        return at[at + length <= self.starts[1:][self.doc[:n]]]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        size = self.length - self.period + 1
        at = self.places(size)
        at = at[self.counts[self.doc[at]] >= self.length]
        on = np.zeros(self.period, bool)
        on[list(self.cover)] = True
        at = at[on[(at - self.starts[self.doc[at]]) % self.period]]
        return W.window_hashes(self.words[:, 0], size)[at], at

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        at = self.places(self.length)
        both = [W.window_hashes(self.words[:, which], self.length, which)[at] for which in (0, 1)]
        return np.stack(both, axis=1), at

    def digests(self) -> np.ndarray:
        return np.frombuffer(b"".join(hashlib.md5(t).digest() for t in self.texts), np.uint64).reshape(-1, 2)

    def others(self, found: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose text stands elsewhere too, and those of them that take no part in round 2."""
        digests = self.digests()
        _, first, same, n = np.unique(digests, axis=0, return_index=True, return_inverse=True, return_counts=True)
        same = same.reshape(-1)
        copy = n[same] > 1
        spare = first[same] != np.arange(len(digests))
        at, is_first = places_of(found, COPY)
        if len(at):
            hit = np.isin(same, same[at])
            copy |= hit
            spare |= np.isin(same, same[at[~is_first]])
        return copy, spare


def _distinct(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each key."""
    if keys.ndim == 1:
        _, first = np.unique(keys, return_index=True)
        return keys[first].reshape(-1, 1), at[first]
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]).any(axis=1)]) if len(order) else np.zeros(0, bool)
    first = order[new]
    return keys[first], at[first]


def _held_twice(keys: np.ndarray) -> np.ndarray:
    """Which of the keys ([n, 2]) stand in the block more than once."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    same = (keys[order][1:] == keys[order][:-1]).all(axis=1)
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def _cut(text: bytes, gone: np.ndarray) -> tuple[bytes, int]:
    """The words that stay, joined by one space."""
    if not gone.any():
        return b" ".join(text.split()), 0
    return b" ".join(w for w, g in zip(text.split(), gone.tolist()) if not g), int(gone.sum())


def substring_dedup(docs: DataFrame, text: str = "text", *, length: int = 35, period: int = 21,
                    cover: Sequence[int] = (3, 6, 7, 12, 14),
                    buckets: int | None = None, keep_text: bool = True,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Remove each word covered by a window of `length` words that also starts anywhere else.

    Windows are judged on the input. Words are runs of bytes other than space and 0x09-0x0D, compared unchanged.
    Returns every row with all its columns (the text as it was) and n_words, n_removed, kept_sha256 and, if
    `keep_text`, kept_text: the words that stay, joined by one space. Columns of `docs` with those names are replaced.

    Null text: no words. Empty text: no words, kept text empty. Repeated rows (also of one id, also of a null id): each
    is a place of its own, so all their windows are repeated and both rows come back. Texts shorter than `length` words
    lose nothing. Empty table: no rows, same columns. Long texts are hashed in segments; a row must fit one block.
    """
    if not (1 <= period <= length and is_cover(period, cover)):
        raise ValueError(f"{cover} is no difference cover modulo {period}, or the period is over {length}")
    added = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text
    kept_columns = [f.name for f in docs.schema if f.name.lower() not in added]
    buckets, drawn = buckets or default_buckets(docs), secrets.token_bytes(16)

    def load(payload: bytes) -> tuple[pa.Table, _Block]:
        rows = from_ipc(payload)
        return rows, _Block(rows, text, length, period, cover, drawn)

    def store(block: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([to_ipc(rows)], pa.binary())], names=["block", "payload"])

    def ask_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(*(c.to_pylist() for c in batch.columns)):
                _, b = load(payload)
                keys, at = _distinct(*b.anchors())
                if len(keys):
                    yield bucket_rows(block, ANCHOR, keys, at, buckets)
                long = np.flatnonzero(b.counts >= length)
                if len(long):
                    yield bucket_rows(block, COPY, *_distinct(b.digests()[long], long), buckets)

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload, found in zip(*(c.to_pylist() for c in batch.columns)):
                _, b = load(payload)
                hashes, at = b.anchors()
                shared = np.isin(at, places_of(found, ANCHOR)[0])
                shared = np.isin(hashes, hashes[shared])
                near = np.zeros(len(b.words) + 1, np.int32)
                np.add.at(near, np.maximum(at[shared] - (period - 1), 0), 1)
                np.add.at(near, at[shared] + 1, -1)
                keys, at = b.windows()
                take = (np.cumsum(near)[at] > 0) & ~b.others(found)[1][b.doc[at]]
                keys, at = _distinct(keys[take], at[take])
                if len(keys):
                    yield bucket_rows(block, WINDOW, keys, at, buckets)

    out_schema = T.StructType([docs.schema[c] for c in kept_columns] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())
    ] + [T.StructField("kept_text", T.StringType())] * keep_text)
    arrow = to_arrow_schema(out_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, payload, copies, found in zip(*(c.to_pylist() for c in batch.columns)):
                rows, b = load(payload)
                keys, at = b.windows()
                gone = np.zeros(len(b.words) + 1, np.int32)
                if len(at):
                    hit = np.zeros(len(b.words), bool)
                    hit[places_of(found, WINDOW)[0]] = True
                    known = hit[at]
                    twice = _held_twice(keys)
                    # a key that is held twice here is repeated by that; one that is held once was sent from its own place
                    start = at[known | twice | (b.others(copies)[0][b.doc[at]])]
                    np.add.at(gone, start, 1)
                    np.add.at(gone, start + length, -1)
                gone = np.cumsum(gone)[:-1] > 0
                kept = [_cut(t, gone[s:e]) for t, s, e in zip(b.texts, b.starts, b.starts[1:])]
                columns = [rows.column(c).combine_chunks() for c in kept_columns] + [
                    pa.array(b.counts, pa.int64()), pa.array([k[1] for k in kept], pa.int64()),
                    pa.array([hashlib.sha256(k[0]).hexdigest() for k in kept])
                ] + [pa.array([k[0] for k in kept], pa.binary()).cast(pa.string())] * keep_text
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    stored = write_blocks(docs, text, store, "block long, payload binary", "substring-dedup", block_bytes)
    first = saved(per_block(repeated(stored.mapInArrow(ask_anchors, ASKED), KEYS.get)), "substring-anchors")
    joined = stored.join(first.withColumnRenamed("found", "copies"), "block", "left")
    second = per_block(repeated(joined.mapInArrow(ask_windows, ASKED), KEYS.get))
    # the answers of round 1 are needed again for the copies; both joins read the same exchange of the blocks
    return joined.join(second, "block", "left").mapInArrow(finish, out_schema)


def op1_query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table, whole: its words, how many go, and the digest of the rest."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs, keep_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows and columns of `docs`, their repeated passages cut out of text, and n_chars of what is left.

    Texts that lose nothing stay byte for byte; the others keep their words joined by single spaces. Null and empty texts, and texts of
    under 35 words, lose nothing. Repeated rows, whatever their ids, lose all their windows and stay as rows with what is left. An empty table stays
    empty. Columns with the names of the operator's results come back as they were.
    """
    clash = {c: f"__own {c}" for c in docs.columns if c.lower() in ("n_words", "n_removed", "kept_sha256", "kept_text")}
    done = substring_dedup(docs.withColumnsRenamed(clash))
    cut = F.col("n_removed") > 0
    done = done.withColumn("text", F.when(cut, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return done.drop("n_words", "n_removed", "kept_sha256", "kept_text").withColumnsRenamed({v: k for k, v in clash.items()}).select(*(F.col(f"`{c}`") for c in docs.columns))
