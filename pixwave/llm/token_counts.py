"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

A byte-level BPE never merges across pre-tokens, so a text has as many tokens as
its pre-tokens have pieces. A block of documents keeps, per document, the numbers
and frequencies of its pre-tokens (a sparse row), and sends each distinct
pre-token once, compressed, to the bucket of its hash. The bucket counts every
distinct pre-token's pieces with the library and answers with the counts, in
order; the block joins them to its frequencies and adds up. No token ids are kept, and a pre-token that every document has is sent
once per block.

Texts are split fast: a space between two non-space characters always begins a
pre-token, so parts between such spaces are split by the library once per
distinct part and block. Texts with white space beyond ASCII are split whole.
"""

import os
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .blocks import default_buckets, from_ipc, pack_strings, squeeze, to_ipc, unpack_strings, unsqueeze, write_blocks

_ODD = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
_EDGE = re.compile("^[ \t-\r]| [ \t-\r]|[\t-\r] |[ \t-\r]$")
_BETWEEN = re.compile("(?<=[^ \t-\r]) (?=[^ \t-\r])")

BLOCK_BYTES = 8 << 20  # of text: a larger block repeats fewer pre-tokens
TEXT = "__text"


@lru_cache(maxsize=4)
def _library(spec: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


def _check(spec: str) -> None:
    import json
    s = json.loads(spec)
    pre, model = s.get("pre_tokenizer") or {}, s.get("model") or {}
    plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"]) for a in s.get("added_tokens", []))
    if (s.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or model.get("type") != "BPE" or model.get("dropout") or not plain
            or any(re.search(r"\s", a["content"]) for a in s.get("added_tokens", []))):
        raise ValueError("token_counts needs a byte-level BPE file without normalizer, prefix space or dropout")


class _Numbers(dict):
    """Numbers keys in the order in which they are first seen."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def pre_tokens(library, part: str, special: "re.Pattern | None") -> list[str]:
    """Pre-tokens of a part as substrings; an added token's string is one of its own."""
    if special is not None and special.search(part):
        return [p for s in special.split(part) if s for p in ([s] if special.fullmatch(s) else pre_tokens(library, s, None))]
    return [part[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(part)]


def special_pattern(library) -> "re.Pattern | None":
    added = sorted((a.content for a in library.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None


def split_parts(text: str) -> list[str]:
    """Parts of a text that can be split into pre-tokens one by one; their concatenation with the spaces is the text."""
    if not text or _ODD.search(text):
        return [text] if text else []
    return _BETWEEN.split(text) if _EDGE.search(text) else text.split(" ")


class _Vocabulary:
    """Pre-tokens of a block and the frequencies of each document."""

    def __init__(self, texts: list[str], library):
        special, parts = special_pattern(library), _Numbers()
        number, ids, counts = parts.__getitem__, [], []
        for text in texts:
            found = split_parts(text)
            # the first part has no space before it: it is another key than the same string further on
            ids.append(np.fromiter([parts[(found[0],)], *map(number, found[1:])], np.int64, len(found)) if found else np.zeros(0, np.int64))
            counts.append(len(found))
        tokens, flat, size = _Numbers(), [], []
        for part in parts:
            own = pre_tokens(library, part[0] if isinstance(part, tuple) else " " + part, special)
            flat.extend(map(tokens.__getitem__, own))
            size.append(len(own))
        flat, size = np.array(flat, np.int64), np.array(size, np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        n = size[ids]
        total = int(n.sum())
        inner = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        token = flat[np.repeat(at[ids], n) + inner] if total else np.zeros(0, np.int64)
        # frequent pre-tokens get small numbers, so that the sparse rows compress well
        order = np.argsort(-np.bincount(token, minlength=len(tokens)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        keys, self.freq = np.unique((np.repeat(doc, n) << 32) | rank[token], return_counts=True)
        self.token = keys & 0xFFFFFFFF
        self.begin = np.searchsorted(keys >> 32, np.arange(len(texts) + 1))
        names = list(tokens)
        self.names = [names[i] for i in order]

    def rows(self) -> tuple[pa.Array, pa.Array]:
        """Per document, steps between its sorted pre-token numbers, and their frequencies."""
        step = np.diff(self.token, prepend=0)
        first = self.begin[:-1][self.begin[:-1] < self.begin[1:]]
        step[first] = self.token[first]
        cuts = pa.array(self.begin, pa.int32())
        return (pa.ListArray.from_arrays(cuts, pa.array(step.astype(np.uint32))),
                pa.ListArray.from_arrays(cuts, pa.array(self.freq.astype(np.uint32))))


def token_counts(docs: DataFrame, spec: str, text: str = "text", keep: Sequence[str] = ("doc_id",), *, limit: int = 512,
                 buckets: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`keep` columns of every row with n_bytes, n_tokens and over_limit (more than `limit` tokens).

    `spec` is the content of a tokenizers .json file of a byte-level BPE. Counts are those of
    `encode(text, add_special_tokens=False)` without truncation or padding; strings of added tokens inside a text count as
    the library's default has it.

    Null text: 0 bytes, 0 tokens, like an empty one. Repeated rows and ids, null ids: each row comes back. Empty table: no
    rows. Long texts are split like any other. `keep` columns with a result's name are refused.
    """
    _check(spec)
    keep, buckets = list(keep), buckets or default_buckets(docs)
    if {c.lower() for c in keep} & {"n_bytes", "n_tokens", "over_limit"}:
        raise ValueError("a kept column has the name of a result")

    def store(block: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t or "" for t in rows.column(TEXT).to_pylist()]
        v = _Vocabulary(texts, _library(spec))
        steps, freqs = v.rows()
        bucket = np.fromiter((zlib.crc32(t.encode()) % buckets for t in v.names), np.int64, len(v.names))
        order = np.array(sorted(range(len(v.names)), key=lambda k: (bucket[k], v.names[k])), np.int64)
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
        own = pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), sizes, steps, freqs], names=[*map(str, range(len(keep))), "bytes", "steps", "freqs"])
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist() + [len(order)]
        groups = [order[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([
            pa.array([block] * (len(groups) + 1), pa.int64()), pa.array([-1, *(int(bucket[g[0]]) for g in groups)], pa.int32()),
            pa.array([to_ipc(own), *(pack_strings([v.names[k] for k in g]) for g in groups)], pa.binary()),
            pa.array([squeeze(place.tobytes()), *[None] * len(groups)], pa.binary())], names=["block", "bucket", "payload", "places"])

    def count(rows: pa.Table) -> pa.Table:
        tokens = [unpack_strings(p) for p in rows.column("payload").to_pylist()]
        flat = pa.concat_arrays(tokens).dictionary_encode()
        pieces = np.fromiter((len(e.ids) for e in _library(spec).encode_batch_fast(flat.dictionary.to_pylist(), add_special_tokens=False)), np.uint32)
        each = pieces[flat.indices.to_numpy(zero_copy_only=False)]
        ends = np.cumsum([len(t) for t in tokens])
        return pa.Table.from_arrays([rows.column("block"), rows.column("bucket"),
                                     pa.array([squeeze(p.tobytes()) for p in np.split(each, ends[:-1])], pa.binary())], names=["block", "bucket", "pieces"])

    out_schema = T.StructType([docs.schema[c] for c in keep]).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    arrow = to_arrow_schema(out_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, places, found in zip(*(batch.column(c).to_pylist() for c in ("payload", "places", "found"))):
                own = from_ipc(payload).combine_chunks()
                # answers in the order of the buckets are in the order of the places
                pieces = np.frombuffer(b"".join(unsqueeze(f["pieces"]) for f in sorted(found or [], key=lambda f: f["bucket"])), np.uint32).astype(np.int64)
                pieces = pieces[np.frombuffer(unsqueeze(places), np.uint32)]
                steps, freqs = own.column("steps").combine_chunks(), own.column("freqs").combine_chunks()
                begin = steps.offsets.to_numpy().astype(np.int64)
                token = np.cumsum(steps.values.to_numpy().astype(np.int64))
                # steps start anew in each document
                before = np.concatenate([[0], token])[begin[:-1]]
                token = token - np.repeat(before, np.diff(begin))
                sums = np.concatenate([[0], np.cumsum(pieces[token] * freqs.values.to_numpy())])
                n = sums[begin[1:]] - sums[begin[:-1]]
                columns = [*(own.column(str(i)).combine_chunks() for i in range(len(keep))), own.column("bytes").combine_chunks(), pa.array(n, pa.int64()), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    stored = write_blocks(docs.select(*keep, F.col(text).alias(TEXT)), TEXT, store, "block long, bucket int, payload binary, places binary",
                          "token-counts", block_bytes)
    answers = (stored.where("bucket >= 0").select("block", "bucket", "payload").groupBy("bucket")
               .applyInArrow(count, "block long, bucket int, pieces binary")
               .groupBy("block").agg(F.collect_list(F.struct("bucket", "pieces")).alias("found")))
    rows = stored.where("bucket = -1").select("block", "payload", "places")
    return rows.join(answers, "block", "left").mapInArrow(finish, out_schema)


def op10_query(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document of the table by the 50k byte-level vocabulary."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), spec)
