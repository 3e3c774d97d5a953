"""Byte-pair encoding and decoding with the vocabulary and merges of a tokenizers file.

The symbols of a pre-token are a doubly linked list. A heap holds the merges that its neighbours allow, least rank
first and leftmost among equals; an entry whose symbols have changed since it was pushed is stale and skipped. Decoding
concatenates the strings of the vocabulary and maps their characters back to bytes.

Encoding and decoding are narrow passes: no shuffle, nothing gathered. A worker keeps the ids of parts it has met of late
(see `parts`), so each distinct part is merged about once per worker.
"""

import json
import os
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .blocks import cut_blocks
from .parts import LETTER, Store, numbered, units

BATCH_BYTES = 1 << 20  # of text that a batch of results comes from
# Texts of these characters are cut by the expression below, which is that of byte-level files with their classes of letters
# and digits written out; all others are cut by the library.
_PLAIN = re.compile(f"[\t-\r -~{LETTER}]*")
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s{LETTER}0-9]+|\s+(?!\S)|\s+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others from U+0100 on in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Codec:
    """Vocabulary of one file and, to encode, its merges."""

    def __init__(self, spec: str, encodes: bool = True):
        s = json.loads(spec)
        pre, model, decoder = (s.get(k) or {} for k in ("pre_tokenizer", "model", "decoder"))
        added = s.get("added_tokens") or []
        if (s.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or decoder.get("type") != "ByteLevel" or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")
                or any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or re.search(r"\s", a["content"]) for a in added)):
            raise ValueError("the file is no plain byte-level BPE: normalizer, prefix space, dropout or affixes are not supported")
        vocab, symbols = model["vocab"], byte_characters()
        if not all(c in vocab for c in symbols):
            raise ValueError("the vocabulary lacks a symbol for some byte")
        self.added = {a["content"]: a["id"] for a in added}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        names = {i: t for t, i in [*vocab.items(), *self.added.items()]}
        code = {c: b for b, c in enumerate(symbols)}
        self.table = pa.array([*(bytes(map(code.__getitem__, t)) if all(c in code for c in t) else t.encode()
                                 for t in (names.get(i, "") for i in range(max(names) + 1))), b""], pa.large_binary())
        if not encodes:
            return
        self.first = [vocab[c] for c in symbols]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.made = [vocab[a + b] for a, b in pairs]  # by rank
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine
        from tokenizers import pre_tokenizers
        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str  # all that is needed of the library
        self.units = Store()

    def merge(self, word: bytes) -> list[int]:
        """Symbols of a pre-token after all merges."""
        symbols, n = list(map(self.first.__getitem__, word)), len(word)
        rank, made = self.rank.get, self.made
        heap, current = [], [-1] * n  # entries rank * n + place, and the one that holds for the pair at each place
        for i in range(n - 1):
            r = rank(symbols[i] << 32 | symbols[i + 1])
            if r is not None:
                current[i] = r * n + i
                heap.append(r * n + i)
        if not heap:
            return symbols
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry % n
            if current[i] != entry:
                continue  # stale
            new = symbols[i] = made[entry // n]
            j = after[i]
            symbols[j] = current[j] = -1
            after[i] = k = after[j]
            r = None
            if k < n:
                before[k] = i
                r = rank(new << 32 | symbols[k])
            if r is None:
                current[i] = -1
            else:
                current[i] = entry = r * n + i
                heappush(heap, entry)
            h = before[i]
            if h >= 0:
                r = rank(symbols[h] << 32 | new)
                if r is None:
                    current[h] = -1
                else:
                    current[h] = entry = r * n + h
                    heappush(heap, entry)
        return [s for s in symbols if s >= 0]

    def ids(self, text: str) -> bytes:
        """Ids of a text without added tokens, merged now."""
        words = _CUT.findall(text) if _PLAIN.fullmatch(text) else [text[a:b] for _, (a, b) in self.cut(text)]
        merged = self.merge(words[0].encode()) if len(words) == 1 else [i for w in words for i in self.merge(w.encode())]
        return struct.pack(f"<{len(merged)}I", *merged)

    def many(self, new: list[str]) -> list[bytes]:
        return [self.ids(u[1:] if u[0] == "\0" else u) for u in new]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; strings of added tokens are those tokens."""
        pieces, owner, whole = [], [], {}
        for i, text in enumerate(texts):
            if self.special is not None and self.special.search(text):
                for k, piece in enumerate(self.special.split(text)):
                    if k % 2:
                        whole[len(pieces)] = np.array([self.added[piece]], "<u4").tobytes()
                    pieces.append("" if k % 2 else piece)
                    owner.append(i)
            else:
                pieces.append(text)
                owner.append(i)
        names, number, begin = numbered(pieces)
        # the first part of a piece has no space before it: it is a value of its own
        first = [p for p in range(len(pieces)) if begin[p] < begin[p + 1]]
        leading = names.take(pa.array(number[begin[first]])).to_pylist() if first else []
        split = units(names)
        coded = split.flatten().dictionary_encode()
        values = pa.array([*self.units.fetch(coded.dictionary.to_pylist(), self.many), *map(self.ids, leading)], pa.large_binary())
        # a list of numbers of values for each distinct part, and for each of the first parts
        n = len(coded.dictionary)
        lists = pa.concat_arrays([pa.LargeListArray.from_arrays(split.offsets, coded.indices.cast(pa.int64())),
                                  pa.LargeListArray.from_arrays(np.arange(len(first) + 1), pa.array(n + np.arange(len(first))))])
        number = number.astype(np.int64)
        number[begin[first]] = len(names) + np.arange(len(first))
        each = lists.take(pa.array(number))
        begin = np.concatenate([[0], np.cumsum(pc.list_value_length(each).to_numpy(zero_copy_only=False))]).astype(np.int64)[begin]
        joined = values.take(each.flatten())
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, 8 * joined.offset) if len(joined) else np.zeros(1, np.int64)
        data, at = memoryview(joined.buffers()[2] or b""), ends[begin].tolist()
        out = [[] for _ in texts]
        for p, i in enumerate(owner):
            out[i].append(whole.get(p) or data[at[p]:at[p + 1]])
        return [b"".join(o) for o in out]

    def decode(self, ids: list[np.ndarray]) -> pa.Array:
        return texts_of_ids(self.table, ids)


def texts_of_ids(table: pa.Array, ids: list[np.ndarray]) -> pa.Array:
    """Texts of ids; ids that the vocabulary has not are left out, and bytes that are no UTF-8 become U+FFFD.

    `table` holds the bytes of each id and, last, an entry of no bytes.
    """
    sizes = [len(i) for i in ids]
    flat = np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64, copy=False)
    flat[(flat < 0) | (flat >= len(table))] = len(table) - 1
    joined = table.take(pa.array(flat))
    ends = np.frombuffer(joined.buffers()[1], np.int64, len(flat) + 1, 8 * joined.offset) if len(flat) else np.zeros(1, np.int64)
    at = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(at.astype(np.int64).tobytes()), joined.buffers()[2]])
    try:
        return texts.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())


@lru_cache(maxsize=2)
def codec(spec: str, encodes: bool = True) -> Codec:
    return Codec(spec, encodes)


def _refuse(keep: Sequence[str], names: Sequence[str]) -> None:
    if {c.lower() for c in keep} & set(names):
        raise ValueError("a kept column has the name of a result")


def encode(docs: DataFrame, spec: str, text: str = "text", keep: Sequence[str] = ("doc_id",), *, packed: bool = False,
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """`keep` columns of every row, with ids (array<int>; if `packed`, binary: little-endian unsigned 32-bit) and n_tokens.

    `spec` is the content of a tokenizers .json file of a byte-level BPE. The ids are those of the library's
    `encode(text, add_special_tokens=False)` without truncation or padding; strings of added tokens inside a text are those
    tokens, as is the library's default.

    Null text: no ids, like an empty one. Repeated rows and ids, null ids: each row comes back. Empty table: no rows. Texts of
    any length are encoded whole. `keep` columns with a result's name are refused; other columns are not looked at.
    """
    keep = list(keep)
    _refuse(keep, ("ids", "n_tokens"))
    codec(spec)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([docs.schema[c] for c in keep]).add("ids", kind, False).add("n_tokens", "long", False)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec)
        for batch in batches:
            for rows in cut_blocks(batch, "__text", batch_bytes):
                ids = own.encode([t or "" for t in rows.column("__text").to_pylist()])
                sizes = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
                if packed:
                    column = pa.array(ids, pa.binary())
                else:
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
                columns = [*(rows.column(str(i)) for i in range(len(keep))), column, pa.array(sizes)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return docs.select(*(F.col(c).alias(str(i)) for i, c in enumerate(keep)), F.col(text).alias("__text")).mapInArrow(run, schema)


def decode(rows: DataFrame, spec: str, ids: str = "ids", out: str = "decoded", *, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """All columns of `rows` and `out`: the text of the ids (array of integers, or packed as by `encode`).

    Special tokens stay. Null ids: null. No ids: an empty text. Ids that the vocabulary has not are left out, as the library
    does. Repeated rows come back each; empty table: no rows. A column with the name of the result is refused.
    """
    _refuse(rows.columns, (out.lower(),))
    packed = isinstance(rows.schema[ids].dataType, T.BinaryType)
    place = str(rows.columns.index(ids))
    schema = T.StructType(list(rows.schema.fields)).add(out, "string")
    arrow = to_arrow_schema(schema)
    table = codec(spec, False).table  # tasks get this alone: the file with its merges takes many times its room to read

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut_blocks(batch, place, 4 * batch_bytes) if packed else [batch]:
                values = part.column(place)
                ids = [np.frombuffer(i or b"", "<u4") if packed else np.array([x for x in i or () if x is not None], np.int64) for i in values.to_pylist()]
                texts = pc.if_else(values.is_null(), None, texts_of_ids(table, ids))
                columns = [*(part.column(str(i)) for i in range(len(schema) - 1)), texts]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.select(*(F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(rows.columns))).mapInArrow(run, schema)


def op13_query(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document of the table by the 50k byte-level vocabulary, as digests."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    done = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), spec, packed=True), spec)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
