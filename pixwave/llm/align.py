"""Two tokenizers over the same bytes: groups of tokens between common ends, and how often ids end together.

Spans that the libraries report are coarse cuts: the characters of a byte-level token, and the spans of a sentence
piece's proto. Where a token's decoded bytes do not fill its span (tokens inside a multibyte character, byte-fallback
pieces, spaces in front), its end is refined by the lengths of the decoded bytes since the last exact cut.

A text is cut into parts that both tokenizers treat one by one (see `parts`), and these after letters and line breaks; a
worker aligns what it has met of late only once. A part is a row of codes: its tokens in the order of the groups, marked as inner or last of their side. Blocks of
documents are written once with their sparse counts of linked id pairs; pair counts are summed by Spark over the
distinct pairs of blocks and joined back to the blocks, so what is shuffled is a row per distinct pair and block.
"""

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .blocks import from_ipc, to_ipc, write_blocks
from .bpe import byte_characters
from .parts import LETTER, Store, numbered, units

TEXT = "__text"
BLOCK_BYTES = 8 << 20  # of text: a larger block repeats fewer pairs
_BARE = re.compile(f"[{LETTER}]")
AT_ONCE = 1 << 16  # characters of new parts that go through the libraries together
MARK = "▁"  # stands for a space in sentence pieces
# codes: an id and, above it, the side and whether it is the last token of its group
A_INNER, A_LAST, B_INNER, B_LAST = 0, 1, 2, 3
SHIFT, ID = 30, (1 << 30) - 1


def token_bytes_a(spec: dict) -> dict[int, bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    code = {c: b for b, c in enumerate(byte_characters())}
    out = {i: bytes(map(code.__getitem__, t)) for t, i in spec["model"]["vocab"].items() if all(c in code for c in t)}
    return {**out, **{a["id"]: a["content"].encode() for a in spec.get("added_tokens") or []}}


def token_bytes_b(pieces) -> dict[int, bytes]:
    """Bytes of each piece: `MARK` is a space, <0xHH> of a byte piece is that byte; control and unknown pieces have none."""
    out = {}
    for i, p in enumerate(pieces):
        if p.type == 6:
            out[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type not in (2, 3):
            out[i] = p.piece.replace(MARK, " ").encode()
    return out


def refined(lengths: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Byte ends of tokens from their decoded lengths and their coarse spans.

    A span that its token's bytes fill is exact; after it, and up to the next such span, lengths are added up.
    """
    sums = np.cumsum(lengths)
    exact = (end - begin == lengths) & (end > begin)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(lengths)), -1))
    return np.where(last >= 0, end[last] + sums - sums[last], sums)


class Aligner:
    """Both libraries and what is known of their tokens."""

    def __init__(self, spec: str, model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer
        s, proto = json.loads(spec), sentencepiece_model_pb2.ModelProto.FromString(model)
        pre, norm = s.get("pre_tokenizer") or {}, proto.normalizer_spec
        if (s.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
                or s["model"].get("type") != "BPE" or s["model"].get("dropout") or not all(a["special"] for a in s.get("added_tokens") or [])):
            raise ValueError("the first file is no plain byte-level BPE")
        if (norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or proto.trainer_spec.model_type != 2 or proto.trainer_spec.treat_whitespace_as_suffix
                or any(p.type == 4 or p.type == 1 and (MARK in p.piece.lstrip(MARK) or "\n" in p.piece or re.search(f"[{LETTER}][^{LETTER}]", p.piece))
                       for p in proto.pieces)):
            raise ValueError("the second file is no BPE of pieces with spaces only in front and letters only at the end, or it normalizes its text")
        self.a = Tokenizer.from_str(spec)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        sides = [token_bytes_a(s), token_bytes_b(proto.pieces)]
        self.bytes = [pa.array([t.get(i, b"") for i in range(max(t) + 1)], pa.large_binary()) for t in sides]
        self.lengths = [np.fromiter((len(t.get(i, b"")) for i in range(max(t) + 1)), np.int64) for t in sides]
        # a code's place in the table of written tokens: side and mark first, then the id
        sizes = [len(self.lengths[k >> 1]) for k in range(4)]
        self.place = np.concatenate([[0], np.cumsum(sizes)])
        self.written = pa.array([f"{i}{end}" for n, end in zip(sizes, (",", "|", ",", ";")) for i in range(n)], pa.large_string())
        self.units = Store()

    def joined(self, side: int, ids: np.ndarray) -> bytes:
        """Decoded bytes of ids."""
        flat = self.bytes[side].take(pa.array(ids))
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(ids) + 1, 8 * flat.offset)
        return (flat.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[ends[0]:ends[-1]]

    def tokens(self, text: str) -> tuple[list[np.ndarray], list[np.ndarray]] | None:
        """Ids and byte ends of both sides for a space and the text; None if a side's bytes are others."""
        raw = (" " + text).encode()
        one = self.a.encode(" " + text, add_special_tokens=False)
        # the proto's spans, in bytes; this release gives them as a mapping
        two = self.b.encode(text, return_type="offset_mapping", return_bytes=True)
        ids = [np.array(one.ids, np.int64), np.array(two["ids"], np.int64)]
        if any(self.joined(k, i) != raw for k, i in enumerate(ids)):
            return None
        spans = [np.fromiter(chain.from_iterable(o), np.int64).reshape(-1, 2) for o in (one.offsets, two["offsets"])]
        spans[1] += 1
        if len(raw) > len(text) + 1:  # characters to bytes
            first = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            spans[0] = np.append(np.flatnonzero(first), len(raw))[spans[0]]
        return ids, [refined(self.lengths[k][i], s[:, 0], s[:, 1]) for k, (i, s) in enumerate(zip(ids, spans))]

    def codes(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Codes of a space and the text, and for each code the byte at which its group ends."""
        found = self.tokens(text)
        if found is None:
            return None
        ids, ends = found
        both = np.zeros(int(ends[0][-1]) + 1, bool)
        both[ends[1]] = True
        cuts = ends[0][both[ends[0]]]
        out, at, order = [], [], []
        for side, (i, e) in enumerate(zip(ids, ends)):
            group = np.searchsorted(cuts, e)
            out.append(i | (2 * side + (cuts[group] == e)) << SHIFT)
            at.append(cuts[group])
            order.append(2 * group + side)
        order = np.argsort(np.concatenate(order), kind="stable")
        return np.concatenate(out)[order].astype(np.uint32), np.concatenate(at)[order]

    def align(self, new: list[str]) -> list[bytes]:
        """Codes of new units, many in one text: before each stands what may stand before it."""
        out, held, size = [], [], 0
        for unit in new:
            if unit[0] == "\0":
                out.extend(self._together(held))
                found, held, size = self.codes(unit[2:]), [], 0
                out.append(b"" if found is None else found[0].tobytes())
                continue
            front = "" if unit[0] == " " else " a\n" if _BARE.match(unit) else " a"
            held.append((front, unit))
            size += len(unit) + len(front)
            if size > AT_ONCE:
                out.extend(self._together(held))
                held, size = [], 0
        return out + self._together(held)

    def _together(self, units: list[tuple[str, str]]) -> list[bytes]:
        if not units:
            return []
        found = self.codes("".join(chain.from_iterable(units))[1:])
        if found is None:
            half = len(units) // 2
            return self._together(units[:half]) + self._together(units[half:]) if half else [b""]
        codes, at = found
        ends = np.cumsum([len(s.encode()) for u in units for s in u])
        if not np.isin(ends[ends > 0], at).all():
            raise ValueError("a cut between units is inside a token")
        cut = np.searchsorted(at, ends, side="right").tolist()
        return [codes[i:j].tobytes() for i, j in zip(cut[::2], cut[1::2])]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all texts and where each text's begin (n + 1 entries); none for a text that a side does not give back."""
        names, number, begin = numbered(texts)
        split = units(names)
        coded = split.flatten().dictionary_encode()
        found = self.units.fetch(coded.dictionary.to_pylist(), self.align)
        # from texts over parts to units
        each = pa.LargeListArray.from_arrays(split.offsets, coded.indices).take(pa.array(number))
        number = each.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        begin = np.concatenate([[0], np.cumsum(pc.list_value_length(each).to_numpy(zero_copy_only=False))]).astype(np.int64)[begin]
        bad = np.fromiter((not f for f in found), bool, len(found))
        lost = np.diff(np.concatenate([[0], np.cumsum(bad[number])])[begin]) > 0
        number[np.repeat(lost, np.diff(begin))] = len(found)
        flat = pa.array([*found, b""], pa.large_binary()).take(pa.array(number))
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(number) + 1, 8 * flat.offset) if len(number) else np.zeros(1, np.int64)
        codes = np.frombuffer(flat.buffers()[2] or b"", np.uint32, int(ends[-1]) // 4)
        return codes, ends[begin] // 4

    def groups(self, codes: np.ndarray, begin: np.ndarray) -> list[bytes]:
        """Groups of each text as `a1,a2|b1;a3|b2,b3`."""
        flat = self.written.take(pa.array(self.place[codes >> SHIFT] + (codes & ID)))
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(codes) + 1, 8 * flat.offset) if len(codes) else np.zeros(1, np.int64)
        data, at = memoryview(flat.buffers()[2] or b""), ends[begin].tolist()
        return [bytes(data[i:max(i, j - 1)]) for i, j in zip(at, at[1:])]


@lru_cache(maxsize=2)
def aligner(spec: str, model: bytes) -> Aligner:
    return Aligner(spec, model)


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align_tokens(docs: DataFrame, spec: str, model: bytes, text: str = "text", keep: Sequence[str] = ("doc_id",), *,
                 groups: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`keep` columns of every row with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if asked, groups.

    `spec` is the content of a tokenizers .json of a byte-level BPE (side A, which encodes a space and the text), `model`
    that of a sentencepiece BPE (side B, which puts that space itself). Bytes at which tokens of both sides end cut the tokens into groups; the two tokens
    that end there are a link. A pair's count is the number of links that hold it, over all rows. n_best: links whose count is the highest of
    their B id, ties included. count_sum: the counts of all links. `groups` is `a1,a2|b1;a3|b2,b3` in ids, three times as
    long as the text; its digest is made where the groups are, so that only a caller who wants the strings moves them.

    Null or empty texts, and texts that a side does not give back byte by byte (a `MARK` in them): zeros, no groups, an empty digest.
    Repeated rows and ids, null ids: each row comes back and counts. Empty table: no rows. Long texts are aligned whole.
    `keep` columns with a result's name are refused; other columns are not looked at.
    """
    keep = list(keep)
    results = [*COUNTS, "groups_sha256", *["groups"] * groups]
    if {c.lower() for c in keep} & set(results):
        raise ValueError("a kept column has the name of a result")
    aligner(spec, model)
    own_names = [*map(str, range(len(keep))), "n_a", "n_b", "n_groups", "digest", *["groups"] * groups, "pairs", "freqs"]

    def store(block: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tool = aligner(spec, model)
        texts = [t or "" for t in rows.column(TEXT).to_pylist()]
        codes, begin = tool.texts(texts)
        kind = codes >> SHIFT
        last = np.concatenate([[0], np.cumsum(kind == B_LAST)])[begin]
        n_a = np.diff(np.concatenate([[0], np.cumsum(kind < B_INNER)])[begin])
        links = (codes[kind == A_LAST] & ID).astype(np.int64) << 32 | (codes[kind == B_LAST] & ID)
        pairs, number = np.unique(links, return_inverse=True)
        doc = np.repeat(np.arange(len(texts)), np.diff(last))
        keys, freqs = np.unique(doc << 32 | number, return_counts=True)
        cuts = pa.array(np.searchsorted(keys >> 32, np.arange(len(texts) + 1)), pa.int32())
        written = tool.groups(codes, begin)
        columns = [*(rows.column(str(i)) for i in range(len(keep))), pa.array(n_a), pa.array(np.diff(begin) - n_a), pa.array(np.diff(last)),
                   pa.array([hashlib.sha256(w).hexdigest() if w else "" for w in written]), *[pa.array(written, pa.binary())] * groups,
                   pa.ListArray.from_arrays(cuts, pa.array((keys & 0xFFFFFFFF).astype(np.uint32))),
                   pa.ListArray.from_arrays(cuts, pa.array(freqs.astype(np.uint32)))]
        own = pa.RecordBatch.from_arrays(columns, names=own_names)
        total = np.bincount(number.ravel(), minlength=len(pairs))
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([to_ipc(own)], pa.binary()), pa.array([pairs.tolist()], pa.list_(pa.int64())),
                                          pa.array([total.tolist()], pa.list_(pa.int64()))], names=["block", "payload", "pairs", "counts"])

    stored = write_blocks(docs.select(*(F.col(c).alias(str(i)) for i, c in enumerate(keep)), F.col(text).alias(TEXT)), TEXT, store,
                          "block long, payload binary, pairs array<long>, counts array<long>", "token-alignment", block_bytes)
    each = stored.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "own")).select("block", "place", "own.pairs", "own.counts")
    totals = (each.groupBy("pairs").agg(F.sum("counts").alias("total"))
              # all pairs of a B id are at most as many as the A ids
              .withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy(F.col("pairs").bitwiseAND(F.lit(0xFFFFFFFF))))))
    answers = (each.select("block", "place", "pairs").join(totals, "pairs")
               .groupBy("block").agg(F.collect_list(F.struct("place", "total", "best")).alias("found"))
               .select("block", "found.place", "found.total", "found.best"))

    schema = T.StructType([docs.schema[c] for c in keep])
    for name in results:
        schema = schema.add(name, "string" if name.startswith("groups") else "long")
    arrow = to_arrow_schema(schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload, place, total, best in zip(*(batch.column(c) for c in ("payload", "place", "total", "best"))):
                own = from_ipc(payload.as_py()).combine_chunks()
                count, top = np.zeros((2, 0), np.int64)
                if place.is_valid:
                    order = place.values.to_numpy()
                    count, top = np.zeros((2, len(order)), np.int64)
                    count[order] = total.values.to_numpy()
                    top[order] = best.values.to_numpy(zero_copy_only=False)
                pairs = own.column("pairs").combine_chunks()
                cuts, number = pairs.offsets.to_numpy(), pairs.flatten().to_numpy()
                freqs = own.column("freqs").combine_chunks().flatten().to_numpy().astype(np.int64)
                sums = [np.diff(np.concatenate([[0], np.cumsum(v[number] * freqs)])[cuts]) for v in (top, count)]
                columns = [own.column(str(i)) for i in range(len(keep))] + [own.column(c) for c in ("n_a", "n_b", "n_groups", "n_groups")] + [
                    *map(pa.array, sums), own.column("digest"), *[own.column("groups").cast(pa.string()) for _ in range(groups)]]
                columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return stored.select("block", "payload").join(answers, "block", "left").mapInArrow(finish, schema)


def op12_query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table under the 50k byte-level vocabulary and the 32k pieces."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        spec, model = f.read(), g.read()
    return align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), spec, model)
