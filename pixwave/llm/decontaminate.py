"""Benchmark passages in documents, found by their templates, also with other numbers, names and units.

A text becomes a sequence of tokens: runs of letters, lower-cased, and of digits.
Numbers, names (capitalised words inside a sentence) and units (after a number)
become typed placeholders, and what stood there becomes the value of a slot.
Windows of consecutive template tokens of the benchmark are hash-joined with those
of the documents. A window counts only if its slots are consistent: each slot
value of the benchmark always meets the same value in it.
Windows of plain tokens, lower-cased as they stand, are joined beside them: a short item
is found where its own values stand.
Items of which every window is mostly slots (sums, conversions, lists of names) have slotted windows
instead, with a stronger demand: units and the arithmetic signs between tokens must be the same, different
slots must meet different values, and the whole item must be there.

Benchmark items with equal templates and equal patterns of repeated slot values form
a class, named by its smallest id: a family of re-parameterised items is one class.
"""

import hashlib
import secrets
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .blocks import saved, texts_of

WINDOW = 13
SHORTEST = 5  # items with fewer tokens have no template window
SLOTTED_TOKENS, SLOTTED_MARKS = 4, 3  # tokens of an item with slotted windows; words, units and arithmetic signs among and between them
FILTER_ROWS = 2_000_000  # window hashes of the benchmark that go to every task as a filter, 8 bytes each
LITERAL, NUMBER, NAME, UNIT = range(4)
TEMPLATE, PLAIN, SLOTTED = range(3)  # sorts of windows, with hashes of their own
# Units of measure and money, lower case.
UNITS = ("kg g mg km m cm mm mi ft in lb lbs oz l ml h hr hrs hour hours min mins minute minutes s sec secs second seconds ms day days "
         "week weeks month months year years mph kph km² m² usd eur gbp dollar dollars euro euros cent cents percent kw kwh w v a hz khz mhz "
         "ghz kb mb gb tb c f k n j pa").split()
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAKS = np.zeros(257, bool)
_BREAKS[[*b".!?:;\n\r\t\"", 256]] = True
# a code for each arithmetic sign; the codes between two tokens are added up
_SIGN = np.zeros(256, np.uint64)
_SIGN[[*b"+-*/=^<>%"]] = W.mix(np.arange(1, 10, dtype=np.uint64) + np.uint64(0x2545F491))
_PLACE = W.mix(np.array([0, 11, 12, 13], np.uint64) + np.uint64(0x51ED270B))


def _lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case, byte by byte."""
    low = _LOWER[data]
    wide = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    low[wide] += 0x20
    return low


@lru_cache(maxsize=4)
def _unit_hashes(key: bytes) -> np.ndarray:
    parts = [_lower(np.frombuffer(u.encode(), np.uint8)) for u in UNITS]
    return np.array([W.span_hashes(p, np.array([0]), np.array([len(p)]), key)[0] for p in parts], np.uint64)


def _glue(starts: np.ndarray, ends: np.ndarray, kind: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge token i with i + 1 where `joined[i]`."""
    head, tail = np.concatenate([[True], ~joined]), np.concatenate([~joined, [True]])
    return starts[head], ends[tail], kind[head]


class Tokens:
    """Tokens of one or more texts: `hash` of the template, kind, hash of the `value`, first byte; `could` marks words that open a
    sentence and would be names elsewhere; `sign` codes the arithmetic signs before a token. `plain` tokens are never merged: hash
    and first byte."""

    FIELDS = ("hash", "kind", "value", "start", "could", "sign", "plain", "plain_start")

    def __init__(self, *columns: np.ndarray):
        for name, column in zip(self.FIELDS, columns):
            setattr(self, name, column)

    @classmethod
    def joined(cls, parts: "list[Tokens]") -> "Tokens":
        return cls(*(np.concatenate([getattr(p, n) for p in parts]) for n in cls.FIELDS))

    def windows(self, size: int, sort: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window of a sort from every token, and of that with its first word as a name (SLOTTED only)."""
        if sort == PLAIN:
            return W.window_hashes(self.plain, size, 1), np.zeros(0, np.uint64)
        if sort == TEMPLATE:
            return W.window_hashes(self.hash, size), np.zeros(0, np.uint64)
        base = np.where(self.kind == UNIT, self.value, self.hash)
        signed = W.mix(base + self.sign * np.uint64(0x9E3779B97F4A7C15))
        sums = W.window_sums(signed, size)
        n = len(sums)
        sums = (sums - signed[:n]) ^ np.uint64(0x6A09E667F3BCC909)  # what stands before the first token is not the window's
        return W.mix(sums + base[:n]), W.mix(sums + _PLACE[NAME])

    def slots(self, at: int, size: int, sort: int, as_name: bool = False) -> np.ndarray:
        """Places of a window's tokens that are slots."""
        if sort == PLAIN:
            return np.zeros(0, np.int64)
        kind = self.kind[at:at + size]
        slot = (kind != LITERAL) if sort == TEMPLATE else (kind == NUMBER) | (kind == NAME)
        slot[0] |= as_name
        return at + np.flatnonzero(slot)


def template(data: np.ndarray, key: bytes = W.FIXED_KEY) -> Tokens:
    """Tokens of a byte array. Texts in it must end with a newline."""
    cls = np.concatenate([[0], _KIND[data], [0]])
    edge = np.flatnonzero(np.diff(cls))
    starts = edge[cls[edge + 1] > 0]
    ends = np.searchsorted(edge, starts, side="right")
    ends = edge[ends] if len(starts) else starts
    if not len(starts):
        empty = np.zeros(0, np.uint64)
        return Tokens(empty, np.zeros(0, np.uint8), empty, starts, np.zeros(0, bool), empty, empty, starts)
    low = _lower(data)
    plain = W.span_hashes(low, starts, ends, key), starts
    kind = np.where(_KIND[data[starts]] == 2, NUMBER, LITERAL).astype(np.uint8)
    gap = np.append(data, 0)[ends[:-1]]
    starts, ends, kind = _glue(starts, ends, kind, (kind[:-1] == NUMBER) & (kind[1:] == NUMBER) & (starts[1:] - ends[:-1] == 1) & ((gap == 46) | (gap == 44)))
    solid = np.maximum.accumulate(np.where(data != 32, np.arange(len(data)), -1))
    at = np.where(starts > 0, solid[np.maximum(starts - 1, 0)], -1)
    opens = _BREAKS[np.where(at >= 0, data[np.maximum(at, 0)].astype(np.int16), 256)]
    first, second, last = data[starts], data[np.minimum(starts + 1, len(data) - 1)], data[ends - 1]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    before = data[np.maximum(ends - 2, starts)]
    small = ((last >= 97) & (last <= 122)) | ((last >= 128) & ~((before == 0xC3) & (last <= 0x9E)))  # words in capitals are no names
    name = (kind == LITERAL) & capital & ~opens & (ends - starts > 1) & small
    opening = starts[(kind == LITERAL) & capital & opens & (ends - starts > 1) & small]
    kind[name] = NAME
    gap = np.append(data, 0)[ends[:-1]]
    starts, ends, kind = _glue(starts, ends, kind, (kind[:-1] == NAME) & (kind[1:] == NAME) & (starts[1:] - ends[:-1] == 1) & (gap == 32))
    value = W.span_hashes(low, starts, ends, key)
    unit = (kind[1:] == LITERAL) & (kind[:-1] == NUMBER) & np.isin(value[1:], _unit_hashes(key))
    kind[1:][unit] = UNIT
    could = (kind == LITERAL) & np.isin(starts, opening)
    signs = np.concatenate([[np.uint64(0)], np.cumsum(_SIGN[data])])
    sign = signs[starts] - signs[np.concatenate([[0], ends[:-1]])]
    return Tokens(np.where(kind == LITERAL, value, _PLACE[kind]), kind, value, starts, could, sign, *plain)


def templates(texts: list[bytes], key: bytes) -> Iterator[tuple[Tokens, np.ndarray, np.ndarray]]:
    """Tokens of a few texts at a time, in order, and where each text's tokens and plain tokens begin."""
    for few in W.batches(texts):
        if max(map(len, few)) <= W.SEGMENT:
            found = template(np.frombuffer(b"\n".join(few) + b"\n", np.uint8), key)
            edges = np.cumsum([0] + [len(t) + 1 for t in few])
            yield found, np.searchsorted(found.start, edges), np.searchsorted(found.plain_start, edges)
            continue
        for t in few:  # a long text in parts that end with a line, which is also the end of a sentence
            parts, at = [], 0
            while at < len(t) or not parts:
                end = t.find(b"\n", at + W.SEGMENT)
                end = len(t) if end < 0 else end + 1
                parts.append(template(np.frombuffer(t[at:end] + b"\n", np.uint8), key))
                at = max(end, 1)
            whole = Tokens.joined(parts)
            yield whole, np.array([0, len(whole.hash)]), np.array([0, len(whole.plain)])


def _pattern(values: np.ndarray) -> np.ndarray:
    """Number of each value in the order of first appearance."""
    _, first, inverse = np.unique(values, return_index=True, return_inverse=True)
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    return rank[inverse.reshape(-1)]


def _item_windows(t: Tokens, window: int) -> tuple[list[dict], list[dict]]:
    """Template windows of an item and, if it has none though it is long enough, its slotted windows."""
    n = len(t.hash)
    size = min(window, n)
    slot = t.kind != LITERAL
    number = np.full(n, -1)
    number[slot] = _pattern(t.value[slot] + t.kind[slot])
    found = []
    if size >= SHORTEST:
        literal = np.concatenate([[0], np.cumsum(~slot)])
        for p in range(n - size + 1):
            if 2 * (literal[p + size] - literal[p]) >= size:
                found.append((t.hash[p:p + size], p, number[p:p + size]))
        if not slot[0] and found and found[0][1] == 0:
            # a first word opens a sentence here; inside a sentence it would be a name
            as_name = t.hash[:size].copy()
            as_name[0] = _PLACE[NAME]
            found.append((as_name, 0, np.concatenate([[n], number[1:size]])))
    row = lambda h, p, slots: {"hash": int(np.uint64(h).view(np.int64)), "size": size, "place": p, "slots": [int(x) for x in slots]}
    strong = [row(W.window_hashes(x, size)[0], p, m[m >= 0]) for x, p, m in found]
    marks = int(((t.kind == LITERAL) | (t.kind == UNIT)).sum() + (t.sign[1:] != 0).sum())
    if strong or n < SLOTTED_TOKENS or marks < SLOTTED_MARKS:
        return strong, []
    keys, named = t.windows(size, SLOTTED)
    weak = [row(k, p, number[t.slots(p, size, SLOTTED)]) for p, k in enumerate(keys)]
    if t.could[0] and marks > SLOTTED_MARKS:
        weak.append(row(named[0], 0, [n, *number[t.slots(0, size, SLOTTED)]]))
    return strong, weak


def _index(benchmark: DataFrame, text: str, item: str, window: int, drawn: bytes) -> DataFrame:
    """(key, item, n_items, copy, sort, n_windows, hash, size, place, slots) for the windows of every class of items.

    Template and slotted windows belong to the class, and their `copy` is empty; plain windows belong to one text of it, by its digest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, copies, strong, weak, plains = [], [], [], [], []
            for tokens, begin, first in templates(texts_of(batch, "t"), drawn):
                for b, e, f, g in zip(begin, begin[1:], first, first[1:]):
                    own = Tokens(*(getattr(tokens, n)[b:e] if not n.startswith("plain") else getattr(tokens, n)[f:g] for n in Tokens.FIELDS))
                    slot = own.kind != LITERAL
                    number = np.full(len(slot), -1)
                    number[slot] = _pattern(own.value[slot] + own.kind[slot])
                    found = _item_windows(own, window)
                    # items that have slotted windows alone are alike if their units and signs are too
                    like = own.hash.tobytes() if not found[1] else own.windows(len(slot), SLOTTED)[0].tobytes()
                    keys.append(hashlib.md5(like + number.tobytes()).hexdigest())
                    strong.append(found[0])
                    weak.append(found[1])
                    size = min(window, g - f)
                    copies.append(hashlib.md5(own.plain.tobytes()).hexdigest())
                    plains.append([{"hash": x, "size": size, "place": p, "slots": []}
                                   for p, x in enumerate(own.windows(size, PLAIN)[0].view(np.int64).tolist() if size else [])])
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(keys, pa.string()), pa.array(copies, pa.string()),
                                              *(pa.array(x, windows) for x in (strong, weak, plains))], names=["i", "key", "copy", "windows", "slotted", "plain"])

    windows = pa.list_(pa.struct([("hash", pa.int64()), ("size", pa.int32()), ("place", pa.int64()), ("slots", pa.list_(pa.int64()))]))
    kind = benchmark.schema[item].dataType.simpleString()
    struct = "array<struct<hash:bigint,size:int,place:bigint,slots:array<bigint>>>"
    items = saved(benchmark.where(F.col(text).isNotNull()).select(F.col(item).alias("i"), F.col(text).alias("t")).mapInArrow(
        run, f"i {kind}, key string, copy string, windows {struct}, slotted {struct}, plain {struct}"), "benchmark-items")
    classes = items.groupBy("key").agg(F.min("i").alias("item"), F.count(F.lit(1)).alias("n_items"), F.min("windows").alias("windows"), F.min("slotted").alias("slotted"))
    sorts = [classes.select("key", "item", "n_items", F.lit("").alias("copy"), F.lit(sort).alias("sort"), F.col(c).alias("w"))
             for sort, c in ((TEMPLATE, "windows"), (SLOTTED, "slotted"))]
    plain = (items.select("key", "copy", F.col("plain").alias("w")).dropDuplicates(["key", "copy"])
             .join(classes.select("key", "item", "n_items"), "key").select("key", "item", "n_items", "copy", F.lit(PLAIN).alias("sort"), "w"))
    return saved(sorts[0].unionByName(sorts[1]).unionByName(plain)
                 .select("key", "item", "n_items", "copy", "sort", F.array_distinct(F.col("w.place")).alias("p"), F.explode("w").alias("w"))
                 .select("key", "item", "n_items", "copy", "sort", F.size("p").alias("n_windows"), "w.*"), "benchmark-windows")


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", ident: str = "doc_id", item_text: str = "text",
                 item: str = "item_id", *, window: int = WINDOW, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """Pairs of a document and a class of benchmark items that share a window of template tokens with consistent slots, or
    a window of plain tokens.

    Returns ident, text_md5, item_id (the smallest of the class), n_items (of the class), windows (of the item that the
    document has, along its best alignment; of windows that disagree about a slot, those with its most frequent value, but
    one at least) and share (of the item's windows of that sort, template, slotted or plain). Items of
    fewer than `window` tokens are one window. Windows of which over half are slots, and those of items of fewer than 5 tokens, are
    no template windows, as tables of numbers would be alike. An item of 4 tokens or more that has no other window is compared by slotted
    windows, if it has three words, units or arithmetic signs at least; all of them must be found. Every item is also found by its plain tokens,
    numbers alone included.

    Null and empty texts match nothing, on either side. Repeated rows count once; rows with one id and different texts
    are told apart by text_md5; a null id is an id. Empty tables: no rows. Long texts are read in parts. Letters beyond
    Latin-1 are compared with their case. Other columns are not looked at.
    """
    drawn = secrets.token_bytes(16)  # the key of the hashes of this run
    index = _index(benchmark, item_text, item, window, drawn)
    sizes, n = index.agg(F.collect_set(F.struct("sort", "size")), F.count(F.lit(1))).first()  # at most `window` sizes of each sort
    sizes, known = sorted((r["sort"], r["size"]) for r in sizes), None
    if n <= filter_rows:
        hashes = index.select("hash").distinct().toArrow().column("hash").to_numpy()
        known = docs.sparkSession.sparkContext.broadcast(np.sort(hashes.view(np.uint64)))

    def asked(keys: np.ndarray) -> np.ndarray:
        """Places of the keys that the benchmark may have."""
        at = np.arange(len(keys))
        if known is None or not len(keys):
            return at
        place = np.searchsorted(known.value, keys)
        return at[known.value[np.minimum(place, len(known.value) - 1)] == keys] if len(known.value) else at[:0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, row = texts_of(batch, "t"), 0
            for tokens, start, first in templates(texts, drawn):
                for sort, size in sizes:
                    begin = first if sort == PLAIN else start
                    for as_name, keys in enumerate(tokens.windows(size, sort)):
                        at = asked(keys)
                        at = at[tokens.could[at]] if as_name else at
                        doc = np.searchsorted(begin, at, side="right") - 1
                        inside = at + size <= begin[1:][doc]
                        at, doc = at[inside], doc[inside]
                        if len(at):
                            slots = [tokens.value[tokens.slots(p, size, sort, bool(as_name))].view(np.int64).tolist() for p in at.tolist()]
                            rows = pa.array(row + doc)
                            yield pa.RecordBatch.from_arrays([
                                batch.column("i").take(rows), batch.column("m").take(rows), pa.array(keys[at].view(np.int64)),
                                pa.array(np.full(len(at), sort, np.int32)), pa.array(np.full(len(at), size, np.int32)), pa.array(at - begin[doc]),
                                pa.array(slots, pa.list_(pa.int64()))], names=["i", "m", "hash", "sort", "size", "at", "met"])
                row += len(start) - 1

    kind = docs.schema[ident].dataType.simpleString()
    rows = docs.where(F.col(text).isNotNull()).select(F.col(ident).alias("i"), F.md5(text).alias("m"), F.col(text).alias("t"))
    hits = rows.mapInArrow(run, f"i {kind}, m string, hash bigint, sort int, size int, at bigint, met array<bigint>").distinct()
    pairs = (hits.join(index, ["hash", "sort", "size"])
             .withColumn("pairs", F.array_distinct(F.arrays_zip("slots", "met")))
             .where(F.size("slots") == F.size("met"))
             .where((F.col("sort") != SLOTTED) | (F.size("pairs") == F.size(F.array_distinct("met")))))
    # a window counts if each of its slots meets one value; along an alignment those count that agree with the value a slot meets most often
    found = ["i", "m", "key", "item", "n_items"]
    line = [*found, "copy", "sort", "n_windows", "shift"]
    slots = (pairs.where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["slots"]))))
             .select(*found, "copy", "sort", "n_windows", (F.col("at") - F.col("place")).alias("shift"), "place", F.explode_outer("pairs").alias("p")))
    met = (slots.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*line, "p")))
           .withColumn("most", F.max(F.struct("n", "p.met")).over(Window.partitionBy(*line, "p.slots"))["met"]))
    aligned = (met.groupBy(*line, "place").agg(F.min(F.coalesce(F.col("p.met") == F.col("most"), F.lit(True))).alias("agrees"))
               .groupBy(*line).agg(F.greatest(F.count_if("agrees"), F.lit(1)).alias("windows"))
               .where((F.col("sort") != SLOTTED) | (F.col("windows") == F.col("n_windows"))))
    best = F.max(F.struct((F.col("windows") / F.col("n_windows")).alias("share"), F.col("windows").cast("long").alias("windows")))
    return (aligned.groupBy(*found).agg(best.alias("best"))
            .select(F.col("i").alias(ident), F.col("m").alias("text_md5"), F.col("item").alias("item_id"), F.col("n_items"),
                    "best.windows", "best.share"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", ident: str = "doc_id", **options) -> DataFrame:
    """Rows of `docs` that share no window with the benchmark; all columns unchanged."""
    def key(c):
        return F.coalesce(F.concat(F.lit("i"), F.col(c).cast("string")), F.lit("null"))

    bad = contaminated(docs, benchmark, text, ident, **options).select(key(ident).alias("__i"), F.col("text_md5").alias("__m")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    marked = docs.select(key(ident).alias("__i"), F.coalesce(F.md5(text), F.lit("")).alias("__m"), row)
    return marked.join(bad, ["__i", "__m"], "left_anti").select("__row.*")


def op6_query(spark, sf_dir: str) -> DataFrame:
    """Every document of the table that has a passage of the benchmark, with the item."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, benchmark).select("doc_id", "item_id", "windows", "share")


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
