"""Near copies by SimHash fingerprints; covering masks find every pair within the bit distance.

Covering masks: each of the 64 bit positions gets a non-zero vector of r + 1 bits,
r being the largest distance. Table v (any non-zero vector) keeps the positions
whose vector has an odd product with v. The up to r positions in which two
fingerprints differ span at most r dimensions, so some v is orthogonal to all of
them, and in table v both have the same key: 2^(r+1) - 1 tables miss no pair.

Only distinct fingerprints enter the tables. A key with more than `CROWD` of them
is not compared in one go: its members, which agree on the kept positions, are
dealt again by covering masks over the other positions. Each such level keeps
about half of the positions that are left, so a key of the third and last level
has at most 2^15 members. Equal keys yield links to one member per connected
lump, never all pairs.
"""

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import saved, texts_of
from .components import components

BITS = 64
CROWD = 2048
LEVELS = 3
_PART = 1 << 18  # shingles hashed before their bits are counted


def _bit_counts(hashes: list[int]) -> np.ndarray:
    raw = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint_of(text: bytes, shingle: int, seed: int = 42) -> int:
    """SimHash of a text: a bit is 1 if over half of the shingle hashes have it; no words give 0."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _PART):
        counts += _bit_counts([digest(joined[s:e], seed) for s, e in zip(starts[at:at + _PART], ends[at:at + _PART])])
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column | str, shingle: int = 4, seed: int = 42) -> Column:
    """The SimHash fingerprint of a text column, as a long with the same bits; null and empty give 0."""
    @F.arrow_udf("long")
    def run(column: pa.Array) -> pa.Array:
        texts = texts_of(pa.RecordBatch.from_arrays([column], names=["t"]), "t")
        return pa.array(np.array([fingerprint_of(t, shingle, seed) for t in texts], np.uint64).view(np.int64))

    return run(text)


@lru_cache(maxsize=4096)
def kept_bits(path: tuple[int, ...], radius: int) -> int:
    """Positions that the tables on `path` (one vector per level) keep between them, as a bit mask."""
    kept = 0
    for v in path:
        left = [i for i in range(BITS) if not kept >> i & 1]
        for j, i in enumerate(left):
            if bin((j % ((1 << radius + 1) - 1) + 1) & v).count("1") % 2:
                kept |= 1 << i
    return kept


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(fps: DataFrame, paths: Sequence[tuple[int, ...]], radius: int) -> DataFrame:
    """(table, key, fp) for every fingerprint of `fps` (table, fp); its table gets all its children."""
    tables = 1 << radius + 1
    masks = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(signed(kept_bits(p, radius))).alias("mask")) for i, p in enumerate(paths)])
    if len(paths[0]) == 1:
        return fps.select("fp", F.explode(masks).alias("m")).select("m.table", F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp")
    per = tables - 1
    own = F.slice(masks, F.col("parent") * per + 1, F.lit(per))
    return (fps.select("fp", F.explode(own).alias("m"))
            .select("m.table", F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp").distinct())


def lump(fps: np.ndarray, groups: np.ndarray, radius: int) -> np.ndarray:
    """For each sorted group of fingerprints, the index of the least member each one is connected with inside the group."""
    n = len(fps)
    label = np.arange(n)
    if n < 2:
        return label
    size = np.diff(np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]])))
    left, right = [], []
    for k in range(1, int(size.max())):
        i = np.flatnonzero(groups[k:] == groups[:-k])
        close = i[np.bitwise_count(fps[i] ^ fps[i + k]) <= radius]
        left.append(close)
        right.append(close + k)
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(dealt: DataFrame, radius: int, crowd: int | None, name: str) -> DataFrame:
    """Rows (a, b, table): links, or members of crowded keys (b null), from fingerprints dealt by (table, key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(fps: np.ndarray, groups: np.ndarray) -> pa.RecordBatch:
            root = lump(fps, groups, radius)
            at = np.flatnonzero(root != np.arange(len(fps)))
            a, b = fps[at].view(np.int64), fps[root[at]].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32())], names=["a", "b", "table"])

        def pending(fps: np.ndarray, table: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.nulls(len(fps), pa.int64()),
                                               pa.array(np.full(len(fps), table, np.int32))], names=["a", "b", "table"])

        held, last, crowded = np.zeros(0, np.uint64), None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table, key, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fp = fp.view(np.uint64)
            new = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
            starts = [0, *new.tolist()]
            first = (int(table[0]), int(key[0]))
            if last is not None and first != last:
                if not crowded and len(held) > 1:
                    yield links(held, np.zeros(len(held), np.int64))
                held, crowded = np.zeros(0, np.uint64), False
            # whole groups between the first and the last boundary, and the one that may go on
            tail = starts[-1]
            if tail > 0:
                head = starts[1]
                whole = np.concatenate([held, fp[:head]])
                if crowded or (crowd and len(whole) > crowd):
                    yield pending(whole, first[0])
                elif len(whole) > 1:
                    yield links(whole, np.zeros(len(whole), np.int64))
                sizes = np.diff(starts[1:])
                group = np.repeat(np.arange(len(sizes)), sizes)
                big = (np.repeat(sizes, sizes) > crowd) if crowd else np.zeros(len(group), bool)
                some = (np.repeat(sizes, sizes) > 1) & ~big
                if some.any():
                    yield links(fp[head:tail][some], group[some])
                for g in np.unique(group[big]):
                    at = head + np.flatnonzero(group == g)
                    yield pending(fp[at], int(table[at[0]]))
                held, crowded = fp[tail:], False
            else:
                held = np.concatenate([held, fp])
            last = (int(table[-1]), int(key[-1]))
            if crowded or (crowd and len(held) > crowd):
                yield pending(held, last[0])  # passed on as they come, never held
                held, crowded = np.zeros(0, np.uint64), True
        if not crowded and len(held) > 1:
            yield links(held, np.zeros(len(held), np.int64))

    spread = dealt.repartition("table", "key").sortWithinPartitions("table", "key", "fp")
    return saved(spread.mapInArrow(run, "a long, b long, table int"), name)


def near_links(fps: DataFrame, radius: int = 4, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) with a distance of `radius` or less."""
    vectors = range(1, 1 << radius + 1)
    paths = [(v,) for v in vectors]
    todo, found = fps.select("fp"), None
    for level in range(LEVELS):
        last = level == LEVELS - 1
        out = _compare(_deal(todo, paths, radius), radius, None if last else crowd, "simhash-links")
        links = out.where("b is not null").select("a", "b")
        found = links if found is None else found.union(links)
        rest = out.where("b is null")
        used = [r[0] for r in rest.select("table").distinct().collect()]  # numbers of tables, not rows
        if not used:
            break
        number = {t: i for i, t in enumerate(sorted(used))}
        parents = F.create_map(*[F.lit(x) for t in number for x in (t, number[t])])
        todo = rest.select(F.col("a").alias("fp"), parents[F.col("table")].alias("parent"))
        paths = [(*paths[t], v) for t in sorted(used) for v in vectors]
    return found


def simhash_groups(docs: DataFrame, text: str = "text", ident: str = "doc_id", *, shingle: int = 4, distance: int = 4,
                   crowd: int = CROWD) -> DataFrame:
    """(ident, text_md5, fp, root, component_id) for every row: its fingerprint and the group it belongs to.

    Two rows are linked if their fingerprints differ in at most `distance` bits; groups are the connected components.
    component_id is the smallest id of the group (null only if no row of it has an id); root tells groups apart even
    where ids repeat.

    Null and empty texts have fingerprint 0 and are linked like any other. Fewer words than a shingle: the whole sequence
    is the shingle. Repeated rows and ids: each row comes back. Empty table: no rows. Long texts: shingles are hashed in
    parts. Other columns of `docs` are not looked at.
    """
    rows = saved(docs.select(F.col(ident).alias("ident"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_md5"),
                             fingerprint(F.col(text), shingle).alias("fp")), "simhash-rows")
    least = rows.groupBy("fp").agg(F.min("ident").alias("least"))
    roots = components(near_links(least.select("fp"), distance, crowd), "simhash-components")
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "root", "component_id")
    # a text that a third of all rows share is a skewed key on the left; the right has one row per key
    return rows.join(named, "fp").select(F.col("ident").alias(ident), "text_md5", "fp", "root", "component_id")


def survivors(docs: DataFrame, text: str = "text", ident: str = "doc_id", **options) -> DataFrame:
    """One row of each group: the one with the smallest id, ties by the digest of the text, then by the whole row.

    Rows with a null id come last. All columns come back unchanged.
    """
    groups = simhash_groups(docs, text, ident, **options)
    pick = groups.groupBy("root").agg(F.min(F.struct(F.col(ident).isNull().alias("n"), F.col(ident).alias("i"), F.col("text_md5").alias("m"))).alias("k"))
    def key(c):
        return F.coalesce(F.concat(F.lit("i"), F.col(c).cast("string")), F.lit("null")).alias("__i")

    keep = pick.select(key("k.i"), F.col("k.m").alias("__m")).distinct()
    keyed = docs.select(key(ident), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("__m"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    # repeated rows are merged before the shuffle; the join then needs no other one for the texts
    single = keyed.groupBy("__i", "__m").agg(F.min_by("__row", F.xxhash64("__row")).alias("__row"))
    return single.join(keep, ["__i", "__m"], "left_semi").select("__row.*")


def op2_query(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document of the table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return survivors(docs)
