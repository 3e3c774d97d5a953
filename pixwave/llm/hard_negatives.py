"""Hard negatives by a vertical scan over the dimensions of vectors.

Vectors lie in blocks of columns, one per dimension, written once. An anchor reads the columns of a block in the order of its own
descending magnitudes. What the columns not read yet can still add lies between the sums of the smaller and of the larger of
anchor x column minimum and anchor x column maximum; these bounds take rows out of the bitmap of candidates that can no longer be among the
wanted, until the rest is exact.

Two scans: the first finds each anchor's nearest rows of its own label, the second the best rows of other labels inside the windows that
the scores of these positives set. Anchors travel in bundles, which meet every block by the shelf it stands on; only
the best of a block leave its task.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .blocks import from_ipc, saved, to_ipc

BLOCK = 4096  # rows of a block
BUNDLE = 512  # anchors that meet a block together
SHELF = 32  # blocks that a copy of a bundle is sent to, in a large table
FIXED = 4  # columns of a block before its dimensions
STEP = 8  # columns read between two looks at the bounds


def component_limit(dim: int) -> int:
    """Largest magnitude of a component for which all sums of products are exact in double precision."""
    return 1 << (52 - max(0, dim - 1).bit_length()) // 2


class Columns:
    """Rows of a block as columns, sorted by label."""

    def __init__(self, payload: bytes):
        table = from_ipc(payload)
        self.place = table.column("place").to_numpy()
        self.label = table.column("label").to_numpy()
        self.known = np.array(table.column("id").is_valid())
        self.id = table.column("id").fill_null(0).to_numpy()
        self.anchors = np.flatnonzero(table.column("anchor").to_numpy())
        dims = [table.column(i).to_numpy() for i in range(FIXED, table.num_columns)]
        self.x = np.array(dims, np.float64).reshape(len(dims), len(table))

    def span(self, label: int) -> tuple[int, int]:
        """First and past-the-end row of a label."""
        return np.searchsorted(self.label, label), np.searchsorted(self.label, label, side="right")

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Positions of the k best: highest score, then the smaller id, null last."""
        if len(rows) > k:
            least = np.partition(scores, len(rows) - k)[len(rows) - k]
            at = np.flatnonzero(scores >= least)
        else:
            at = np.arange(len(rows))
        return at[np.lexsort((self.id[rows[at]], ~self.known[rows[at]], -scores[at]))[:k]]


def scan(q: np.ndarray, x: np.ndarray, bitmap: np.ndarray, shrink: Callable[[np.ndarray, np.ndarray], np.ndarray], step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Rows (columns of x) that stay in the bitmap, and their exact inner products with q.

    `shrink(least, most)` says which of the rows can still be wanted when their products lie between these bounds.
    """
    rows = np.flatnonzero(bitmap)
    sums = np.zeros(len(rows))
    if not len(rows) or not len(q):
        return rows, sums
    order = np.argsort(-np.abs(q), kind="stable")
    part = x if bitmap.all() else x[:, rows]
    ends = np.stack([q * part.min(axis=1), q * part.max(axis=1)])
    # what the columns from each place of the order on can add
    least, most = (np.append(np.cumsum(v[order][::-1])[::-1], 0) for v in (ends.min(axis=0), ends.max(axis=0)))
    for at in range(0, len(q), step):
        read = order[at:at + step]
        sums = sums + q[read] @ part[read]
        if at + step >= len(q):
            break
        stay = shrink(sums + least[at + step], sums + most[at + step])
        if not stay.all():
            rows, sums, part = rows[stay], sums[stay], part[:, stay]
            if not len(rows):
                break
    return rows, sums


def among_first(k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that can be among the k highest."""
    def shrink(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return most >= np.partition(least, len(least) - k)[len(least) - k] if len(least) > k else np.ones(len(least), bool)
    return shrink


def in_windows(low: np.ndarray, high: np.ndarray, k: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Rows that can be among the k highest of some window."""
    def shrink(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(least), bool)
        for a, b in zip(low, high):
            can = (most >= a) & (least <= b)
            sure = least[(least >= a) & (most <= b)]  # inside the window whatever the rest adds
            if len(sure) > k:
                can &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stay |= can
        return stay
    return shrink


def _blocks(df: DataFrame, dim: int, size: int, name: str) -> DataFrame:
    """Rows (id, label, v) as written blocks of columns; no row moves to another task, so no key is hot."""
    def pack(block: int, rows: pa.Table) -> pa.RecordBatch:
        n = len(rows)
        v = rows.column("v").combine_chunks()
        lengths = np.diff(v.offsets.to_numpy())
        flat = np.zeros((n, dim), np.int64)
        inside = np.arange(dim)[None, :] < lengths[:, None]
        flat[inside] = v.flatten().to_numpy()
        order = np.argsort(rows.column("label").to_numpy(), kind="stable")
        columns = [pa.array(order.astype(np.int32)), rows.column("label").combine_chunks().take(order), rows.column("id").combine_chunks().take(order),
                   rows.column("anchor").combine_chunks().take(order).cast(pa.int8())]
        small = np.int32 if dim and np.abs(flat).max(initial=0) < 1 << 31 else np.int64
        columns += [pa.array(flat[order, d].astype(small)) for d in range(dim)]
        own = pa.RecordBatch.from_arrays(columns, names=["place", "label", "id", "anchor", *(f"d{d}" for d in range(dim))])
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([to_ipc(own)], pa.binary())], names=["block", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield pack(block, table.slice(0, size))
                held, block = table.slice(size).to_batches(), block + 1
        if sum(b.num_rows for b in held):
            yield pack(block, pa.Table.from_batches(held))

    path = shared_dir(df.sparkSession, name)
    df.mapInArrow(run, "block long, payload binary").write.parquet(path)
    return df.sparkSession.read.schema("block long, payload binary").parquet(path)


def _meet(blocks: DataFrame, anchors: DataFrame, shelves: int, lots: int, kernel: Callable, schema: str) -> DataFrame:
    """`kernel(block id, columns, anchor rows)` for every block and every bundle of anchors."""
    def bundle(rows: pa.Table) -> pa.Table:
        return pa.Table.from_arrays([rows.column("lot").slice(0, 1), pa.array([to_ipc(rows.drop_columns(["lot"]).combine_chunks())], pa.binary())], names=["lot", "bundle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload, own in zip(*(batch.column(c) for c in ("block", "payload", "bundle"))):
                yield from kernel(block.as_py(), Columns(payload.as_py()), from_ipc(own.as_py()))

    lot = F.pmod(F.xxhash64("a_block", "a_place"), F.lit(lots)).cast("int")
    bundles = (anchors.withColumn("lot", lot).groupBy("lot").applyInArrow(bundle, "lot int, bundle binary")
               .withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)))).select("shelf", "bundle"))
    standing = blocks.withColumn("shelf", F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int"))
    # Spark's estimate does not know how many rows the bundles become: never broadcast them
    return bundles.join(standing.hint("merge"), "shelf").select("block", "payload", "bundle").mapInArrow(run, schema)


def _best(df: DataFrame, keys: list[str], score: str, ident: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(ident))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor, *, ident: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its positives, the first rows of other labels with `low` to `high` percent of the positive's score.

    `anchor` is a condition on `rows`. Components become floor(scale * x); a score is the inner product of two rows in these
    integers. Higher scores come first, ties by smaller id. Positives: the first `positives` other rows of the anchor's label.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows with a null label or vector, or a component that is null or not finite, take no part. A null id takes part as any
    other, last among ties. Repeated rows and ids: each row is an anchor, positive and negative of its own; an anchor is never its own positive.
    Fewer rows than asked for: all of them. Negative positive scores have an empty window. Shorter vectors count as if zeros followed.
    Components beyond +-component_limit(dimension) (over 8 million for 64 dimensions) count as that limit, which keeps sums exact.
    Empty table: no rows. Other columns are not looked at.
    """
    spark = rows.sparkSession
    components = F.col(vector).cast("array<double>")
    ok = F.col(label).isNotNull() & components.isNotNull() & F.forall(components, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.where(F.coalesce(ok, F.lit(False)))
    dim = taken.agg(F.max(F.size(vector)).alias("dim")).first()["dim"]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if dim is None:
        return spark.createDataFrame([], schema)
    limit = component_limit(dim)
    whole = F.transform(components, lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(x * scale))).cast("long"))
    blocks = _blocks(taken.select(F.col(ident).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("v"),
                                  F.coalesce(anchor, F.lit(False)).alias("anchor")), dim, block, "hard-negatives")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
                c = Columns(payload)
                at = c.anchors
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(c.place[at]), pa.array(c.id[at], mask=~c.known[at]), pa.array(c.label[at]),
                                                  pa.array([v.tobytes() for v in c.x.T[at]], pa.binary())], names=["a_block", "a_place", "a_id", "a_label", "a_v"])

    anchors = saved(blocks.mapInArrow(pick, "a_block long, a_place int, a_id long, a_label long, a_v binary"), "hard-negative-anchors")
    held, cores = max(1, blocks.count()), spark.sparkContext.defaultParallelism
    # a few shelves for every core, as long as there are blocks for them
    shelves, lots = min(held, max(-(-held // SHELF), 4 * cores)), max(1, -(-anchors.count() // BUNDLE))

    def near(number: int, c: Columns, own: pa.Table) -> Iterator[pa.RecordBatch]:
        who, found, scores = [], [], []
        for i, a in enumerate(own.to_pylist()):
            start, end = c.span(a["a_label"])
            bitmap = np.ones(end - start, bool)
            if a["a_block"] == number:
                bitmap &= c.place[start:end] != a["a_place"]
            at, s = scan(np.frombuffer(a["a_v"]), c.x[:, start:end], bitmap, among_first(positives))
            best = c.first(at + start, s, positives)
            who.append(np.full(len(best), i))
            found.append(at[best] + start)
            scores.append(s[best])
        yield answer(c, own, who, found, scores, [])

    def hard(number: int, c: Columns, own: pa.Table) -> Iterator[pa.RecordBatch]:
        who, found, scores, window = [], [], [], []
        for i, a in enumerate(own.to_pylist()):
            start, end = c.span(a["a_label"])
            bitmap = np.ones(len(c.label), bool)
            bitmap[start:end] = False
            p = np.array([w["score"] for w in a["wanted"]], np.int64)
            least, most = -(-low * p // 100), high * p // 100
            at, s = scan(np.frombuffer(a["a_v"]), c.x, bitmap, in_windows(least, most, negatives))
            for j, (x, y) in enumerate(zip(least, most)):
                inside = np.flatnonzero((s >= x) & (s <= y))
                best = inside[c.first(at[inside], s[inside], negatives)]
                who.append(np.full(len(best), i))
                found.append(at[best])
                scores.append(s[best])
                window.append(np.full(len(best), j, np.int32))
        yield answer(c, own, who, found, scores, window)

    def answer(c: Columns, own: pa.Table, who: list, found: list, scores: list, window: list) -> pa.RecordBatch:
        who, found, scores = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (who, found, scores))
        columns = [own.column(n).combine_chunks().take(who) for n in ("a_block", "a_place")] + [pa.array(c.id[found], mask=~c.known[found]), pa.array(scores)]
        names = ["a_block", "a_place", "id", "score"]
        if window:
            columns, names = [*columns, pa.array(np.concatenate(window))], [*names, "place"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    given = "a_block long, a_place int, id long, score long"
    first = _best(_meet(blocks, anchors, shelves, lots, near, given), ["a_block", "a_place"], "score", "id", positives).where("score >= 0")
    wanted = first.groupBy("a_block", "a_place").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("wanted"))
    asked = saved(anchors.join(wanted, ["a_block", "a_place"]), "hard-negative-windows")
    if not positives or not negatives or asked.isEmpty():
        return spark.createDataFrame([], schema)
    second = _best(_meet(blocks, asked, shelves, lots, hard, given + ", place int").withColumnRenamed("id", "negative"), ["a_block", "a_place", "place"], "score", "negative", negatives)
    return (second.join(asked.select("a_block", "a_place", "a_id", "wanted"), ["a_block", "a_place"])
            .withColumn("positive", F.element_at("wanted", F.col("place") + 1))
            .select(F.col("a_id").alias("anchor_id"), F.col("positive.id").alias("positive_id"), "rank", F.col("negative").alias("negative_id"),
                    F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score")))


OP11_SQL = """
WITH kept AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.n AS an, a.vec_id AS anchor_id, c.n AS cn, c.vec_id AS cid, a.label = c.label AS same,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.vec_id % 100 = 0 AND a.n <> c.n
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY an ORDER BY score DESC, cid NULLS LAST) AS place FROM scored WHERE same
), negative AS (
  SELECT p.anchor_id, p.cid AS positive_id, p.score AS positive_score, s.cid AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.an, p.cn ORDER BY s.score DESC, s.cid NULLS LAST) AS rank
  FROM positive p JOIN scored s ON p.an = s.an
  WHERE p.place <= 5 AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE rank <= 10
"""


def op11_query(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every row of the table whose id is divisible by 100."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
