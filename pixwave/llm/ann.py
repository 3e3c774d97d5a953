"""Nearest neighbours by learned partitions.

On a bounded sample: a graph of nearest neighbours is cut into balanced parts by
recursive bisection, and a small network learns, from a vector alone, in which parts
its neighbours lie. The network then deals every vector of the table to its most
probable part, and routes each query to as many of the most probable parts as gave
the wanted recall on the sample. Candidates of those parts are compared exactly.

Parts are stored as blocks of a few thousand vectors. A block of queries meets a
block of candidates by (part, block), so a part with most of the vectors is many
keys, and no group grows with the table.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import saved

SAMPLE = 4096  # vectors that the graph and the network are made from
BLOCK = 4096  # candidates that are compared at once
QUERIES = 1024
NEIGHBOURS = 10
HIDDEN = 128


@dataclass(frozen=True)
class Router:
    """Weights of the network and the number of parts a query is routed to."""

    layers: tuple[np.ndarray, ...]
    parts: int
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def usable(vector: Column | str, dim: int | None = None) -> Column:
    """Whether a vector takes part: not null, not zero, all components finite, and of the given dimension."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    return F.coalesce(ok & (F.size(v) == dim) if dim else ok, F.lit(False))


def nearest_in_sample(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest others of each row by inner product, in blocks."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, max(k, 0)), np.int64)
    if k <= 0:
        return out
    for at in range(0, n, 1024):
        s = x[at:at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(s, top, axis=1), axis=1, kind="stable")
        out[at:at + 1024] = np.take_along_axis(top, order, axis=1)
    return out


def _bisect(nodes: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of a node set with few edges between them: the second eigenvector of the graph, then swaps."""
    local = np.full(len(near), -1)
    local[nodes] = np.arange(len(nodes))
    a = np.repeat(np.arange(len(nodes)), near.shape[1])
    b = local[near[nodes]].ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(nodes)) + 1.0

    def spread(x):
        return (np.bincount(a, weights=x[b], minlength=len(nodes)) + x) / degree

    x = rng.standard_normal(len(nodes))
    for _ in range(60):
        x = spread(x)
        x -= (x * degree).sum() / degree.sum()
        x /= max(np.linalg.norm(x), 1e-300)
    side = np.zeros(len(nodes))
    side[np.argsort(x, kind="stable")[len(nodes) // 2:]] = 1
    for _ in range(10):  # swap equally many nodes that would rather be on the other side
        other = np.bincount(a, weights=(side[a] != side[b]).astype(float), minlength=len(nodes))
        gain = 2 * other - np.bincount(a, minlength=len(nodes))
        one, two = (np.flatnonzero((side == s) & (gain > 0)) for s in (0, 1))
        m = min(len(one), len(two)) // 2
        if not m:
            break
        side[one[np.argsort(-gain[one], kind="stable")[:m]]] = 1
        side[two[np.argsort(-gain[two], kind="stable")[:m]]] = 0
    return nodes[side == 0], nodes[side == 1]


def balanced_parts(near: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part (0 .. parts - 1, a power of two) of every node; sizes differ by one per level at most."""
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(near))]
    while len(groups) < parts:
        groups = [h for g in groups for h in (_bisect(g, near, rng) if len(g) > 1 else (g, g[:0]))]
    out = np.zeros(len(near), np.int64)
    for i, g in enumerate(groups):
        out[g] = i
    return out


def fit_router(x: np.ndarray, parts: int, k: int, recall: float, seed: int = 0, epochs: int = 40) -> Router:
    """Cut the sample's graph, train the network on the parts of each vector's neighbours, and choose the probes."""
    rng = np.random.default_rng(seed)
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    near = nearest_in_sample(unit, NEIGHBOURS)
    part = balanced_parts(near, parts, seed)
    goal = np.zeros((len(x), parts))
    goal[np.arange(len(x)), part] = 1
    for j in range(near.shape[1]):
        goal[np.arange(len(x)), part[near[:, j]]] += 1
    goal /= goal.sum(axis=1, keepdims=True)
    dim = x.shape[1]
    layers = [rng.standard_normal((dim, HIDDEN)) * np.sqrt(2 / dim), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            i = order[at:at + 256]
            h = np.maximum(unit[i] @ layers[0] + layers[1], 0)
            z = h @ layers[2] + layers[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - goal[i]) / len(i)
            dh = (d @ layers[2].T) * (h > 0)
            step += 1
            for n, g in enumerate((unit[i].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                layers[n] = layers[n] - 2e-3 * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
    router = Router(tuple(layers), parts, parts)
    s = router.scores(x)
    dealt = s.argmax(axis=1)
    place = np.argsort(np.argsort(-s, axis=1, kind="stable"), axis=1, kind="stable")  # rank of each part for each vector
    true = nearest_in_sample(x, k)
    if not true.size:
        return router
    needed = np.sort(place[np.arange(len(x))[:, None], dealt[true]].ravel())
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1
    return Router(tuple(layers), parts, probes)


def _rows(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids.to_numpy(zero_copy_only=False), flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b, summed from the first component to the last in double precision."""
    out = np.zeros(len(a))
    for d in range(a.shape[1]):
        out += a[:, d] * b[:, d]
    return out


def best(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of the k best candidates of each query, ties to the smaller id, its own id left out."""
    rough = queries @ vectors.T
    slack = 1e-12 * queries.shape[1] * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0)
    rough[own[:, None] == ids[None, :]] = -np.inf
    m = min(k, len(ids))
    least = np.partition(rough, len(ids) - m, axis=1)[:, len(ids) - m]
    q, c = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    score = exact_scores(queries[q], vectors[c])
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < k
    return q[keep], c[keep], score[keep]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, ident: str = "vec_id", vector: str = "embedding", parts: int | None = None,
            sample: int = SAMPLE, recall: float = 0.95, block: int = BLOCK) -> DataFrame:
    """The k nearest vectors found for each query: query_id, rank (from 1), vec_id, score (the exact inner product).

    `queries` has the same columns as `vectors`; rows of `vectors` with the query's id are not its candidates. Nearest
    first, ties to the smaller id. The index is fitted on `sample` vectors at most (chosen by hash of the id) and holds
    all vectors. `parts` is a power of two; by default one per 512 vectors, 4 to 64, as the sample gives no more of a
    graph. `recall` is what the probes reach on the sample, whose neighbours are farther away than those of the table.

    Null, zero and non-finite vectors, null ids and vectors of another dimension than the most common one take no part.
    Repeated rows are candidates each; a query id that repeats is one query, with its least vector. Fewer than k
    candidates in the probed parts: the query is compared with all parts. Empty table: no rows. Other columns are not
    looked at.
    """
    spark = vectors.sparkSession

    def taken(df: DataFrame) -> DataFrame:
        return df.where(F.col(ident).isNotNull() & usable(vector)).select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    every = saved(taken(vectors), "ann-vectors")
    common = every.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    dim, n = common
    every = every.where(F.size("v") == dim)
    asked = taken(queries).where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v"))
    parts = parts or min(64, max(4, 1 << int(np.ceil(np.log2(max(1, n / 512))))))
    few = every.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow().combine_chunks()
    x = _rows(few.column("id").combine_chunks(), few.column("v").combine_chunks())[1]
    router = fit_router(x, parts, k, recall)

    def deal(probes: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                s = router.scores(_rows(batch.column("id"), batch.column("v"))[1])
                top = np.argsort(-s, axis=1, kind="stable")[:, :probes]
                rows = pa.array(np.repeat(np.arange(len(s)), top.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(top.ravel().astype(np.int32)), batch.column("id").take(rows), batch.column("v").take(rows)], names=["part", "id", "v"])
        return run

    dealt = saved(every.mapInArrow(deal(1), "part int, id long, v array<double>"), "ann-parts")
    held = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}  # one row per part
    blocks = {p: -(-c // block) for p, c in held.items()}
    probes = router.probes
    counts = sorted(held.get(p, 0) for p in range(parts))
    while probes < parts and sum(counts[:probes]) < k + 1:  # even the smallest parts must hold k candidates
        probes += 1
    number = F.create_map(*[F.lit(i) for p in sorted(blocks) for i in (p, blocks[p])])

    def pack(keys: list[str]):
        def run(rows: pa.Table) -> pa.Table:
            ids, v = _rows(rows.column("id").combine_chunks(), rows.column("v").combine_chunks())
            order = np.argsort(ids, kind="stable")
            return pa.Table.from_arrays([*(rows.column(c).slice(0, 1) for c in keys), pa.array([ids[order].astype(np.int64).tobytes()], pa.binary()),
                                         pa.array([v[order].tobytes()], pa.binary())], names=[*keys, "ids", "vectors"])
        return run

    spread = F.pmod(F.xxhash64("id", "v"), number[F.col("part")]).cast("int")
    shelves = (dealt.withColumn("block", spread).groupBy("part", "block")
               .applyInArrow(pack(["part", "block"]), "part int, block int, ids binary, vectors binary"))
    routed = asked.mapInArrow(deal(probes), "part int, id long, v array<double>")
    lots = int(max(1, -(-asked.count() // QUERIES)))
    bundles = (routed.withColumn("lot", F.pmod(F.xxhash64("id"), F.lit(lots)).cast("int")).groupBy("part", "lot")
               .applyInArrow(pack(["part", "lot"]), "part int, lot int, ids binary, vectors binary")
               .withColumnsRenamed({"ids": "asked", "vectors": "wanted"})
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(number[F.col("part")], F.lit(0)) - 1)))
               .where("block >= 0"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, ids = np.frombuffer(row["asked"], np.int64), np.frombuffer(row["ids"], np.int64)
                wanted, held = (np.frombuffer(row[c]).reshape(-1, dim) for c in ("wanted", "vectors"))
                for at in range(0, len(own), QUERIES):
                    q, c, score = best(wanted[at:at + QUERIES], own[at:at + QUERIES], held, ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array(own[at:at + QUERIES][q]), pa.array(ids[c]), pa.array(score)], names=["query_id", "vec_id", "score"])

    # bundles are as many as their blocks, which Spark's estimate does not know: never broadcast them
    met = bundles.select("part", "block", "asked", "wanted").join(shelves.hint("merge"), ["part", "block"])
    found = met.select("asked", "wanted", "ids", "vectors").mapInArrow(compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_query(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20, among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
