"""Mix sources to target weights, block by block, with column functions only.

The words of a source, its documents in the order of a digest, are cut into blocks
of a fixed number of words (only the last block of a source is shorter). A source
whose target is t times its size has its blocks used floor(t) times, and some once
more. Every use is a slot. A slot draws its output shard independently and
uniformly, so the counts of a source over the shards are multinomial; the number of
slots of a source is held at its target, so that the mix does not drift from the
weights by chance. Slots of one pass over a source are mapped to blocks by a
permutation x -> (p x + c) mod n, p a prime that does not divide n, both drawn per
source and pass; slots then meet the blocks by (source, index).

A source with a third of all rows is many digest buckets and many index keys; no
window spans more than the 4,096 buckets of a source or the table of sources.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import saved

WORD = r"[^\x20\x09-\x0D]+"
# Three primes whose product no block count reaches.
PRIMES = (1000003, 1000033, 1000037)
CHUNK = 1 << 16  # slots listed by one row


def word_count(text: Column | str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add `target` to (source, source_size): weights repeat by code point of the source, null last.

    The targets share `share` times all sizes by weight. None is above `most` times its source's size; what that cuts off
    is shared again among the others. Solved in closed form: in ascending order of size / weight, a prefix is capped.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy(F.lit(1))
    order = every.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (ranked.withColumn("level", (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                                / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
              .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    first = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)
    level = first.getField("level")
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return ranked.withColumn("target", target).select("source", "source_size", "target")


def _digits(key: Column, at: int) -> Column:
    return F.conv(F.substring(key, at, 8), 16, 10).cast("long")


def row_key(text: str, ident: str, seed: int) -> Column:
    """Digest of id and text: the order of a source, and alike for rows alike."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(ident).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))


def placed(docs: DataFrame, text: str, ident: str, source: str, seed: int) -> DataFrame:
    """(source, ident, size, key, start): the words of each row, its digest, and where they begin in the stream of its source."""
    key = row_key(text, ident, seed)
    rows = saved(docs.select(F.col(source).alias("source"), F.col(ident).alias("ident"), word_count(F.col(text)).alias("size"), key.alias("key")), "mixture-rows")
    rows = rows.withColumn("bucket", F.substring("key", 1, 3))
    counts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "ident").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .select("source", "ident", "size", "key", (F.col("before") + F.col("inner")).alias("start")))


def passes(goals: DataFrame, block: int, seed: int) -> DataFrame:
    """(source, pass, slots, blocks, p, c): how many slots each pass over a source has, and its permutation."""
    size, target = F.col("source_size"), F.col("target")
    blocks = F.ceil(size / block).cast("long")
    whole = F.floor(target / size).cast("long")
    rest = F.least(blocks, F.round((target - whole * size) / block).cast("long"))
    table = (goals.where("source_size > 0").select("source", blocks.alias("blocks"), whole.alias("whole"), rest.alias("rest"))
             .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("whole"))))
             .withColumn("slots", F.when(F.col("pass") < F.col("whole"), F.col("blocks")).otherwise(F.col("rest"))).where("slots > 0"))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")), F.col("pass").cast("string")))
    turn = _digits(key, 1) % 3
    # the first prime from the drawn one on that does not divide the number of blocks
    ring = F.filter(F.slice(F.array(*[F.lit(PRIMES[i % 3]) for i in range(5)]), (turn + 1).cast("int"), 3), lambda p: F.col("blocks") % p != 0)
    return table.select("source", "pass", "slots", "blocks", F.get(ring, F.lit(0)).cast("long").alias("p"),
                        (_digits(key, 9) % F.col("blocks")).alias("c"))


def slots(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, pass, index, shard): every slot, the block it takes and the shard it was drawn for."""
    ends = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    spread = ends.repartition(F.col("source"), F.col("pass"), F.col("chunk"))  # listed by many tasks, also for one large source
    last = F.least(F.col("slots"), (F.col("chunk") + 1) * CHUNK) - 1
    each = spread.withColumn("x", F.explode(F.sequence(F.col("chunk") * CHUNK, last)))
    return each.select("source", "pass", ((F.col("p") * F.col("x") + F.col("c")) % F.col("blocks")).alias("index"),
                       F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("pass"), F.col("x")), F.lit(shards)).alias("shard"))


def mix(docs: DataFrame, text: str = "text", ident: str = "doc_id", source: str = "source", *, block: int = 64, shards: int = 64,
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Which words of which documents go to which shard, and what that makes of each document.

    Returns (spans, rows). spans: shard, source, pass, index (of the block), ident, key (of the row, see `row_key`), start (of its words in
    their source), first (word of the document), words.
    rows: one per row of `docs`: doc_id (the id), size, source_size, target, taken (words in the mix, repeats counted).
    Each source's taken words differ from its target by about one block at most; a document is taken `most` times at most.

    Null text or no words: size 0, taken 0. A null source is a source, last in order. Repeated rows and ids: each row has
    its own place. Ties in the digest order are rows alike in id and text, and interchangeable. Sources without words have
    target 0. Empty table: no rows. Very long texts are many blocks. Other columns are not looked at.
    """
    rows = saved(placed(docs, text, ident, source, seed), "mixture-placed")
    goals = saved(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mixture-targets")
    index = F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    pieces = (rows.where("size > 0").withColumn("index", index)
              .withColumn("first", F.greatest(F.lit(0), F.col("index") * block - F.col("start")))
              .withColumn("words", F.least(F.col("size"), (F.col("index") + 1) * block - F.col("start")) - F.col("first")))
    drawn = slots(passes(goals, block, seed), shards, seed).select(F.col("source").alias("s"), "pass", F.col("index").alias("i"), "shard")
    # both sides grow with the documents: never broadcast one, whatever the size of what they are made from
    spans = (pieces.join(drawn.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("index") == F.col("i")))
             .select("shard", "source", "pass", "index", "ident", "key", "start", "first", "words"))
    taken = spans.groupBy("source", "start").agg(F.sum("words").alias("taken")).select(F.col("source").alias("s"), F.col("start").alias("t"), "taken")
    # a row with words is the only one that begins where it does in its source
    named = rows.join(taken.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("start") == F.col("t")) & (F.col("size") > 0), "left")
    goals = goals.withColumnRenamed("source", "g")
    result = (named.join(goals, F.col("source").eqNullSafe(F.col("g")))
              .select(F.col("ident").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    return spans, result


def mixed_texts(spans: DataFrame, docs: DataFrame, text: str = "text", ident: str = "doc_id", source: str = "source", *, seed: int = 42) -> DataFrame:
    """The spans with `text`, their words joined by one space. Ordered by (shard, source, pass, index, start, first) they are the shards.

    A span meets its text by source and digest of id and text, so null and repeated ids lose and multiply nothing: of rows alike in
    all three one stands for all, as each has its own spans. `seed` is that of the mix.
    """
    words = (docs.select(F.col(source).alias("s"), row_key(text, ident, seed).alias("k"), F.col(text).alias("__text"))
             .where(word_count(F.col("__text")) > 0).dropDuplicates(["s", "k"])
             .select("s", "k", F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)).alias("all")))
    met = spans.join(words.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("k")))
    return met.withColumn("text", F.array_join(F.slice("all", F.col("first").cast("int") + 1, F.col("words").cast("int")), " ")).drop("all", "s", "k")


def op7_query(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document of the table."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))[1]


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mix(docs)[1]


def mix_sql(documents: str = "documents", block: int = 64, seed: int = 42) -> str:
    """The rows of `mix` in SQL, with the default weights."""
    p1, p2, p3 = PRIMES
    return f"""
WITH m_rows AS (
  SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{seed}|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS key
  FROM {documents}),
m_placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM m_rows),
m_sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM m_rows GROUP BY source),
m_ranked AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM m_sizes),
m_levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM m_ranked),
m_first AS (SELECT level FROM m_levels WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
m_goals AS (
  SELECT source, source_size, CASE WHEN (SELECT level FROM m_first) IS NULL THEN cap ELSE least(cap, (SELECT level FROM m_first) * weight) END AS target
  FROM m_levels),
m_plan AS (
  SELECT source, ceil(source_size / {block}.0)::BIGINT AS blocks, floor(target / source_size)::BIGINT AS whole,
         least(ceil(source_size / {block}.0)::BIGINT, round((target - floor(target / source_size) * source_size) / {block})::BIGINT) AS rest
  FROM m_goals WHERE source_size > 0),
m_passes AS (
  SELECT source, blocks, pass, CASE WHEN pass < whole THEN blocks ELSE rest END AS slots,
         md5('{seed}|' || coalesce('s' || source, '') || '|' || pass::VARCHAR) AS key
  FROM (SELECT *, unnest(range(0, whole + 1)) AS pass FROM m_plan)),
m_drawn AS (
  SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % 3 AS turn, ('0x' || substr(key, 9, 8))::BIGINT % blocks AS c FROM m_passes WHERE slots > 0),
m_slots AS (
  SELECT source, (list_filter([{p1}, {p2}, {p3}, {p1}, {p2}][turn + 1:turn + 3], lambda p: blocks % p <> 0)[1]::BIGINT * x + c) % blocks AS index
  FROM (SELECT *, unnest(range(0, slots)) AS x FROM m_drawn)),
m_uses AS (SELECT source, index, count(*) AS uses FROM m_slots GROUP BY source, index),
m_pieces AS (
  SELECT source, start, size, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) AS index FROM m_placed WHERE size > 0),
m_taken AS (
  SELECT p.source, p.start, sum(uses * (least(size, (p.index + 1) * {block} - start) - greatest(0, p.index * {block} - start)))::BIGINT AS taken
  FROM m_pieces p JOIN m_uses u ON p.source IS NOT DISTINCT FROM u.source AND p.index = u.index GROUP BY p.source, p.start)
SELECT r.doc_id, r.size, g.source_size, g.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM m_placed r JOIN m_goals g ON r.source IS NOT DISTINCT FROM g.source
LEFT JOIN m_taken t ON r.source IS NOT DISTINCT FROM t.source AND r.start = t.start AND r.size > 0"""
