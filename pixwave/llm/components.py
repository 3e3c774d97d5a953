"""Connected components of a link table, in rounds of joins; nothing is gathered in one place."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import saved


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Hang the neighbours of each node (the larger ones, or the smaller ones and itself) below its smallest one."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if larger else both.where("b < a")
    least = side.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    hung = side.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"), F.col("a").alias("u"))
    if larger:
        hung = hung.where("a > u").select("a", "b")
    else:
        hung = hung.select("a", "b").union(least.select("a", F.col("least").alias("b")))
    return hung.where("a <> b").distinct()


def _mark(links: DataFrame) -> tuple:
    """Count and sums that tell two link tables apart."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of a link table (a, b): root is the smallest node it is connected with.

    Alternating large and small stars; the number of rounds grows with the logarithm of the nodes. Each round is written
    to the shared scratch folder, so a lost executor costs one round. Links of a node with itself and repeated links are
    allowed; null ends are not links. No links: no rows.
    """
    now = saved(links.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = _mark(now)
    while mark[0]:
        now = saved(_stars(_stars(now, larger=True), larger=False), name)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
