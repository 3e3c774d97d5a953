"""Dense positions in a total order without a window over the whole table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import col

# Bits of a bucket number that one level of the offset table folds: a window there has at most 2^16 rows.
FOLD_BITS = 16


def _fields(name: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(f"{name}.`{c}`").alias(c) for c in columns]


def _offsets(counts: DataFrame, by: list[str], fold: int) -> DataFrame:
    """(__cell, __before, __total) for (__cell, __rows): rows of earlier buckets of the group, and of the whole group.

    `fold` levels put 2^16 buckets each under one wider bucket, so that sparse keys, with a bucket per row, are no
    window over all of them.
    """
    group = F.struct(*_fields("__cell", by), F.lit(0).alias("__none")).alias("__group")
    cells = counts.select("__cell", "__rows", group)
    if fold == 0:
        w = Window.partitionBy("__group")
        before = w.orderBy("__cell.__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return cells.select("__cell", (F.sum("__rows").over(before) - F.col("__rows")).alias("__before"),
                            F.sum("__rows").over(w).alias("__total"))
    wide = F.struct(*_fields("__cell", by), F.shiftright("__cell.__bucket", FOLD_BITS).alias("__bucket"))
    cells = counts.select("__cell", "__rows", wide.alias("__wide"))
    w = Window.partitionBy("__wide").orderBy("__cell.__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = cells.select("__cell", "__wide", (F.sum("__rows").over(w) - F.col("__rows")).alias("__inner"))
    above = _offsets(cells.groupBy(F.col("__wide").alias("__cell")).agg(F.sum("__rows").alias("__rows")), by, fold - 1)
    above = above.select(F.col("__cell").alias("__wide"), F.col("__before").alias("__outer"), "__total")
    return inner.join(above, "__wide").select("__cell", (F.col("__outer") + F.col("__inner")).alias("__before"), "__total")


def global_index(df: DataFrame, order: str | Sequence[str], name: str = "idx", *, by: Sequence[str] = (),
                 bucket: Column | None = None, block: int = 1 << 17, total: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in `order`, within each `by` group.

    Rows are cut into buckets that follow the order. Counts per bucket give the
    offset of each bucket; the position inside a bucket is a `row_number` over
    that bucket alone, so neither the whole table nor a hot `by` group has to
    fit one task. Group and bucket are one struct, which compares nulls as equal:
    a null group is a group, and a null key comes first, as in a window. The
    offset table is spread over the same hash as the window, so joining it moves
    the rows only once.

    `bucket` must be monotone in `order`. The default cuts the first order
    column, an integer unique within its group, into blocks of `block` values:
    a bucket then cannot hold more than `block` rows of a group; sparse keys give
    many buckets, whose offsets are summed in levels. `total` names an extra
    column for the number of rows of the group.
    """
    order = [order] if isinstance(order, str) else list(order)
    by = list(by)
    fold = 2 if bucket is None else 0
    if bucket is None:
        bucket = F.floor(F.col(order[0]) / F.lit(block)).cast("long")
    cell = F.struct(*[F.col(f"`{c}`").alias(c) for c in by], bucket.alias("__bucket"))
    data = df.withColumn("__cell", cell)
    counts = data.groupBy("__cell").agg(F.count(F.lit(1)).alias("__rows"))
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy(*order))
    placed = data.join(_offsets(counts, by, fold), "__cell").withColumn(name, F.col("__before") + rank - 1)
    if total:
        placed = placed.withColumn(total, F.col("__total"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns if c != name], name, *([total] if total else []))


def hash_bucket(uniform: Column, buckets: int) -> Column:
    """Bucket of a uniform draw; monotone in the draw and in the digest it comes from."""
    return F.floor(col(uniform) * buckets)


def default_buckets(df: DataFrame) -> int:
    """Buckets for an evenly spread key: a few per shuffle partition of the session."""
    return 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
