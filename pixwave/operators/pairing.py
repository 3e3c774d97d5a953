"""Pairing, labels from names, unions and splits."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import col
from ..functions.text import parent_directory
from .index import global_index


def zip_by_position(a: DataFrame, b: DataFrame, order_a, order_b, *, bucket_a: Column | None = None,
                    bucket_b: Column | None = None, block: int = 1 << 17) -> DataFrame:
    """Pair row i of `a` with row i of `b`; sides of unequal length are an error.

    Both sides get a dense position, then meet in one equi-join on it. A position
    held by one side only raises when the row is produced.
    """
    overlap = set(a.columns) & set(b.columns)
    if overlap:
        raise ValueError(f"columns on both sides: {sorted(overlap)}")
    left = global_index(a, order_a, "__ia", bucket=bucket_a, block=block)
    right = global_index(b, order_b, "__ib", bucket=bucket_b, block=block)
    pairs = left.join(right, F.col("__ia") == F.col("__ib"), "full_outer")
    unpaired = F.col("__ia").isNull() | F.col("__ib").isNull()
    error = F.raise_error(F.concat(F.lit("no partner at position "),
                                   F.coalesce(F.col("__ia"), F.col("__ib")).cast("string")))
    return (pairs.withColumn("idx", F.when(unpaired, error.cast("long")).otherwise(F.col("__ia")))
            .filter(F.col("idx") >= 0).select("idx", *a.columns, *b.columns))


def label_lookup(df: DataFrame, name_col: str, classes: Sequence[str], label: str = "label") -> DataFrame:
    """Class index of a name; rows whose name is no class are dropped.

    The class list is part of the expression, so no join and no shuffle is needed.
    """
    names = F.array(*[F.lit(c) for c in classes])
    found = df.withColumn(label, (F.array_position(names, F.col(name_col)) - 1).cast("int"))
    return found.filter(F.col(name_col).isin(list(classes)))


def label_from_path(df: DataFrame, path_col: str, classes: Sequence[str], label: str = "label") -> DataFrame:
    """Class index of the parent directory of a path; other directories are dropped."""
    named = df.withColumn("__class", parent_directory(path_col))
    return label_lookup(named, "__class", classes, label).drop("__class")


def union_batches(*dfs: DataFrame, source: str | None = None) -> DataFrame:
    """Rows of all inputs; `source` names a column for the number of the input."""
    tagged = [df.withColumn(source, F.lit(i)) if source else df for i, df in enumerate(dfs)]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def split_validation(df: DataFrame, size: int = 5000, order: str | Sequence[str] = "example_id", *,
                     bucket: Column | None = None, block: int = 1 << 17) -> DataFrame:
    """Add `split`: the first `size` rows are `validation`, the rest `train`.

    A size below 0 or above the number of rows is an error.
    """
    if size < 0:
        raise ValueError(f"validation size must not be negative: {size}")
    placed = global_index(df, order, "__idx", bucket=bucket, block=block, total="__total")
    error = F.raise_error(F.concat(F.lit(f"validation size {size} exceeds the number of rows, "),
                                   F.col("__total").cast("string")))
    split = (F.when(F.col("__total") < size, error.cast("string"))
             .when(F.col("__idx") < size, "validation").otherwise("train"))
    return placed.withColumn("split", split).drop("__idx", "__total")
