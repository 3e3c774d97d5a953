"""Ordered metrics over step series, without a window over a whole series.

A series is cut into cells of consecutive steps. What a cell needs from the
cells before it is computed on a table with one row per cell and joined back,
so a series that holds a third of all rows is still spread over many tasks.
Series are keyed by a struct of their key columns, which compares nulls as equal:
a null key is a series.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the format of a progress line.
LINE = "%s: step %d, loss = %.2f (%.1f examples/sec; %.3f sec/batch)"
CELL = 1024
FAN = 4096


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row: the composition of the maps y -> a*y + b of a group, in cell order."""
    pdf = pdf.sort_values("__cell")
    a, b = 1.0, 0.0
    for x, y in zip(pdf["__a"], pdf["__b"]):
        a, b = a * x, x * b + y
    return pdf.head(1).assign(__a=a, __b=b)


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """The value that enters each cell of a group; `__in` holds the value that enters the group."""
    pdf = pdf.sort_values("__cell")
    value, entering = float(pdf["__in"].iloc[0]), np.empty(len(pdf))
    for i, (a, b) in enumerate(zip(pdf["__a"], pdf["__b"])):
        entering[i] = value
        value = a * value + b
    return pdf.assign(__in=entering)


def _entering(cells: DataFrame) -> DataFrame:
    """(__key, __cell, __a, __b) -> (__key, __cell, __in), by groups of FAN cells and then over the groups."""
    groups = cells.withColumn("__group", F.floor(F.col("__cell") / FAN)).repartition("__key", "__group")
    ends = groups.groupBy("__key", "__group").applyInPandas(_compose, groups.schema)
    tops = ends.withColumn("__in", F.lit(0.0))
    tops = tops.groupBy("__key").applyInPandas(_walk, tops.schema).select("__key", "__group", "__in")
    joined = groups.join(tops, ["__key", "__group"], "left")
    return joined.groupBy("__key", "__group").applyInPandas(_walk, joined.schema).select("__key", "__cell", "__in")


def _key(keys: list[str]) -> Column:
    return F.struct(*[F.col(f"`{k}`").alias(k) for k in keys])


def affine_scan(df: DataFrame, keys: list[str], step: str, a: Column, b: Column, name: str,
                cell: int = CELL) -> DataFrame:
    """Add y_t = a_t * y_(t-1) + b_t along `step` of each series, y before the first row being 0.

    Inside a cell the recurrence is a pair of window sums, y_t = P_t * (y_in +
    sum(b_k / P_k)) with P_t the running product of a; `a` must be positive and
    its product over one cell must stay a normal double.

    The rows are shuffled once, by (keys, cell): the table of cells and the
    final join read the same exchange (left joins, so that no filter of one
    reader makes it a different one).
    """
    laid = df.withColumns({"__key": _key(keys), "__cell": F.floor(F.col(step) / cell)}).repartition("__key", "__cell")
    rows = laid.withColumns({"__a": a, "__b": b})
    w = Window.partitionBy("__key", "__cell").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (rows.withColumn("__p", F.exp(F.sum(F.log("__a")).over(w)))
             .withColumn("__s", F.col("__p") * F.sum(F.col("__b") / F.col("__p")).over(w)))
    cells = local.groupBy("__key", "__cell").agg(F.max_by("__p", step).alias("__a"), F.max_by("__s", step).alias("__b"))
    return (local.join(_entering(cells), ["__key", "__cell"], "left")
            .withColumn(name, F.col("__p") * F.col("__in") + F.col("__s"))
            .select(*df.columns, name))


def _cell_for(decay: float) -> int:
    """Steps per cell so that decay^steps stays far from underflow."""
    return CELL if decay >= 1 else max(1, min(CELL, int(-400 / math.log(decay))))


def ema_losses(df: DataFrame, series: str, step: str, value: str, decay: float = 0.9, start: int = 0) -> DataFrame:
    """Moving average of every loss series: series, step, raw value, `ema`.

    The average starts at 0 and is divided by 1 - decay^t after t updates;
    steps are consecutive from `start`.
    """
    rows = df.select(series, step, F.col(value).cast("double").alias(value))
    scanned = affine_scan(rows, [series], step, F.lit(decay), F.col(value) * (1 - decay), "__y", _cell_for(decay))
    updates = F.col(step) - start + 1
    return scanned.select(series, step, value, (F.col("__y") / (1 - F.pow(F.lit(decay), updates))).alias("ema"))


def warm_up_decay(step: Column, decay: float) -> Column:
    return F.least(F.lit(decay), (step + 1) / (step + 10))


def ema_variables(df: DataFrame, series: str, step: str, value: str, decay: float = 0.9999,
                  start: int = 0) -> DataFrame:
    """Moving average of variables with decay min(decay, (1+t)/(10+t)), started at the first value."""
    rows = df.select(series, step, F.col(value).cast("double").alias(value))
    d = warm_up_decay(F.col(step), decay)
    b = F.when(F.col(step) == start, F.col(value)).otherwise(F.col(value) * (1 - d))
    scanned = affine_scan(rows, [series], step, d, b, "ema", _cell_for(decay))
    return scanned.select(series, step, value, "ema")


def previous_value(df: DataFrame, keys: list[str], step: str, value: str, name: str, cell: int = 1 << 16) -> DataFrame:
    """Add the value of the preceding row of the series; null on the first row. Null steps come first, as in a window."""
    rows = df.withColumn("__cell", F.struct(_key(keys).alias("key"), F.floor(F.col(step) / cell).alias("no")))
    ends = F.struct(F.col(step).isNotNull(), F.col(step))
    last = rows.groupBy("__cell").agg(F.max_by(value, ends).alias("__last"))
    across = Window.partitionBy("__cell.key").orderBy("__cell.no")
    carried = last.select("__cell", F.lag("__last").over(across).alias("__carried"))
    inside = Window.partitionBy("__cell").orderBy(step)
    return (rows.join(carried, "__cell")
            .withColumn(name, F.coalesce(F.lag(value).over(inside), "__carried"))
            .select(*df.columns, name))


def throughput(df: DataFrame, run: str = "run", step: str = "step", ts: str = "ts", batch: int = 128,
               cell: int = 1 << 16) -> DataFrame:
    """Add `sec_per_batch` and `examples_per_sec` from the time since the step before."""
    timed = previous_value(df, [run], step, ts, "__before", cell)
    gap = F.col(ts) - F.col("__before")
    # parts of the interval, so that the session time zone plays no role
    seconds = sum((F.extract(F.lit(part), gap) * size for part, size in
                   (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))), F.lit(0)).cast("double")
    return (timed.withColumn("sec_per_batch", seconds)
            .withColumn("examples_per_sec", F.when(seconds > 0, batch / seconds)).drop("__before"))


def log_lines(df: DataFrame, every: int = 10, ts: str = "ts", step: str = "step", loss: str = "loss") -> DataFrame:
    """Add `line`, the progress line of every `every`-th step, to the rows of `throughput`.

    A step without a measured time, like the first of a run, has a line too; its rate and time are `nan`.
    """
    shown = df.filter(F.col(step) % every == 0)
    rate, time = (F.coalesce(F.col(c), F.lit(float("nan"))) for c in ("examples_per_sec", "sec_per_batch"))
    return shown.withColumn("line", F.format_string(LINE, F.col(ts).cast("string"), F.col(step), F.col(loss), rate, time))
