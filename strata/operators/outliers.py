"""Interquartile-range limit and outlier capping of a duration column.

The limit is ``CEILING(Q3 + k * (Q3 - Q1))`` with exact, linearly interpolated
percentiles (``PERCENTILE_CONT``) over *all* input rows, found by distributed selection
(``order_statistics``): no task ever holds all distinct values, and ``approx_percentile``
would not give the same limit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import ColumnOrName, cap_duration, col
from strata.operators.slices import SLICE, order_slices


def order_statistics(df: DataFrame, value: ColumnOrName, quantiles: Sequence[float],
                     num_partitions: int | None = None) -> DataFrame:
    """One row: ``p0``, ``p1``, ... (double), the exact interpolated quantiles of the values that
    aren't NULL; NULL if there are none.

    Rows are counted by value (combined map-side), the values range-partitioned, and each
    slice's rows summed: one number per slice goes to the driver, as many as the slices, not
    the data.  They tell which slices hold the two neighbours of each quantile; only these
    slices (at most two per quantile, each a slice's share of the distinct values) are then
    numbered, by a window inside the slice."""
    counts = df.groupBy(col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_v").isNotNull())
    sliced = order_slices(counts, ["_v"], num_partitions)
    held = dict(sorted(sliced.groupBy(SLICE).agg(F.sum("_n")).collect()))  # one row per slice
    total = sum(held.values())
    spots = [q * (total - 1) for q in quantiles]
    before, running = {}, 0  # rows in earlier slices, of the slices that hold a neighbour
    ranks = {r for spot in spots for r in (math.floor(spot), math.ceil(spot))} if total else set()
    for number, rows in held.items():
        if any(running <= r < running + rows for r in ranks):
            before[number] = running
        running += rows
    offset = F.lit(0).cast("long")
    for number, rows in before.items():
        offset = F.when(F.col(SLICE) == number, F.lit(rows).cast("long")).otherwise(offset)
    upto = Window.partitionBy(SLICE).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = sliced.where(F.col(SLICE).isin(list(before))).withColumn("_end", F.sum("_n").over(upto) + offset)

    def at(rank: int):
        return F.max(F.when((F.col("_end") > rank) & (F.col("_end") - F.col("_n") <= rank), F.col("_v").cast("double")))

    found = []
    for i, spot in enumerate(spots):
        low, high = (math.floor(spot), math.ceil(spot)) if total else (0, 0)
        one = at(low) if low == high else (high - spot) * at(low) + (spot - low) * at(high)
        found.append(one.alias(f"p{i}"))
    return near.agg(*found)


def iqr_bounds(df: DataFrame, value: ColumnOrName, k: float = 1.5) -> DataFrame:
    """One row: q1, q3, iqr (double) and upper_limit (int)."""
    q1, q3 = F.col("p0"), F.col("p1")
    return order_statistics(df, value, [0.25, 0.75]).select(
        q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
        F.ceil(q3 + F.lit(k) * (q3 - q1)).cast("int").alias("upper_limit"))


def cap_outliers(df: DataFrame, value: str, out: str, limits: DataFrame,
                 limit_col: str = "upper_limit") -> DataFrame:
    """Add ``out`` = value capped at the limit, negatives raised to 1, zero kept.
    ``limits`` is the one-row result of ``iqr_bounds``; it enters as a scalar subquery
    (computed once, its value used by every task), not as a join."""
    limit = limits.select(limit_col).scalar()
    return df.withColumn(out, cap_duration(F.col(value), limit))
