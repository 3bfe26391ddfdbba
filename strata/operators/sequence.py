"""Ordered per-key operations that stay parallel when one key is huge.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if one
patient or user holds a third of all rows, that task holds a third of the data.  These
operators split each key's rows into buckets, run the window per (key, bucket) and stitch
bucket boundaries with a second, much smaller window over one row per (key, bucket):

    rows --window per (key, bucket)----------------------------+
      \\--aggregate to one row per (key, bucket) --window per key--join on (key, bucket)

The second window sees at most one row per bucket of a key, however many rows that key
has.  The buckets are the range slices of (key, order) (``slices.order_slices``): their
borders follow the rank of a row, not its time, so rows piled on one instant are spread
by the columns that break the tie.  Calendar buckets (``adaptive_buckets``: periods, with a
hot key's busy periods cut into equal time slices) can be asked for by ``unit`` or
``target_rows``; they write nothing, but a pile of rows at one instant shares a slice.
A bucket given by the caller must not fall along the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import epoch_micros
from strata.operators.slices import order_slices

_DAY_MICROS = 86_400_000_000


def adaptive_buckets(df: DataFrame, key: str, ts: str, unit: str = "day",
                     target_rows: int = 2_000_000) -> DataFrame:
    """Add ``_bkt``: a time bucket per row that keeps every (key, bucket) near or below
    ``target_rows`` rows.

    Rows start in calendar buckets of ``unit`` ('day', 'week', 'month'); a (key, bucket)
    pair with more than ``target_rows`` rows -- a hot key's busy period -- is cut into
    ``ceil(n / target_rows)`` equal time slices.  The bucket is ``struct(start, slice)``,
    non-decreasing in ``ts`` within a key, as the stitching requires.  The heavy pairs
    come from one aggregate (one row per (key, bucket)) and are at most
    rows / target_rows, so the planner broadcasts them when small and joins otherwise.
    """
    day = F.to_date(F.col(ts))
    start = day if unit == "day" else F.trunc(day, unit)
    span_days = {"day": F.lit(1), "week": F.lit(7)}.get(unit, F.datediff(F.add_months(start, 1), start))
    b = df.withColumn("_bstart", start)
    heavy = (b.groupBy(key, "_bstart").agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > target_rows)
             .select(F.col(key).alias("_hk"), F.col("_bstart").alias("_hs"),
                     F.ceil(F.col("_n") / target_rows).cast("long").alias("_slices")))
    b = b.join(heavy, F.col(key).eqNullSafe(F.col("_hk")) & F.col("_bstart").eqNullSafe(F.col("_hs")), "left")
    into = epoch_micros(F.col(ts)) - epoch_micros(F.col("_bstart").cast("timestamp_ntz"))
    span = span_days.cast("long") * _DAY_MICROS
    slice_no = F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(
        F.least(F.floor(into * F.col("_slices") / span), F.col("_slices") - 1)).cast("long")
    return b.withColumn("_bkt", F.struct(F.col("_bstart").alias("start"), slice_no.alias("slice"))).drop(
        "_bstart", "_hk", "_hs", "_slices")


def _order_list(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _bucketed(df: DataFrame, key: str, order: list[str], bucket: Column | None, unit: str | None,
              target_rows: int | None) -> DataFrame:
    if bucket is not None:
        return df.withColumn("_bkt", bucket)
    if unit or target_rows:
        return adaptive_buckets(df, key, order[0], unit or "day", target_rows or 2_000_000)
    return order_slices(df, [key, *order], name="_bkt")


def _same_bucket(key: str) -> Column:
    """NULL is a key like any other, as it is for a window; so is a NULL time's bucket."""
    return F.col(key).eqNullSafe(F.col("_k")) & F.col("_bkt").eqNullSafe(F.col("_b"))


def next_in_key(df: DataFrame, key: str, order: str | Sequence[str], value: str, out: str,
                bucket: Column | None = None, unit: str | None = None, target_rows: int | None = None) -> DataFrame:
    """Add ``out`` = ``value`` of the next row of the same key in ``order``
    (``lead(value) over (partition by key order by order)``), NULL for the last row.
    ``order`` should tell the rows of a key apart."""
    order = _order_list(order)
    b = _bucketed(df, key, order, bucket, unit, target_rows)
    inner = Window.partitionBy(key, "_bkt").orderBy(*order)
    with_next = b.withColumn("_nxt", F.lead(value).over(inner))
    if value == order[0]:
        # the value is the leading order column: the bucket's first value is its min,
        # a fixed-width hash aggregate combined map-side
        first_value = F.min(value)
    else:
        first_value = F.min(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                                     F.col(value).alias("v")))["v"]
    firsts = b.groupBy(key, "_bkt").agg(first_value.alias("_first"))
    across = Window.partitionBy(key).orderBy("_bkt")
    boundary = firsts.select(F.col(key).alias("_k"), F.col("_bkt").alias("_b"), F.lead("_first").over(across).alias("_nb"))
    last = F.lead(F.lit(1)).over(inner).isNull()  # of its bucket; a NULL value alone doesn't say so
    return (with_next.withColumn("_last", last).join(boundary, _same_bucket(key), "left")
            .withColumn(out, F.when(F.col("_last"), F.col("_nb")).otherwise(F.col("_nxt")))
            .drop("_bkt", "_nxt", "_nb", "_last", "_k", "_b"))


def running_max_before(df: DataFrame, key: str, order: str | Sequence[str], value: str, out: str,
                       bucket: Column | None = None, unit: str | None = None,
                       target_rows: int | None = None) -> DataFrame:
    """Add ``out`` = max(``value``) over the earlier rows of the same key
    (``rows between unbounded preceding and 1 preceding``), NULL for the first row."""
    order = _order_list(order)
    b = _bucketed(df, key, order, bucket, unit, target_rows)
    inner = Window.partitionBy(key, "_bkt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = b.withColumn("_in", F.max(value).over(inner))
    per_bucket = b.groupBy(key, "_bkt").agg(F.max(value).alias("_bmax"))
    across = Window.partitionBy(key).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_bucket.select(F.col(key).alias("_k"), F.col("_bkt").alias("_b"), F.max("_bmax").over(across).alias("_prev"))
    return (within.join(earlier, _same_bucket(key), "left")
            .withColumn(out, F.greatest(F.col("_in"), F.col("_prev")))
            .drop("_bkt", "_in", "_prev", "_k", "_b"))
