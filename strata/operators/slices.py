"""Ordered work inside a key without gathering the key.

``order_slices`` range-partitions rows by (key, order), so that a key of any size lies in as
many slices as it needs, and rows of one key and one instant are told apart by the columns
that follow in the order.  The result is written once with ``checkpoint()``: the slice of a
row is a stored column, so whatever is counted, summed and joined by slice afterwards speaks
of the same rows, also when a lost executor's tasks run again.

``running_in_key`` gives exact running sums (row numbers are running sums of one) on top of
it: a window per (slice, key), plus what the key's earlier slices hold.  Only a slice's first
and last key can go on into a neighbour, so this is summed for these alone: a few rows for each
slice, however many keys there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

SLICE = "_slice"
SLICE_ROWS = 500_000


def slice_count(df: DataFrame, num_partitions: int | None = None) -> int:
    return num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices_for(df: DataFrame, num_partitions: int | None = None) -> int:
    """As many slices as keep each near ``SLICE_ROWS`` rows: a task's memory then doesn't grow with the table."""
    return num_partitions or max(slice_count(df), -(-df.count() // SLICE_ROWS))


def order_slices(df: DataFrame, order: Sequence[str], num_partitions: int | None = None,
                 name: str = SLICE) -> DataFrame:
    """``df`` with the number of its slice, which never falls along ``order`` (NULL first)."""
    ensure_checkpoint_dir(df.sparkSession)
    columns = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(slice_count(df, num_partitions), *columns)
    return ranged.withColumn(name, F.spark_partition_id()).checkpoint()


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """NULL is a key like any other, as it is for a window."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def running_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, str],
                   whole: Mapping[str, str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add for each ``sums`` entry (new column -> column) the sum over the rows of the same key
    from its first row in ``order`` up to this one, and for each ``whole`` entry the sum over
    all rows of the key; NULL counts as 0.  ``order`` should tell the rows of a key apart:
    equal rows are taken in any order, and share a slice."""
    whole = whole or {}
    number = slice_count(df, num_partitions)
    sliced = order_slices(df, [*keys, *order], number)
    here = Window.partitionBy(SLICE, *keys)
    upto = here.orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    zero = F.lit(0)

    def value(column: str) -> Column:
        return F.coalesce(F.col(column), zero)

    # dealt by number: the planner would merge small partitions into few, and theirs is the memory
    dealt = sliced.repartition(number, SLICE, *keys)
    inside = dealt.select("*", *[F.sum(value(c)).over(upto).alias(f"_in_{out}") for out, c in sums.items()],
                          *[F.sum(value(c)).over(here).alias(f"_in_{out}") for out, c in whole.items()])
    key = F.struct(*[F.col(k).alias(f"_of_{k}") for k in keys])
    ends = sliced.groupBy(SLICE).agg(F.array(F.min(key), F.max(key)).alias("_ends"))  # one row per slice
    ends = ends.select(F.explode("_ends").alias("_end")).select("_end.*")
    at_ends = sliced.join(F.broadcast(ends), same_keys(keys, "_of_"), "left_semi")
    totals = at_ends.groupBy(SLICE, *keys).agg(*[F.sum(value(c)).alias(f"_all_{out}")
                                                 for out, c in {**sums, **whole}.items()])
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    beyond = totals.select(F.col(SLICE).alias("_at"), *[F.col(k).alias(f"_of_{k}") for k in keys],
                           F.count(F.lit(1)).over(of_key).alias("_slices"),
                           *[F.sum(f"_all_{out}").over(earlier).alias(f"_out_{out}") for out in sums],
                           *[F.sum(f"_all_{out}").over(of_key).alias(f"_out_{out}") for out in whole])
    beyond = beyond.where("_slices > 1").drop("_slices")  # at most two rows for each border of two slices
    rows = inside.join(F.broadcast(beyond), (F.col(SLICE) == F.col("_at")) & same_keys(keys, "_of_"), "left")
    return rows.select(*[F.col(c) for c in df.columns],
                       *[(F.col(f"_in_{out}") + F.coalesce(F.col(f"_out_{out}"), zero)).alias(out) for out in sums],
                       *[F.coalesce(F.col(f"_out_{out}"), F.col(f"_in_{out}")).alias(out) for out in whole])
