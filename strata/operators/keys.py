"""Surrogate keys (an identity column) without a global window.

``assign_keys`` numbers rows 1..n (or from ``start``) in the order of a natural key:

1. range-partition the rows into ``num_partitions`` slices of the order key and sort
   inside each slice (one shuffle, spread over all tasks), then store that result, with
   each row's slice and place in it as a column, in the shared ``spark.checkpoint.dir``;
2. count rows per slice (a hash aggregate over that one column: one row per slice) and
   turn the counts into running offsets.  The offsets are as many as the slices -- a
   number chosen by the caller, not a property of the data -- so they are brought to
   the driver and applied as an array literal;
3. key = start + offset[slice] + position of the row inside its slice.  No join and
   no window over the data.

The stored copy matters for correctness: the counted slices and the numbered slices
must be the same rows in the same order.  Two separately planned range exchanges would
each sample their own bounds; one written copy cannot disagree with itself, and a task
re-run after a lost executor reads the same slice, so keys never change.  Keys are
contiguous and unique even with ties.

``first_in_slices`` and ``number_places`` are the same in two halves, for rows that are first
reduced to one per natural key: the slices of that key serve the reduction and the numbering,
so the rows are shuffled and sorted once for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import Order, first_per_key
from strata.session import stored

PLACE = "_place_in_order"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def assign_keys(df: DataFrame, order: Sequence[str], key_name: str, start: int | DataFrame = 1,
                num_partitions: int | None = None, key_type: str = "long") -> DataFrame:
    """Add ``key_name`` = start + rank of the row under ``order`` (0-based).

    ``start`` is an int, or a one-row DataFrame whose single column holds the first key
    (for example ``next_key_start(existing)`` = ``max(key) + 1``).
    """
    n = _partitions(df, num_partitions)
    sort_cols = [F.col(c).asc_nulls_first() for c in order]
    ranged = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
              .withColumn(PLACE, F.monotonically_increasing_id()))
    return number_places(ranged, key_name, start, key_type)


def first_in_slices(df: DataFrame, keys: Sequence[str], order: Order = (), where: Column | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """``dedupe.first_per_key`` inside range slices of ``keys``, of its rows those that pass
    ``where``, each with its place for ``number_places``.  Rows of one key share a slice and lie in
    the order of ``keys`` there, so Spark's window needs no other exchange.  Sampling the slices'
    bounds runs the last stage before them once more, but not the window.  Rows of one key
    aren't reduced before the exchange, as ``first_per_key`` does: a key with a large share of
    all rows is sorted by one task (it spills)."""
    sort_cols = [F.col(c).asc_nulls_first() for c in keys]
    ranged = df.repartitionByRange(_partitions(df, num_partitions), *sort_cols)
    first = first_per_key(ranged, keys, order)
    if where is not None:
        first = first.where(where)
    return first.sortWithinPartitions(*sort_cols).withColumn(PLACE, F.monotonically_increasing_id())


def number_places(placed: DataFrame, key_name: str, start: int | DataFrame = 1, key_type: str = "long") -> DataFrame:
    """Store rows that have a place and turn it into the key.  Joins since the place was given must
    have lost no row."""
    ranged = stored(placed)
    pid = F.shiftright(PLACE, 33)
    per_slice = dict(ranged.groupBy(pid.alias("p")).count().collect())  # one row per slice
    offsets, running = [], 0
    for p in range(max(per_slice, default=0) + 1):  # a slice may be empty
        offsets.append(running)
        running += per_slice.get(p, 0)
    first = _resolve_start(start)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), (pid + 1).cast("int"))
    in_slice = F.col(PLACE) - F.shiftleft(pid, 33)
    key = (F.lit(first).cast("long") + offset + in_slice).cast(key_type)
    return ranged.select(*[F.col(c) for c in placed.columns if c != PLACE], key.alias(key_name))


def _resolve_start(start: int | DataFrame) -> int:
    """The first key: an int, or the single value of a one-row DataFrame (a global
    aggregate such as ``max(key) + 1``, so fetching it is bounded)."""
    if isinstance(start, DataFrame):
        value = start.first()[0]
        return 1 if value is None else int(value)
    return int(start)


def next_key_start(existing: DataFrame, key_name: str) -> DataFrame:
    """One-row DataFrame holding ``coalesce(max(key), 0) + 1`` (a global aggregate)."""
    return existing.agg((F.coalesce(F.max(key_name), F.lit(0)) + 1).alias("_start"))
