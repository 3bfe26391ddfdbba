"""Table-level loads: type-1 upsert, incremental insert, inferred and placeholder members.

Plain Spark tables have no MERGE, so each load returns the *next version* of the target
as a DataFrame; the caller writes it to a new location (``sources.tables``) and never
overwrites the path it was read from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import ntz_lit
from strata.operators.keys import assign_keys, next_key_start
from strata.operators.refint import keep_new
from strata.session import stored


def _typed_lit(value: Any, data_type) -> Column:
    """Literal of ``data_type``; datetimes go through ISO text (time-zone free)."""
    if isinstance(value, (dt.datetime, dt.date)) and not isinstance(data_type, T.DateType):
        return ntz_lit(value).cast(data_type)
    return F.lit(value).cast(data_type)


# Sentinel marker: compare the column without NULL protection (NULL never counts as a
# change), like the unguarded columns of the source merge.
UNGUARDED = object()


def changed(tracked: Mapping[str, Any], left: str = "t", right: str = "s") -> Column:
    """True when any tracked column differs.  ``tracked`` maps column -> sentinel: the
    sentinel replaces NULL on both sides before comparing (NULL == '' for strings,
    1900-01-01 for dates, 0 for numbers); ``UNGUARDED`` compares raw values."""
    cond = None
    for name, sentinel in tracked.items():
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        if sentinel is UNGUARDED:
            diff = a != b
        else:
            diff = F.coalesce(a, F.lit(sentinel)) != F.coalesce(b, F.lit(sentinel))
        diff = F.coalesce(diff, F.lit(False))
        cond = diff if cond is None else cond | diff
    return cond if cond is not None else F.lit(False)


def scd1_merge(target: DataFrame, source: DataFrame, key: str, tracked: Mapping[str, Any], stamp_col: str,
               batch_ts: Any) -> DataFrame:
    """``target`` and ``source`` in one full outer join, stored: the target's columns with their values after
    the upsert, ``_new`` (only in the source; its surrogate key is still NULL) and ``_takes`` (new or changed)."""
    types = {f.name: f.dataType for f in target.schema.fields}
    from_source = [c for c in target.columns if c in source.columns and c != stamp_col]
    stamp = _typed_lit(batch_ts, types[stamp_col])
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.select(*from_source).alias("s")
    is_new = F.col("t._old").isNull()
    takes = is_new | (F.col(f"s.{key}").isNotNull() & changed(tracked))
    merged = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(
        *[F.when(takes, stamp).otherwise(F.col(f"t.{c}")).alias(c) if c == stamp_col
          else F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in from_source
          else F.col(f"t.{c}").alias(c) for c in target.columns], is_new.alias("_new"), takes.alias("_takes"))
    return stored(merged)  # read several times: the rows that stay, and the new ones to be numbered


def upsert_scd1(target: DataFrame, source: DataFrame, key: str, tracked: Mapping[str, Any],
                surrogate_key: str, stamp_col: str, batch_ts: Any,
                num_partitions: int | None = None) -> DataFrame:
    """Type-1 slowly changing dimension.

    * matched and changed -> source values, target's surrogate key, new stamp;
    * matched and unchanged -> target row untouched (key and stamp kept);
    * only in target -> kept (never deleted);
    * only in source -> inserted with keys continuing after ``max(key)`` in natural-key
      order.

    ``source`` must already be one row per key and carry the target's data columns.
    Running it a second time with the same source changes nothing.  This returns the whole
    next version; ``sources.parts.upsert_buckets`` rewrites only the buckets that change.
    """
    data_cols = [c for c in target.columns if c not in (surrogate_key, stamp_col)]
    key_type = target.schema[surrogate_key].dataType.simpleString()
    merged = scd1_merge(target, source.select(*data_cols), key, tracked, stamp_col, batch_ts).drop("_takes")
    start = merged.agg((F.coalesce(F.max(surrogate_key), F.lit(0)) + 1).alias("_start"))
    keyed = assign_keys(merged.where("_new").drop("_new", surrogate_key), [key], surrogate_key, start=start,
                        num_partitions=num_partitions, key_type=key_type)
    return merged.where("not _new").select(*target.columns).unionByName(keyed.select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, key: str, surrogate_key: str,
             order: Sequence[str] | None = None, num_partitions: int | None = None,
             start: int | None = None) -> DataFrame:
    """The source rows whose key is not in the target, with keys that continue after
    ``max(key)`` (or begin with ``start``): what an append writes.  Its cost follows the batch
    and the target's key column, not the target's rows."""
    data_cols = [c for c in target.columns if c != surrogate_key]
    fresh = keep_new(source.select(*data_cols), target, key)
    keyed = assign_keys(fresh, list(order or [key]), surrogate_key,
                        start=next_key_start(target, surrogate_key) if start is None else start,
                        num_partitions=num_partitions, key_type=target.schema[surrogate_key].dataType.simpleString())
    return keyed.select(*target.columns)


def incremental_insert(target: DataFrame, source: DataFrame, key: str, surrogate_key: str,
                       order: Sequence[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Append the source rows whose key is not in the target; existing rows never change
    (even if the source now says otherwise).  New keys continue after ``max(key)``."""
    return target.unionByName(new_rows(target, source, key, surrogate_key, order, num_partitions))


def infer_missing_members(dim: DataFrame, fact: DataFrame, fact_key: str, dim_key: str,
                          surrogate_key: str, defaults: Mapping[str, Any],
                          num_partitions: int | None = None) -> DataFrame:
    """Late-arriving dimension members: distinct non-NULL ``fact_key`` values missing
    from the dimension become rows filled with ``defaults`` and fresh surrogate keys.
    The fact side is reduced to its distinct keys (map-side) before the anti join."""
    ids = fact.select(F.col(fact_key).alias(dim_key)).filter(F.col(dim_key).isNotNull()).distinct()
    missing = keep_new(ids, dim, dim_key)
    types = {f.name: f.dataType for f in dim.schema.fields}
    filled = missing.select(*[
        F.col(dim_key).cast(types[c]).alias(c) if c == dim_key
        else _typed_lit(defaults.get(c), types[c]).alias(c)
        for c in dim.columns if c != surrogate_key])
    keyed = assign_keys(filled, [dim_key], surrogate_key, start=next_key_start(dim, surrogate_key),
                        num_partitions=num_partitions, key_type=types[surrogate_key].simpleString())
    return dim.unionByName(keyed.select(*dim.columns))


def ensure_placeholder(dim: DataFrame, row: Mapping[str, Any], surrogate_key: str) -> DataFrame:
    """Add ``row`` (which carries its own fixed surrogate key, e.g. 0) unless a row with
    that key already exists; inserted once, kept afterwards."""
    spark = dim.sparkSession
    types = {f.name: f.dataType for f in dim.schema.fields}
    one = spark.range(1).select(*[_typed_lit(row.get(c), types[c]).alias(c) for c in dim.columns])
    return dim.unionByName(keep_new(one, dim, surrogate_key))

