"""Referential-integrity filters and key lookups.

No join here carries a broadcast hint: the planner broadcasts a side only when its
measured or estimated size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
re-checks with the real shuffle size) and falls back to a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import ColumnOrName, col


def keep_referenced(df: DataFrame, fk: ColumnOrName, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows whose ``fk`` value exists in ``ref[ref_key]`` (``fk IN (SELECT key ...)``):
    a left-semi join; NULL never matches."""
    r = ref.select(F.col(ref_key).alias("_ref_key"))
    return df.join(r, col(fk) == F.col("_ref_key"), "left_semi")


def keep_new(source: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """Source rows whose key is not in the target (``NOT EXISTS``): a left-anti join."""
    t = target.select(F.col(target_key or key).alias("_t_key"))
    return source.join(t, F.col(key) == F.col("_t_key"), "left_anti")


def orphan_keys(df: DataFrame, fk: str, ref: DataFrame, ref_key: str, null_aware: bool = False) -> DataFrame:
    """Distinct ``fk`` values missing from ``ref``.

    ``null_aware=False`` is ``NOT EXISTS`` (NULL fk values are never orphans).
    ``null_aware=True`` is ``NOT IN (subquery)``: one NULL on the right side empties
    the result, an empty right side keeps everything.  It is expressed as an anti join
    plus a scalar count of the right side, so it never degrades to a nested-loop join.
    """
    keys = df.select(fk).distinct()
    if not null_aware:
        return keep_new(keys.filter(F.col(fk).isNotNull()), ref, fk, ref_key)
    return not_in(keys, F.col(fk), ref, ref_key)


def not_in(df: DataFrame, value: Column, ref: DataFrame, ref_key: str) -> DataFrame:
    """Rows for which ``value NOT IN (SELECT ref_key FROM ref)`` is TRUE."""
    # what the right side lets through: 0 (empty) every value, 1 (no NULL) every non-NULL one, 2 none;
    # one aggregate of one number, referred to once
    n, n_null = F.count(F.lit(1)), F.count_if(F.col(ref_key).isNull())
    bars = ref.agg(F.when(n == 0, 0).when(n_null == 0, 1).otherwise(2).alias("bars")).scalar()
    r = ref.select(F.col(ref_key).alias("_ref_key"))
    passes = df.filter(bars <= F.when(value.isNull(), 0).otherwise(1))
    return passes.join(r, value == F.col("_ref_key"), "left_anti")


def rows_with_orphans(df: DataFrame, fk: str, orphans: DataFrame, count_name: str = "n_rows") -> DataFrame:
    """Number of rows carrying each orphan key: counted by key first, so the semi join sees
    one row per key however hot it is."""
    counts = df.groupBy(fk).agg(F.count(F.lit(1)).alias(count_name))
    return counts.join(orphans.select(F.col(fk).alias("_o")), F.col(fk) == F.col("_o"), "left_semi")


def lookup_key(df: DataFrame, fk: ColumnOrName, dim: DataFrame, natural_key: str, surrogate_key: str,
               how: str = "inner") -> DataFrame:
    """Attach ``dim[surrogate_key]`` by matching ``fk`` to ``dim[natural_key]``."""
    d = dim.select(F.col(natural_key).alias("_nk"), F.col(surrogate_key).alias(surrogate_key))
    return df.join(d, col(fk) == F.col("_nk"), how).drop("_nk")
