"""Data-quality checks: each returns a DataFrame a user can show, count or store.

All are filters or map-side-combined aggregates; none gathers a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import ColumnOrName, col, minute_diff


def row_count(df: DataFrame, table_name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(table_name).alias("table_name"), "n_rows")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for several tables: one-row counts, unioned."""
    return reduce(DataFrame.unionByName, [row_count(df, name) for name, df in tables.items()])


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min and max of each column, one row (``min_<c>``, ``max_<c>``)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) per column, from one aggregate pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_count")


def with_duration(df: DataFrame, start: str, stop: str, out: str = "duration_min") -> DataFrame:
    return df.withColumn(out, minute_diff(start, stop))


def negative_durations(df: DataFrame, start: str, stop: str, out: str = "duration_min") -> DataFrame:
    return with_duration(df, start, stop, out).filter(F.col(out) < 0)


def longest(df: DataFrame, value: ColumnOrName, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """Top ``k`` rows by ``value`` descending, ties broken by ``tiebreak`` ascending;
    planned as a distributed top-k (each task keeps k rows)."""
    return df.orderBy(col(value).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak]).limit(k)


def domain_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def rows_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows breaking a (cross-column) rule, e.g. prefix 'Mrs.' with no maiden name."""
    return df.filter(condition)


def coverage_over_claim(df: DataFrame, coverage: str, claim: str) -> DataFrame:
    return df.filter((F.col(claim) - F.col(coverage)) < 0)


def key_violations(df: DataFrame, keys: Sequence[str], count_name: str = "n_rows") -> DataFrame:
    """Key values that are NULL or occur more than once (``GROUP BY k HAVING COUNT(*) > 1
    OR k IS NULL``)."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else any_null | c
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    return counts.filter((F.col(count_name) > 1) | any_null)
