"""Declared constraints checked as queries: foreign keys, primary keys, NOT NULL.

Each rule yields one row ``(table_name, rule, kind, violating_rows, ok)``; a report is
the union of its rules, so the whole audit is a single plan whose branches run in
parallel.  A NULL foreign key passes (as a checked FK constraint would); an orphan
fails.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.refint import keep_new


def _rule_row(counted: DataFrame, table_name: str, rule: str, kind: str) -> DataFrame:
    return counted.select(F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"),
                          F.lit(kind).alias("kind"), F.col("violating_rows"),
                          (F.col("violating_rows") == 0).alias("ok"))


def fk_violations(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Non-NULL ``fk`` values without a ``dim[pk]`` and how many fact rows carry each.  Facts are
    counted by key before the join, so a hot key crosses the shuffle as one row per task."""
    counts = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_n"))
    return keep_new(counts, dim, fk, pk)


def fk_rule(fact: DataFrame, fk: str, dim: DataFrame, pk: str, table_name: str, rule: str) -> DataFrame:
    counted = fk_violations(fact, fk, dim, pk).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violating_rows"))
    return _rule_row(counted, table_name, rule, "FOREIGN KEY")


def pk_rule(df: DataFrame, keys: Sequence[str], table_name: str, rule: str, kind: str = "PRIMARY KEY") -> DataFrame:
    """Rows whose key is NULL or shared with another row."""
    any_null = None
    for k in keys:
        c = F.col(k).isNull()
        any_null = c if any_null is None else any_null | c
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    bad = groups.filter((F.col("_n") > 1) | any_null)
    counted = bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violating_rows"))
    return _rule_row(counted, table_name, rule, kind)


def _column_rules(df: DataFrame, broken: dict[str, Column], table_name: str, kind: str) -> DataFrame:
    """One row per rule, all counted in one pass over the table."""
    counted = df.agg(*[F.count_if(c).alias(rule) for rule, c in broken.items()])
    rows = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("violating_rows")) for rule in broken])
    return counted.select(F.explode(rows).alias("r")).select(
        F.lit(table_name).alias("table_name"), F.col("r.rule"), F.lit(kind).alias("kind"), F.col("r.violating_rows"),
        (F.col("r.violating_rows") == 0).alias("ok"))


def not_null_rules(df: DataFrame, columns: Sequence[str], table_name: str, prefix: str = "NN_") -> DataFrame:
    return _column_rules(df, {f"{prefix}{c}": F.col(c).isNull() for c in columns}, table_name, "NOT NULL")


def length_rules(df: DataFrame, limits: Mapping[str, int], table_name: str) -> DataFrame:
    """Texts that don't fit their declared width."""
    return _column_rules(df, {f"LEN_{c}": F.length(c) > n for c, n in limits.items()}, table_name, "LENGTH")


def not_null_rule(df: DataFrame, column: str, table_name: str, rule: str) -> DataFrame:
    return _column_rules(df, {rule: F.col(column).isNull()}, table_name, "NOT NULL")


def unique_rule(df: DataFrame, keys: Sequence[str], table_name: str, rule: str) -> DataFrame:
    """Rows that share their key with another; NULL keys count as one value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return _rule_row(groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violating_rows")), table_name, rule, "UNIQUE")


def constraint_report(rules: Sequence[DataFrame]) -> DataFrame:
    """Union of the rule rows, ordered by constraint kind descending, then table (one
    row per rule, so the sort is over a handful of rows)."""
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.col("kind").desc(), F.col("table_name"), F.col("rule"))


class ConstraintViolation(RuntimeError):
    pass


def assert_constraints(report: DataFrame) -> None:
    """Fail before publishing when any rule is broken.  The report has one row per rule
    (a handful), so collecting it is bounded."""
    bad = [r for r in report.filter(~F.col("ok")).collect()]
    if bad:
        detail = "; ".join(f"{r.table_name}.{r.rule}: {r.violating_rows}" for r in bad)
        raise ConstraintViolation(f"constraint check failed: {detail}")
