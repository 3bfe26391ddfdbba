"""Canonical description per code and the codes that carry several descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.collation import as_stored, collated_like
from strata.operators.dedupe import first_per_key


def canonical_description(df: DataFrame, code: str, description: str) -> DataFrame:
    """One row per code with its shortest description.

    Length ignores trailing blanks; a NULL description sorts first and therefore wins
    (as in the source, where ``ORDER BY LEN(d)`` puts NULL first); equal lengths are
    broken by the description text.  The pairs are made distinct first, by a hash aggregate
    combined map-side: the window's sort then sees the few pairs, not every row.
    """
    pairs = df.select(code, description)
    pairs = collated_like(as_stored(pairs).distinct(), pairs.schema)
    ranked = pairs.select(code, description, F.length(F.rtrim(F.col(description))).alias("_len"))
    best = first_per_key(ranked, [code], [("_len", "asc"), (description, "asc")])
    return best.select(code, description)


def ambiguous_codes(df: DataFrame, code: str, description: str) -> DataFrame:
    """Distinct (code, description) pairs of codes that have more than one distinct
    description (NULL counts as a description, a NULL code never matches)."""
    pairs = df.select(code, description).distinct()
    multi = (pairs.groupBy(code).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > 1).select(code))
    return pairs.join(multi, on=code, how="left_semi")


def descriptions_like(df: DataFrame, code: str, description: str, pattern: str) -> DataFrame:
    """Distinct (code, description) whose description matches a SQL LIKE pattern."""
    return df.select(code, description).filter(F.col(description).like(pattern)).distinct()
