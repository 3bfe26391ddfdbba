"""Date dimension (a role-playing calendar, one physical copy per fact)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import expr as X


def date_dimension(df: DataFrame, ts: str, fiscal_start_month: int = 10) -> DataFrame:
    """Every day from 1 January of the earliest year in ``df[ts]`` to 31 December of the
    latest, with 12 columns.  The range comes from a global min/max aggregate (one row),
    then ``sequence`` + ``explode`` (no recursion, no depth limit).  An empty input gives
    no rows."""
    bounds = df.agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    days = bounds.select(F.explode(F.sequence(
        F.make_date(F.year("_lo"), F.lit(1), F.lit(1)),
        F.make_date(F.year("_hi"), F.lit(12), F.lit(31)))).alias("full_date"))
    d = F.col("full_date")
    return days.select(
        X.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.dayofmonth(d).alias("calendar_day"),
        X.day_of_week(d).alias("day_of_week"),
        X.day_name(d).alias("day_name"),
        X.is_weekend(d).alias("is_weekend"),
        X.fiscal_year(d, fiscal_start_month).alias("fiscal_year"),
        X.fiscal_quarter(d, fiscal_start_month).alias("fiscal_quarter"),
        X.fiscal_month(d, fiscal_start_month).alias("fiscal_month"),
    )
