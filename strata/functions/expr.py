"""Column -> Column cleaning rules.

All functions are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen.  They keep the semantics of the warehouse's SQL dialect where it differs from
Spark's (see each docstring): NULL-as-empty concatenation, first-character title case,
minute and year differences that count calendar boundaries, and ordered CASE floors.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_MICROS_PER_MINUTE = 60_000_000
_MICROS_PER_DAY = 86_400_000_000


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_lit(value: _dt.datetime | _dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal parsed from ISO text, so neither the Python process's
    nor the session's time zone can shift it."""
    text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


# --------------------------------------------------------------------------- strings
def blank_to_null(c: ColumnOrName) -> Column:
    """``NULLIF(TRIM(c), '')``."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def first_upper(c: ColumnOrName) -> Column:
    """Upper-case the first character of the whole string, lower-case the rest, then
    trim.  "north andover" -> "North andover" (not ``initcap``); the slice happens
    before the trim, so " bos" -> "bos"."""
    c = col(c)
    return F.trim(F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30))))


def title_or(c: ColumnOrName, default: str | None) -> Column:
    """``first_upper`` when the value is not blank, else ``default`` (a literal or NULL)."""
    fallback = F.lit(default) if default is not None else F.lit(None).cast("string")
    return F.when(blank_to_null(c).isNotNull(), first_upper(c)).otherwise(fallback)


def null_to(c: ColumnOrName, default) -> Column:
    """Only NULL (not blank) becomes ``default``."""
    return F.coalesce(col(c), F.lit(default))


def person_name(*parts: ColumnOrName) -> Column:
    """The parts, each without blanks around it, side by side with one blank between, and no
    blank around the whole.  A missing part counts as empty but keeps its blanks: without a
    first name two of them stand inside ("Mr.  Last")."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(" "))
        pieces.append(F.coalesce(F.trim(col(p)), F.lit("")))
    return F.trim(F.concat(*pieces))


def recode(c: ColumnOrName, mapping: Mapping[str, str], default: str = "Unknown") -> Column:
    """The label of a code, whatever its case and blanks; ``default`` for any other value."""
    key = F.trim(F.upper(col(c)))
    out = None
    for code, label in mapping.items():
        cond = key == F.lit(code.strip().upper())
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def presence_flag(c: ColumnOrName) -> Column:
    """Whether there is a value."""
    return col(c).isNotNull()


# ----------------------------------------------------------------------- date / time
def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, independent of the
    session time zone."""
    # midnight 1970-01-01 as TIMESTAMP_NTZ: the difference is time-zone free
    return F.timestamp_diff("MICROSECOND", ntz_lit("1970-01-01 00:00:00"), col(ts).cast("timestamp_ntz"))


def _floor_div(x: Column, unit: int) -> Column:
    return ((x - F.pmod(x, F.lit(unit))) / F.lit(unit)).cast("long")


def minute_diff(start: ColumnOrName, stop: ColumnOrName) -> Column:
    """Number of minute boundaries crossed from ``start`` to ``stop`` (10:00:59 ->
    10:01:00 is 1), i.e. the dialect's ``DATEDIFF(MINUTE, a, b)``; negative when stop
    precedes start.  Returned as int."""
    a = _floor_div(epoch_micros(start), _MICROS_PER_MINUTE)
    b = _floor_div(epoch_micros(stop), _MICROS_PER_MINUTE)
    return (b - a).cast("int")


def elapsed_micros(start: ColumnOrName, stop: ColumnOrName) -> Column:
    """Elapsed microseconds between two timestamps (not boundary counting)."""
    return epoch_micros(stop) - epoch_micros(start)


def year_diff(start: ColumnOrName, stop: ColumnOrName) -> Column:
    """Calendar-year boundaries crossed: 31 Dec -> 1 Jan is one year."""
    return (F.year(col(stop)) - F.year(col(start))).cast("int")


def date_key(d: ColumnOrName) -> Column:
    """yyyyMMdd as an int, computed arithmetically (no string formatting)."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week(d: ColumnOrName) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(col(d))


def day_name(d: ColumnOrName) -> Column:
    """English weekday name."""
    return F.date_format(col(d), "EEEE")


def is_weekend(d: ColumnOrName) -> Column:
    return F.dayofweek(col(d)).isin(1, 7)


def fiscal_year(d: ColumnOrName, start_month: int = 10) -> Column:
    """Fiscal year that starts on the first of ``start_month`` and is named after the
    calendar year in which it ends."""
    d = col(d)
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d)).cast("int")


def fiscal_month(d: ColumnOrName, start_month: int = 10) -> Column:
    """Month number inside the fiscal year (October = 1 ... September = 12)."""
    return (F.pmod(F.month(col(d)) - start_month, F.lit(12)) + 1).cast("int")


def fiscal_quarter(d: ColumnOrName, start_month: int = 10) -> Column:
    return (F.floor((fiscal_month(d, start_month) - 1) / 3) + 1).cast("int")


# ------------------------------------------------------------------ floors and caps
def floor_to_one(c: ColumnOrName, data_type: str | None = None) -> Column:
    """Values ``<= 0`` become 1; NULL stays NULL.  ``data_type`` casts the result back
    (a CASE mixing 1 and decimal(10,2) widens the type)."""
    c = col(c)
    out = F.when(c <= 0, F.lit(1)).otherwise(c)
    return out.cast(data_type) if data_type else out


def cap_coverage(coverage: ColumnOrName, claim: ColumnOrName, data_type: str | None = None) -> Column:
    """Coverage ``<= 0`` -> 1 first; then coverage above the claim -> the claim."""
    cov, clm = col(coverage), col(claim)
    out = F.when(cov <= 0, F.lit(1)).when(cov > clm, clm).otherwise(cov)
    return out.cast(data_type) if data_type else out


def cap_duration(d: ColumnOrName, limit: ColumnOrName) -> Column:
    """Above ``limit`` -> limit; negative -> 1; zero and everything else unchanged."""
    d, lim = col(d), col(limit)
    return F.when(d > lim, lim).when(d < 0, F.lit(1)).otherwise(d).cast("int")
