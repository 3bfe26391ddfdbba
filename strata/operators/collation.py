"""Comparison under a collation, as an opt-in.

Names and ids are compared byte by byte by default.  Where the source compared them without
regard to case and trailing blanks, ``compare_as`` gives the named columns a collation; every
operator (dedupe, key lookup, semi and anti joins, duplicate reports, filters, groupings) then
compares them so, while the values stay what they are.  ``as_stored`` takes the collation off
again before rows are written or meet columns without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's names for "without case and trailing blanks" and for byte by byte.
LOOSE = "UTF8_LCASE_RTRIM"
BYTES = "UTF8_BINARY"


def compare_as(df: DataFrame, *columns: str, collation: str = LOOSE) -> DataFrame:
    """``df`` with the text ``columns`` (all of them if none is named) compared under ``collation``."""
    named = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.collate(F.col(c), collation) for c in named})


def as_stored(df: DataFrame) -> DataFrame:
    """``df`` with all top-level text columns compared byte by byte again."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.collate(F.col(c), BYTES) for c in texts}) if texts else df


def collated_like(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the collations that its columns have in ``schema``."""
    kinds = {f.name: f.dataType.collation for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.collate(F.col(c), k) for c, k in kinds.items() if k != BYTES})
