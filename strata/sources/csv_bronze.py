"""Typed CSV ingest into bronze with rejected rows kept aside.

The schema is declared, never inferred; columns are taken by position after the
header row.  Quotes follow RFC 4180 (a quoted comma stays inside its field).  A row
that does not fit the schema (a value that does not parse, too few or too many
fields) is not lost: it is kept as rejected, with its raw text.  Good and rejected
rows leave the same scan, marked by ``REJECTED``, so each file is parsed once.

A load has an error limit: more rejected rows in one file than ``MAX_ERRORS`` (ten, as bulk
loads have it) and the load fails before anything is published, so that a wholly broken file
doesn't come out as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas

RAW = "raw_record"
REJECTED = "_rejected"
SOURCE_FILE = "_source_file"
MAX_ERRORS = 10


class LoadRejected(RuntimeError):
    """A file has more rejected rows than a load may have."""


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with ``schema``, ``raw_record`` (of rejected rows), ``_rejected`` and the name of their
    file.  ``path`` may be a file, a directory or a glob; files are split across tasks like any scan."""
    with_raw = T.StructType(schema.fields + [T.StructField(RAW, T.StringType(), True)])
    rows = (spark.read.schema(with_raw)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RAW)
            .option("enforceSchema", True)
            .option("quote", '"').option("escape", '"')
            .option("multiLine", False)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]['Z']")
            .option("dateFormat", "yyyy-MM-dd")
            .option("encoding", "UTF-8")
            .csv(path))
    return rows.withColumns({REJECTED: F.col(RAW).isNotNull(), SOURCE_FILE: F.col("_metadata.file_name")})


def read_bronze_table(spark: SparkSession, src_dir: str, name: str) -> DataFrame:
    return read_bronze(spark, f"{src_dir}/{name}.csv", schemas.BRONZE[name])


def good_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The good rows of a bronze folder written partitioned by ``_rejected``."""
    written = T.StructType(schema.fields + [T.StructField(REJECTED, T.BooleanType())])
    return spark.read.schema(written).parquet(path).where(~F.col(REJECTED)).drop(REJECTED)


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected rows: their raw text, and what did parse of them."""
    written = T.StructType(schema.fields + [T.StructField(RAW, T.StringType()), T.StructField(REJECTED, T.BooleanType())])
    rows = spark.read.schema(written).parquet(path).where(F.col(REJECTED))
    return rows.select(RAW, *[F.col(f.name) for f in schema.fields])


def file_verdicts(spark: SparkSession, path: str, max_errors: int = MAX_ERRORS) -> DataFrame:
    """Per source file of a bronze folder (written partitioned by ``_rejected``): its rows, how many were
    rejected, how many may be, and whether it is accepted.  Reads the file name only."""
    written = T.StructType([T.StructField(SOURCE_FILE, T.StringType()), T.StructField(REJECTED, T.BooleanType())])
    counts = spark.read.schema(written).parquet(path).groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(REJECTED)).alias("n_rejected"))
    return counts.withColumns({"max_errors": F.lit(max_errors), "accepted": F.col("n_rejected") <= max_errors})


def assert_accepted(spark: SparkSession, path: str, max_errors: int = MAX_ERRORS) -> None:
    """Raise if a file of a bronze folder is over the limit (names ten of them)."""
    over = file_verdicts(spark, path, max_errors).where("NOT accepted").orderBy("source_file").limit(10).collect()
    if over:
        raise LoadRejected("; ".join(f"{r.source_file}: {r.n_rejected} of {r.n_rows} rows rejected, {max_errors} allowed" for r in over))
