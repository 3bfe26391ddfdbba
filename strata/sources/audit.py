"""Load audit: rows in / out / rejected and seconds taken per table and batch, as a stored table.

Counts are taken with ``DataFrame.observe`` while the table is being written, so the
audit costs no extra pass over the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = ("layer string, table_name string, rows_in long, rows_out long, rows_rejected long, "
                "seconds double, batch_ts timestamp_ntz")


def observed(df: DataFrame, name: str, rejected: str | None = None) -> tuple[DataFrame, Observation]:
    """Attach a row counter; read ``obs.get['rows']`` (and ``['rejected']``) after the write."""
    obs = Observation(name)
    counts = [F.count(F.lit(1)).alias("rows")]
    if rejected:
        counts.append(F.count_if(F.col(rejected)).alias("rejected"))
    return df.observe(obs, *counts), obs


def load_audit(spark: SparkSession, entries: list[tuple[str, str, int, int, int, float]], batch_ts: dt.datetime) -> DataFrame:
    """One row per (layer, table), with what was gathered during a refresh, and one per layer (``table_name``
    NULL) with its sums."""
    layers = dict.fromkeys(e[0] for e in entries)
    sums = [(layer, None, *(sum(e[i] for e in entries if e[0] == layer) for i in range(2, 6))) for layer in layers]
    rows = [(*entry, batch_ts) for entry in [*entries, *sums]]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)
