"""Helpers the operators of this folder share: reading, shipping the package to Python
workers, per-row Arrow maps, lookups in a table of which some rows are asked for very often, and
a bounded memo."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

_SHIPPED: set[str] = set()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package through Spark's own file distribution, once
    per application, so that they need no shared folder and no PYTHONPATH."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[..., Iterator[tuple]]]) -> DataFrame:
    """Apply a per-row generator on the executors, batch by Arrow batch.

    ``make()`` runs once per task and returns the function that turns one row (its columns
    as positional arguments) into any number of output tuples of ``schema``.  Memory is one
    Arrow batch and its output."""

    def of_batch():
        fn = make()
        return lambda rows: [out for values in rows for out in fn(*values)]

    return map_batches(df, schema, of_batch)


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[Iterator[tuple]], Iterable[tuple]]]) -> DataFrame:
    """``map_rows`` for work that many rows share: the function that ``make()`` returns turns all
    rows of an Arrow batch into output tuples."""
    ship_package(df.sparkSession)
    kind: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        fn = make()
        gc.disable()  # rows and memos hold no cycles; searching large memos for them takes half the time
        try:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                rows = list(fn(zip(*columns)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=f.type) for v, f in zip(zip(*rows), arrow)], schema=arrow)
        finally:
            gc.enable()

    return df.mapInArrow(run, schema)


def lookup(rows: DataFrame, keys: dict[str, str], table: DataFrame, values: list[str], asked: str, total: int) -> DataFrame:
    """``rows`` with the ``values`` of the row of ``table`` whose keys (table's -> rows') agree, null without one.
    ``asked`` says how many rows ask for a row of ``table``: what over a thousandth of all ``total`` ask for are
    fewer than a thousand rows, so these are broadcast, and the rows they serve are not shuffled."""
    named = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(v).alias(f"_v_{v}") for v in values],
                         F.lit(True).alias("_hit"), F.col(asked).alias("_asked"))
    limit = total / 1000
    hot, rest = (named.where(c).drop("_asked") for c in (F.col("_asked") > limit, F.col("_asked") <= limit))

    def same():
        cond = F.lit(True)
        for k, mine in keys.items():
            cond &= F.col(f"_k_{k}") == F.col(mine)
        return cond

    def done(df: DataFrame) -> DataFrame:
        return df.select(*rows.columns, *[F.col(f"_v_{v}").alias(v) for v in values])

    first = rows.join(F.broadcast(hot), same(), "left")
    return done(first.where("_hit")).unionByName(
        done(first.where("_hit IS NULL").select(*rows.columns).join(rest, same(), "left")))


class Memo(dict):
    """A dict that computes missing values.  Once it holds ``bound`` of them, it keeps them as
    the old generation, from which what is still asked for moves over, and forgets the one
    before.  Keys longer than ``longest`` are computed every time, so its memory is bounded."""

    def __init__(self, compute: Callable, bound: int = 200_000, longest: int = 64):
        super().__init__()
        self.compute, self.bound, self.longest, self.old = compute, bound, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.bound:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
