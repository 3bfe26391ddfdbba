"""Layer storage: tables made of immutable parts, and numbered manifests that name them.

A load writes its rows to a new folder ``<root>/<layer>/<table>/v=<version>`` and never to
one that exists.  A manifest ``<root>/_manifests/<number>`` lists, for every table, the
folders that make it up, and what is known of each (rows, least and greatest value of
measured columns, bucket); it is written under another name and put in place by one rename,
so all tables of a refresh change together, and a reader sees the old warehouse or the new
one.  Appending a part means listing one folder more.

The first manifest, which lists nothing, is written before any data.  So "nothing loaded
yet" and "the manifests are lost" differ: the latter raises.  ``root`` must be on a shared
file system whose rename is atomic and doesn't overwrite (HDFS, or a store whose Hadoop
connector gives both); on a plain object store two refreshes at once could both publish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_manifests"
#: (layer, table) -> its folders, relative to the root
Tables = dict[str, list[str]]
#: folder -> what is known of it: {"rows": n, "low": {column: value}, "high": {...}, "bucket": b}
Facts = dict[str, dict[str, Any]]


@dataclass
class Manifest:
    number: int
    tables: Tables = field(default_factory=dict)
    facts: Facts = field(default_factory=dict)


class LostManifest(RuntimeError):
    """Data is there, but no manifest says what belongs to it."""


class StaleManifest(RuntimeError):
    """Another refresh was published since this one began."""


def unique_version(label: str) -> str:
    """A version no other attempt has, however often a stamp is run again."""
    return f"{label}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return fs.exists(hpath)


def _manifest_numbers(spark: SparkSession, root: str) -> list[int]:
    fs, hpath = _fs(spark, f"{root}/{MANIFESTS}")
    if not fs.exists(hpath):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(hpath) if s.getPath().getName().isdigit())


def _put_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    final = f"{root}/{MANIFESTS}/{manifest.number:09d}"
    if _exists(spark, final):
        raise StaleManifest(final)
    draft = f"{root}/{MANIFESTS}/draft-{uuid.uuid4().hex}"
    fs, hpath = _fs(spark, draft)
    listed = {folder for folders in manifest.tables.values() for folder in folders}
    text = json.dumps({"tables": manifest.tables, "facts": {f: manifest.facts[f] for f in sorted(listed & set(manifest.facts))}},
                      sort_keys=True)
    out = fs.create(hpath, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(hpath, _fs(spark, final)[1]):
        raise StaleManifest(final)


def open_warehouse(spark: SparkSession, root: str) -> int:
    """Number of the current manifest; the empty first one is written for a new root."""
    numbers = _manifest_numbers(spark, root)
    if numbers:
        return numbers[-1]
    fs, hpath = _fs(spark, root)
    if fs.exists(hpath) and any(s.isDirectory() for s in fs.listStatus(hpath)):
        raise LostManifest(f"{root} holds data but no manifest")
    _put_manifest(spark, root, Manifest(0))
    return 0


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest:
    """The current manifest, or the one with the given number while it is kept."""
    if number is None:
        number = open_warehouse(spark, root)
    content = json.loads(spark.read.text(f"{root}/{MANIFESTS}/{number:09d}", wholetext=True).first()[0])
    return Manifest(number, content["tables"], content["facts"])


def current_tables(spark: SparkSession, root: str) -> Tables:
    """What the current manifest lists."""
    return read_manifest(spark, root).tables


def publish(spark: SparkSession, root: str, number: int, changes: Tables, facts: Facts | None = None) -> int:
    """Put the manifest after ``number`` in place: the current tables with ``changes``."""
    now = read_manifest(spark, root)
    _put_manifest(spark, root, Manifest(number + 1, now.tables | changes, now.facts | (facts or {})))
    return number + 1


def write_part(df: DataFrame, root: str, layer: str, name: str, version: str,
               partition_by: Sequence[str] | None = None) -> str:
    """Write rows to a new folder (an existing one is an error); returns it relative to the root."""
    part = f"{layer}/{name}/v={version}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root}/{part}")
    return part


def read_parts(spark: SparkSession, root: str, parts: Sequence[str]) -> DataFrame:
    # the folders are parts of one table, not partitions of a column v; the newest has all columns
    schema = spark.read.parquet(f"{root}/{parts[-1]}").schema
    return spark.read.schema(schema).parquet(*[f"{root}/{p}" for p in parts])


def read_layer(spark: SparkSession, root: str, layer: str, name: str, number: int | None = None) -> DataFrame | None:
    """The published rows of a table (of an earlier manifest, if its number is given), or None when nothing is
    published for it yet."""
    parts = read_manifest(spark, root, number).tables.get(f"{layer}/{name}")
    return read_parts(spark, root, parts) if parts else None


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in the given order; the limit is the feature."""
    return df.orderBy(*order).limit(n)


# Published wrapper views: one plain column list over each gold table.
VIEW_NAMES = {
    "dim_payers": "vw_dim_payers",
    "dim_patients": "vw_dim_patients",
    "dim_encounter_date": "vw_dim_encounter_date",
    "fact_encounters": "vw_fact_encounters",
    "dim_procedure_date": "vw_dim_procedure_date",
    "fact_procedures": "vw_fact_procedures",
}


def open_views(spark: SparkSession, root: str) -> list[str]:
    """Make the views over the published gold tables in this session.  The manifest says what
    they show, so any later session gets the same views, not only the one that loaded them."""
    made = []
    for name, view in VIEW_NAMES.items():
        df = read_layer(spark, root, "gold", name)
        if df is not None:
            df.select(*[F.col(c) for c in df.columns]).createOrReplaceTempView(view)
            made.append(view)
    return made


def create_views(spark: SparkSession, root: str, database: str, names: Mapping[str, str] = VIEW_NAMES,
                 layer: str = "gold") -> list[str]:
    """Make or replace views in the catalog's ``database`` over the parts that the current manifest lists.  They
    outlive the session: any session of the catalog reads them without this module (with a Hive metastore, any
    application).  A view is replaced as a whole, so a reader gets one manifest's parts of a table or another's."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    manifest, made = read_manifest(spark, root), []
    for name, view in names.items():
        parts = manifest.tables.get(f"{layer}/{name}")
        if parts:
            columns = ", ".join(f"`{c}`" for c in read_parts(spark, root, parts).columns)
            rows = " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{root}/{part}`" for part in parts)
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS {rows}")
            made.append(f"{database}.{view}")
    return made
