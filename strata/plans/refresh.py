"""Whole refresh: CSV -> bronze -> silver -> gold -> constraint check -> publish -> views.

Every table is written to a folder of its own attempt and read back before the next layer
uses it, so each layer's lineage is cut at a written table in the shared root (a lost
executor recomputes from the last written layer, not from the CSVs).  One manifest, put in
place after the gold constraint report passes, publishes all of them.  A failed refresh, or
one that is run again with the same stamp, touches nothing that is published.

Encounters are appended: a refresh writes the new ones only, as one part more, and looks for
known ids only in the parts whose ids meet the batch's.  Patients are kept in buckets by a hash
of their id: a refresh rewrites the buckets in which a patient changed or is new.  The gold facts
of encounters grow by the new part of silver, and their rules are checked on new parts only.
``maintain``
merges what many refreshes have appended and removes what no kept manifest names.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators.constraints import assert_constraints
from strata.plans.gold import encounter_checks, gold_constraint_report, gold_tables
from strata.plans.silver import PATIENT_TRACKED, clean_encounters, clean_patients, silver_payers, silver_procedures
from strata.sources.audit import load_audit, observed
from strata.sources.csv_bronze import MAX_ERRORS, REJECTED, assert_accepted, good_rows, read_bronze_table
from strata.sources.parts import Change, append_new, compact, expire, upsert_buckets, write_measured
from strata.sources.tables import (Facts, Manifest, Tables, create_views, open_views, open_warehouse, publish, read_manifest,
                                   read_parts, unique_version, write_part)
from strata.sources.trust import validate

BRONZE_TABLES = ("payers", "patients", "encounters", "procedures")
# the silver table each gold table is made from
GOLD_SOURCE = {"dim_payers": "payers", "dim_patients": "patients", "dim_encounter_date": "encounters",
               "fact_encounters": "encounters", "dim_procedure_date": "procedures", "fact_procedures": "procedures"}


class Attempt:
    """The folders and row counts of one refresh."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root, version
        self.published = read_manifest(spark, root)
        self.tables: Tables = {}
        self.facts: Facts = {}
        self.counts: dict[str, tuple[int, int, int, float]] = {}  # in, out, rejected, seconds
        self.since = time.monotonic()

    def lap(self) -> float:
        """Seconds since the table before was done: plans are run by the write that ends them."""
        before, self.since = self.since, time.monotonic()
        return self.since - before

    def manifest(self) -> Manifest:
        """What would be published now."""
        return Manifest(self.published.number, self.published.tables | self.tables, self.published.facts | self.facts)

    def rows_out(self, table: str) -> int:
        return self.counts[table][1]

    def write(self, df: DataFrame, layer: str, name: str, rows_in: int, before: list[str] | None = None) -> DataFrame:
        """Write a table, or one part more of it, and read the whole table."""
        table = f"{layer}/{name}"
        tracked, obs = observed(df, f"{table}/{self.version}")
        part = write_part(tracked, self.root, layer, name, self.version)
        self.counts[table] = (rows_in, obs.get["rows"], 0, self.lap())
        self.tables[table] = [*(before or []), part]
        return read_parts(self.spark, self.root, self.tables[table])

    def take(self, change: Change, rows_in: int) -> DataFrame:
        """A table of which only some parts were written."""
        self.tables[change.table] = change.folders
        self.facts |= change.facts
        known = self.published.facts | self.facts
        rows = sum(known[f]["rows"] for f in change.folders if f in known)
        self.counts[change.table] = (rows_in, rows, 0, self.lap())
        return read_parts(self.spark, self.root, change.folders)

    def write_bronze(self, src_dir: str, name: str, max_errors: int) -> DataFrame:
        tracked, obs = observed(read_bronze_table(self.spark, src_dir, name), f"bronze/{name}/{self.version}", REJECTED)
        part = write_part(tracked, self.root, "bronze", name, self.version, partition_by=[REJECTED])
        rows, rejected = obs.get["rows"], obs.get["rejected"]
        if rejected > max_errors:  # together; the limit is one for each file
            assert_accepted(self.spark, f"{self.root}/{part}", max_errors)
        self.counts[f"bronze/{name}"] = (rows, rows - rejected, rejected, self.lap())
        self.tables[f"bronze/{name}"] = [part]
        return good_rows(self.spark, f"{self.root}/{part}", schemas.BRONZE[name])


def run_refresh(spark: SparkSession, src_dir: str, root: str, batch_ts: dt.datetime,
                version: str | None = None, max_errors: int = MAX_ERRORS, database: str | None = None,
                buckets: int = 64) -> dict:
    """``version`` labels the attempt; it is made unique.  More than ``max_errors`` rejected rows in one file end
    the refresh before anything is published.  With a ``database``, lasting views are made in it as well."""
    number = open_warehouse(spark, root)
    attempt = Attempt(spark, root, unique_version(version or batch_ts.strftime("%Y%m%dT%H%M%S")))
    published = attempt.published.tables
    payers_before = read_parts(spark, root, published["silver/payers"]) if "silver/payers" in published else None

    bronze = {name: attempt.write_bronze(src_dir, name, max_errors) for name in BRONZE_TABLES}
    came = {name: attempt.rows_out(f"bronze/{name}") for name in BRONZE_TABLES}

    silver: dict[str, DataFrame] = {}
    silver["payers"] = attempt.write(
        silver_payers(bronze["payers"], bronze["encounters"], payers_before, batch_ts), "silver", "payers", came["payers"])
    silver["patients"] = attempt.take(upsert_buckets(
        spark, root, "silver/patients", clean_patients(bronze["patients"]), "patient_id", PATIENT_TRACKED, "patient_key",
        "updated_at", batch_ts, attempt.version, buckets, attempt.published), came["patients"])
    encounters, _ = append_new(
        spark, root, "silver/encounters", clean_encounters(bronze["encounters"], silver["patients"], silver["payers"], batch_ts),
        "encounter_id", "encounter_key", attempt.version, ["encounter_start"], attempt.published)
    silver["encounters"] = attempt.take(encounters, came["encounters"])
    silver["procedures"] = attempt.write(
        silver_procedures(bronze["procedures"], silver["patients"], "patient_id", silver["encounters"], "encounter_id"),
        "silver", "procedures", came["procedures"])

    # facts of encounters never change: the part that was added to silver becomes one part more of gold
    before = published.get("gold/fact_encounters", [])
    added = read_parts(spark, root, encounters.written) if before else silver["encounters"]
    part, facts = write_measured(gold_tables({"encounters": added}, ["fact_encounters"])["fact_encounters"], root, "gold",
                                 "fact_encounters", attempt.version, ["encounter_key", "encounter_start"])
    gold = {"fact_encounters": attempt.take(Change("gold/fact_encounters", [*before, part], facts, [part]),
                                            attempt.rows_out("silver/encounters"))}
    gold |= {name: attempt.write(df, "gold", name, attempt.rows_out(f"silver/{GOLD_SOURCE[name]}"))
             for name, df in gold_tables(silver, [n for n in GOLD_SOURCE if n not in gold]).items()}
    checked, facts, _ = validate(spark, root, "gold/fact_encounters", encounter_checks(gold), "encounter_key", attempt.manifest())
    attempt.facts |= facts
    report = gold_constraint_report(gold, without=["fact_encounters"]).unionByName(checked, allowMissingColumns=True).orderBy(
        F.col("kind").desc(), "table_name", "rule")
    assert_constraints(report)  # raises before anything is published

    audit = load_audit(spark, [(*table.split("/"), *counts) for table, counts in attempt.counts.items()], batch_ts)
    audit_part, facts = write_measured(audit.coalesce(1), root, "audit", "loads", attempt.version, [])
    attempt.tables["audit/loads"] = [*published.get("audit/loads", []), audit_part]
    publish(spark, root, number, attempt.tables, attempt.facts | facts)
    if database:
        create_views(spark, root, database)
    return {"version": attempt.version, "bronze": bronze, "silver": silver, "gold": gold, "report": report,
            "views": open_views(spark, root), "audit": read_parts(spark, root, [audit_part])}


def maintain(spark: SparkSession, root: str, keep: int = 7, min_age_seconds: float = 86_400, fan: int = 4,
             least: int = 100_000) -> dict[str, list[str]]:
    """Compact the tables that refreshes append to, publish that as one manifest, then keep the last ``keep``
    manifests and remove the folders that none of them names.  Returns the written and the removed folders."""
    manifest = read_manifest(spark, root)
    tables, facts, written = {}, {}, []
    for table in ("silver/encounters", "gold/fact_encounters", "audit/loads"):
        change = compact(spark, root, table, unique_version("compact"), fan, least, manifest=manifest)
        if change.written:
            tables |= change.tables()
            facts |= change.facts
            written += change.written
    if tables:
        publish(spark, root, manifest.number, tables, facts)
    return {"written": written, "removed": expire(spark, root, keep, min_age_seconds)}
