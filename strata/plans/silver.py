"""Silver loads: bronze -> cleaned, deduplicated, key-resolved tables.

Column names of the bronze side follow the raw CSV headers (Id, START, STOP, PATIENT,
PAYER, CODE, DESCRIPTION, ...).  String ids are trimmed once at the start so every
later filter, dedupe and join compares the same values; numeric ids are left alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import expr as X
from strata.operators.canonical import canonical_description
from strata.operators.dedupe import drop_null_keys, first_per_key
from strata.operators.keys import PLACE, first_in_slices, next_key_start, number_places
from strata.operators.merge import (UNGUARDED, ensure_placeholder, infer_missing_members, new_rows, upsert_scd1)
from strata.operators.outliers import cap_outliers, iqr_bounds
from strata.operators.refint import keep_new
from strata.sources.lookups import us_states
from strata import schemas

# Fixed values of the source rules: the no-payer placeholder (key 0) and the
# inferred-member filler.
PLACEHOLDER_PAYER_ID = "0000"
PLACEHOLDER_PAYER = {
    "payer_key": 0, "payer_id": PLACEHOLDER_PAYER_ID, "payer_name": "No Payer / Self-Pay",
    "payer_address": "N/A", "payer_city": "N/A", "state_headquartered": "NA",
    "payer_state": "Not Applicable", "zip": "00000", "phone": "000-000-0000",
}
INFERRED_PAYER = {
    "payer_name": "Unknown Payer / Auto-Generated", "payer_address": "N/A", "payer_city": "N/A",
    "state_headquartered": "NA", "payer_state": "Not Applicable", "zip": "00000", "phone": "000-000-0000",
}
MARITAL_LABELS = {"S": "Single", "M": "Married"}
GENDER_LABELS = {"F": "Female", "M": "Male"}


def trim_ids(df: DataFrame, cols) -> DataFrame:
    """Trim the given columns when they are strings (numeric ids pass unchanged)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for c in cols:
        if c in types and isinstance(types[c], T.StringType):
            out = out.withColumn(c, F.trim(F.col(c)))
    return out


def _empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


# ------------------------------------------------------------------------ payers
def silver_payers(bronze_payers: DataFrame, bronze_encounters: DataFrame, existing: DataFrame | None,
                  batch_ts: dt.datetime, states: DataFrame | None = None) -> DataFrame:
    """Dedupe by Id, keep payers whose state is in the lookup, type-1 upsert, the key-0
    placeholder, then inferred members for payer ids used by encounters."""
    spark = bronze_payers.sparkSession
    # the built-in lookup is a fixed 50-row constant, so broadcasting it is bounded; a
    # caller's lookup table is left to the planner's size check
    states = F.broadcast(us_states(spark)) if states is None else states
    b = trim_ids(bronze_payers, ["Id", "NAME", "ADDRESS", "CITY", "STATE_HEADQUARTERED"])
    b = first_per_key(drop_null_keys(b, ["Id"]), ["Id"])
    src = b.join(states, F.col("STATE_HEADQUARTERED") == F.col("Abbreviation"), "inner").select(
        F.col("Id").alias("payer_id"), F.col("NAME").alias("payer_name"), F.col("ADDRESS").alias("payer_address"),
        F.col("CITY").alias("payer_city"), F.col("STATE_HEADQUARTERED").alias("state_headquartered"),
        F.col("StateName").alias("payer_state"), F.col("ZIP").alias("zip"), F.col("PHONE").alias("phone"))
    target = existing if existing is not None else _empty(spark, schemas.SILVER_PAYERS)
    tracked = {c: "" for c in src.columns if c != "payer_id"}
    merged = upsert_scd1(target, src, "payer_id", tracked, "payer_key", "updated_at", batch_ts)
    with_zero = ensure_placeholder(merged, {**PLACEHOLDER_PAYER, "updated_at": batch_ts}, "payer_key")
    used = trim_ids(bronze_encounters.select("PAYER"), ["PAYER"])
    return infer_missing_members(with_zero, used, "PAYER", "payer_id", "payer_key",
                                 {**INFERRED_PAYER, "updated_at": batch_ts})


# ---------------------------------------------------------------------- patients
PATIENT_TRACKED: Mapping[str, Any] = {
    "birth_date": dt.date(1900, 1, 1), "death_date": dt.date(1900, 1, 1), "patient_name": UNGUARDED,
    "suffix": "", "maiden": UNGUARDED, "marital_status": "", "race": "", "ethnicity": "", "gender": "",
    "birth_place": "", "patient_address": "", "patient_city": "", "patient_state": "", "patient_county": "",
    "zip": "", "lat": 0, "lon": 0,
}


def clean_patients(bronze_patients: DataFrame) -> DataFrame:
    b = trim_ids(bronze_patients, ["Id"])
    b = first_per_key(drop_null_keys(b, ["Id"]), ["Id"])
    return b.select(
        F.col("Id").alias("patient_id"), F.col("BIRTHDATE").alias("birth_date"),
        F.col("DEATHDATE").alias("death_date"),
        X.person_name("PREFIX", "FIRST", "LAST").alias("patient_name"),
        X.null_to("SUFFIX", "Unknown").alias("suffix"),
        X.presence_flag("MAIDEN").alias("maiden"),
        X.recode("MARITAL", MARITAL_LABELS).alias("marital_status"),
        X.title_or("RACE", "Unknown").alias("race"),
        X.title_or("ETHNICITY", "Unknown").alias("ethnicity"),
        X.recode("GENDER", GENDER_LABELS).alias("gender"),
        F.col("BIRTHPLACE").alias("birth_place"), F.col("ADDRESS").alias("patient_address"),
        X.title_or("CITY", None).alias("patient_city"), X.title_or("STATE", None).alias("patient_state"),
        X.title_or("COUNTY", None).alias("patient_county"), F.col("ZIP").alias("zip"),
        F.col("LAT").alias("lat"), F.col("LON").alias("lon"))


def silver_patients(bronze_patients: DataFrame, existing: DataFrame | None, batch_ts: dt.datetime) -> DataFrame:
    spark = bronze_patients.sparkSession
    target = existing if existing is not None else _empty(spark, schemas.SILVER_PATIENTS)
    return upsert_scd1(target, clean_patients(bronze_patients), "patient_id", PATIENT_TRACKED, "patient_key",
                       "updated_at", batch_ts)


# -------------------------------------------------------------------- encounters
def _durations(df: DataFrame) -> DataFrame:
    return df.withColumn("_dur", X.minute_diff("START", "STOP"))


def _known_encounters(bronze: DataFrame, patients: DataFrame, payers: DataFrame) -> DataFrame:
    """The encounters with an id whose patient and payer (NULL -> placeholder) exist, with their keys.  Patients
    and payers are unique per id, so an inner join is the semi join *and* the key lookup: one join per dimension."""
    b = trim_ids(bronze, ["Id", "PATIENT", "PAYER", "CODE"])
    b = b.withColumn("_payer", F.coalesce(F.col("PAYER"), F.lit(PLACEHOLDER_PAYER_ID)))
    b = drop_null_keys(b, ["Id"])
    pats = patients.select(F.col("patient_id").alias("_pid"), "patient_key", F.col("birth_date").alias("_birth"))
    pays = payers.select(F.col("payer_id").alias("_yid"), "payer_key")
    return b.join(pats, F.col("PATIENT") == F.col("_pid")).join(pays, F.col("_payer") == F.col("_yid"))


def _encounter_columns(known: DataFrame, bronze: DataFrame, batch_ts: dt.datetime) -> list[Any]:
    """``known``, one row per encounter, with canonical descriptions and the IQR limit over all bronze rows; and the
    silver columns but the surrogate key."""
    limits = iqr_bounds(_durations(bronze), "_dur")
    codes = trim_ids(bronze, ["CODE"])
    canon = canonical_description(codes, "CODE", "DESCRIPTION").withColumnRenamed("DESCRIPTION", "_canon")
    j = cap_outliers(_durations(known.join(canon, "CODE")), "_dur", "encounter_duration_min", limits)
    money = "decimal(10,2)"
    made = {
        "encounter_id": F.col("Id"), "encounter_start": F.col("START"),
        "encounter_stop": F.col("STOP"), "date_key": X.date_key("START"),
        "patient_age_ed": X.year_diff("_birth", "START"), "organization": F.col("ORGANIZATION"),
        "encounterclass": X.title_or("ENCOUNTERCLASS", "Unknown"),
        "encounter_code": F.col("CODE"), "encounter_description": F.col("_canon"),
        "base_encounter_cost": X.floor_to_one("BASE_ENCOUNTER_COST", money),
        "total_claim_cost": X.floor_to_one("TOTAL_CLAIM_COST", money),
        "payer_coverage": X.cap_coverage("PAYER_COVERAGE", "TOTAL_CLAIM_COST", money),
        "reason_code": X.null_to("REASONCODE", "Unknown"),
        "reason_description": X.null_to("REASONDESCRIPTION", "Unknown"),
        "recorded_at": X.ntz_lit(batch_ts)}
    return [j, [made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                for f in schemas.SILVER_ENCOUNTERS.fields if f.name != "encounter_key"]]


def clean_encounters(bronze: DataFrame, patients: DataFrame, payers: DataFrame, batch_ts: dt.datetime) -> DataFrame:
    """IQR limit over all bronze rows; canonical descriptions; RI filters (patient, payer
    with NULL -> placeholder) before the id dedupe; derived columns.  One row per encounter,
    without its surrogate key."""
    one = first_per_key(_known_encounters(bronze, patients, payers), ["Id"])
    rows, columns = _encounter_columns(one, bronze, batch_ts)
    return rows.select(*columns)


def new_silver_encounters(bronze: DataFrame, patients: DataFrame, payers: DataFrame, existing: DataFrame | None,
                          batch_ts: dt.datetime) -> DataFrame:
    """Only the encounters that are not loaded yet, with keys after the last (rows already
    loaded never change): ``clean_encounters`` and ``new_rows``, with one exchange for the dedupe and the keys."""
    target = existing if existing is not None else _empty(bronze.sparkSession, schemas.SILVER_ENCOUNTERS)
    if bronze.schema["Id"].dataType != T.StringType():  # ids that don't sort as the stored text does
        return new_rows(target, clean_encounters(bronze, patients, payers, batch_ts), "encounter_id", "encounter_key")
    known = _known_encounters(bronze, patients, payers)
    if existing is not None:
        known = keep_new(known, existing, "Id", "encounter_id")
    # a row without a code has no canonical description and is lost with it
    placed = first_in_slices(known, ["Id"], where=F.col("CODE").isNotNull())
    rows, columns = _encounter_columns(placed, bronze, batch_ts)
    keyed = number_places(rows.select(PLACE, *columns), "encounter_key", next_key_start(target, "encounter_key"))
    return keyed.select(*target.columns)


def silver_encounters(bronze: DataFrame, patients: DataFrame, payers: DataFrame, existing: DataFrame | None,
                      batch_ts: dt.datetime) -> DataFrame:
    """The whole table after the load: what was there, and the new rows."""
    fresh = new_silver_encounters(bronze, patients, payers, existing, batch_ts)
    return fresh if existing is None else existing.unionByName(fresh)


# -------------------------------------------------------------------- procedures
def silver_procedures(bronze: DataFrame, patients: DataFrame, patient_id_col: str, encounters: DataFrame,
                      encounter_id_col: str, birth_date_col: str | None = "birth_date") -> DataFrame:
    """Full reload with keys from 1: IQR limit over all bronze rows, canonical
    descriptions, RI filters (patient, encounter) before a dedupe on (START, PATIENT,
    CODE) that keeps the latest STOP, key lookups, capped duration and floored cost."""
    b = trim_ids(bronze, ["PATIENT", "ENCOUNTER", "CODE"])
    limits = iqr_bounds(_durations(bronze), "_dur")
    canon = canonical_description(b, "CODE", "DESCRIPTION").withColumnRenamed("DESCRIPTION", "_canon")
    keep = [c for c in ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "BASE_COST",
                        "REASONCODE", "REASONDESCRIPTION"] if c in b.columns]
    # Referential filters before the dedupe; patients and encounters are unique per id,
    # so the inner join is both the filter and the key lookup.  A row without a code has no
    # canonical description and is lost with it.
    pat_cols = [F.col(patient_id_col).alias("_pid"), "patient_key"]
    if birth_date_col:
        pat_cols.append(F.col(birth_date_col).alias("_birth"))
    encs = encounters.select(F.col(encounter_id_col).alias("_eid"), "encounter_key")
    b = (b.select(*keep).where(F.col("CODE").isNotNull())
         .join(patients.select(*pat_cols), F.col("PATIENT") == F.col("_pid"))
         .join(encs, F.col("ENCOUNTER") == F.col("_eid")))
    # the looked-up columns depend on PATIENT / ENCOUNTER only, so they cannot change
    # which row of a (START, PATIENT, CODE) group sorts first
    b = first_in_slices(b.drop("_pid", "_eid"), ["START", "PATIENT", "CODE"], [("STOP", "desc")])
    j = cap_outliers(_durations(b.join(canon, "CODE")), "_dur", "procedure_duration_min", limits)
    cols: list[Column] = [
        F.col("START").alias("procedure_start"), F.col("STOP").alias("procedure_stop"),
        X.date_key("START").alias("date_key"), F.col("procedure_duration_min"), F.col("patient_key")]
    if birth_date_col:
        cols.append(X.year_diff("_birth", "START").alias("patient_age_pd"))
    cols += [F.col("encounter_key"), F.col("CODE").alias("procedure_code"),
             F.col("_canon").alias("procedure_description"),
             X.floor_to_one(F.col("BASE_COST").cast("int"), "int").alias("base_procedure_cost")]
    if "REASONCODE" in b.columns:
        cols += [X.null_to("REASONCODE", "Unknown").alias("reason_code"),
                 X.null_to("REASONDESCRIPTION", "Unknown").alias("reason_description")]
    out = j.select(*cols, PLACE)
    keyed = number_places(out, "procedure_key")
    return keyed.select("procedure_key", *[c for c in out.columns if c != PLACE])
