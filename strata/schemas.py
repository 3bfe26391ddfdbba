"""Declared schemas of the bronze, silver and gold layers (never inferred).

Column names and types are the contract of the files and tables: fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
D, TS, B = T.DateType(), T.TimestampNTZType(), T.BooleanType()
MONEY = T.DecimalType(10, 2)
GEO = T.DecimalType(9, 6)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ----------------------------------------------------------------------- bronze
BRONZE_PAYERS = _schema(("Id", S), ("NAME", S), ("ADDRESS", S), ("CITY", S), ("STATE_HEADQUARTERED", S),
                        ("ZIP", S), ("PHONE", S))
BRONZE_PATIENTS = _schema(("Id", S), ("BIRTHDATE", D), ("DEATHDATE", D), ("PREFIX", S), ("FIRST", S),
                          ("LAST", S), ("SUFFIX", S), ("MAIDEN", S), ("MARITAL", S), ("RACE", S), ("ETHNICITY", S),
                          ("GENDER", S), ("BIRTHPLACE", S), ("ADDRESS", S), ("CITY", S), ("STATE", S),
                          ("COUNTY", S), ("ZIP", S), ("LAT", GEO), ("LON", GEO))
BRONZE_PROCEDURES = _schema(("START", TS), ("STOP", TS), ("PATIENT", S), ("ENCOUNTER", S), ("CODE", S),
                            ("DESCRIPTION", S), ("BASE_COST", I), ("REASONCODE", S), ("REASONDESCRIPTION", S))
BRONZE_ENCOUNTERS = _schema(("Id", S), ("START", TS), ("STOP", TS), ("PATIENT", S), ("ORGANIZATION", S),
                            ("PAYER", S), ("ENCOUNTERCLASS", S), ("CODE", S), ("DESCRIPTION", S),
                            ("BASE_ENCOUNTER_COST", MONEY), ("TOTAL_CLAIM_COST", MONEY), ("PAYER_COVERAGE", MONEY),
                            ("REASONCODE", S), ("REASONDESCRIPTION", S))
BRONZE = {"payers": BRONZE_PAYERS, "patients": BRONZE_PATIENTS, "encounters": BRONZE_ENCOUNTERS,
          "procedures": BRONZE_PROCEDURES}

US_STATES = _schema(("StateID", I), ("StateName", S), ("Abbreviation", S))

# ----------------------------------------------------------------------- silver
SILVER_PAYERS = _schema(("payer_key", L), ("payer_id", S), ("payer_name", S), ("payer_address", S),
                        ("payer_city", S), ("state_headquartered", S), ("payer_state", S), ("zip", S),
                        ("phone", S), ("updated_at", TS))
SILVER_PATIENTS = _schema(("patient_key", L), ("patient_id", S), ("birth_date", D), ("death_date", D),
                          ("patient_name", S), ("suffix", S), ("maiden", B), ("marital_status", S), ("race", S),
                          ("ethnicity", S), ("gender", S), ("birth_place", S), ("patient_address", S),
                          ("patient_city", S), ("patient_state", S), ("patient_county", S), ("zip", S),
                          ("lat", GEO), ("lon", GEO), ("updated_at", TS))
SILVER_ENCOUNTERS = _schema(("encounter_key", L), ("encounter_id", S), ("encounter_start", TS),
                            ("encounter_stop", TS), ("date_key", I), ("encounter_duration_min", I),
                            ("patient_key", L), ("patient_age_ed", I), ("organization", S), ("payer_key", L),
                            ("encounterclass", S), ("encounter_code", S), ("encounter_description", S),
                            ("base_encounter_cost", MONEY), ("total_claim_cost", MONEY), ("payer_coverage", MONEY),
                            ("reason_code", S), ("reason_description", S), ("recorded_at", TS))

# ------------------------------------------------------------------------- gold
GOLD_COLUMNS = {
    "dim_payers": ["payer_key", "payer_name", "payer_city", "payer_state"],
    "dim_patients": ["patient_key", "birth_date", "death_date", "patient_name", "suffix", "maiden",
                     "marital_status", "race", "ethnicity", "gender", "patient_city", "patient_state",
                     "patient_county"],
    "fact_encounters": ["encounter_key", "encounter_start", "encounter_stop", "date_key", "encounter_duration_min",
                        "patient_key", "patient_age_ed", "payer_key", "encounterclass", "encounter_code",
                        "encounter_description", "base_encounter_cost", "total_claim_cost", "payer_coverage",
                        "reason_code", "reason_description"],
    "fact_procedures": ["procedure_key", "procedure_start", "procedure_stop", "date_key", "procedure_duration_min",
                        "patient_key", "patient_age_pd", "encounter_key", "procedure_code",
                        "procedure_description", "base_procedure_cost", "reason_code", "reason_description"],
}
DATE_DIM_COLUMNS = ["date_key", "full_date", "calendar_year", "calendar_quarter", "calendar_month", "calendar_day",
                    "day_of_week", "day_name", "is_weekend", "fiscal_year", "fiscal_quarter", "fiscal_month"]
