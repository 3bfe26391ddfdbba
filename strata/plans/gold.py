"""Gold star schema: narrowed dimensions and facts, two role-playing date dimensions,
and the constraint report that must pass before the layer is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from strata import schemas
from strata.operators import constraints as C
from strata.operators.calendar import date_dimension
from strata.sources.trust import Checks

# The columns declared NOT NULL and the declared widths of texts.
DATE_PARTS = ["full_date", "calendar_year", "calendar_quarter", "calendar_month", "calendar_day", "day_of_week",
              "day_name", "is_weekend", "fiscal_year", "fiscal_quarter", "fiscal_month"]
NOT_NULL = {
    "dim_encounter_date": DATE_PARTS,
    "fact_encounters": ["encounter_start", "encounter_stop", "patient_key", "payer_key"],
    "dim_procedure_date": DATE_PARTS,
}
WIDTHS = {
    "dim_encounter_date": {"day_name": 10},
    "fact_encounters": {"encounterclass": 50, "encounter_code": 20, "encounter_description": 255, "reason_code": 20,
                        "reason_description": 255},
}


def gold_tables(silver: Mapping[str, DataFrame], names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The gold tables, or those of them that are asked for."""
    cols = schemas.GOLD_COLUMNS
    make = {
        "dim_payers": lambda: silver["payers"].select(*cols["dim_payers"]),
        "dim_patients": lambda: silver["patients"].select(*cols["dim_patients"]),
        "dim_encounter_date": lambda: date_dimension(silver["encounters"], "encounter_start"),
        "fact_encounters": lambda: silver["encounters"].select(*cols["fact_encounters"]),
        "dim_procedure_date": lambda: date_dimension(silver["procedures"], "procedure_start"),
        "fact_procedures": lambda: silver["procedures"].select(*cols["fact_procedures"]),
    }
    return {name: make[name]() for name in names or make}


def _encounter_keys(g: Mapping[str, DataFrame], facts: DataFrame) -> list[DataFrame]:
    return [C.fk_rule(facts, fk, g[dim], fk, "fact_encounters", f"FK_encounters_{name}")
            for fk, dim, name in (("date_key", "dim_encounter_date", "date"), ("patient_key", "dim_patients", "patient"),
                                  ("payer_key", "dim_payers", "payer"))]


def gold_constraint_report(gold: Mapping[str, DataFrame], without: Sequence[str] = ()) -> DataFrame:
    """Six foreign keys (the procedure date points at the procedure date dimension),
    the primary keys, the NOT NULL columns and the declared widths.  The rules of the tables
    ``without`` are left out (``encounter_checks`` has those of the encounters)."""
    g = gold
    rules = []
    if "fact_encounters" not in without:
        rules += _encounter_keys(g, g["fact_encounters"])
    rules += [
        C.fk_rule(g["fact_procedures"], "date_key", g["dim_procedure_date"], "date_key", "fact_procedures",
                  "FK_procedures_date"),
        C.fk_rule(g["fact_procedures"], "patient_key", g["dim_patients"], "patient_key", "fact_procedures",
                  "FK_procedures_patient"),
        C.fk_rule(g["fact_procedures"], "encounter_key", g["fact_encounters"], "encounter_key", "fact_procedures",
                  "FK_procedures_encounter"),
    ]
    keys = [("dim_payers", "payer_key"), ("dim_patients", "patient_key"), ("dim_encounter_date", "date_key"),
            ("fact_encounters", "encounter_key"), ("dim_procedure_date", "date_key"), ("fact_procedures", "procedure_key")]
    rules += [C.pk_rule(g[name], [key], name, f"PK_{name}") for name, key in keys if name not in without]
    rules += [C.not_null_rules(g[name], columns, name) for name, columns in NOT_NULL.items() if name not in without]
    rules += [C.length_rules(g[name], limits, name) for name, limits in WIDTHS.items() if name not in without]
    return C.constraint_report(rules)


def encounter_checks(gold: Mapping[str, DataFrame]) -> Checks:
    """The encounters' rules but the primary key, for validation part by part: their dimensions never lose members."""
    name = "fact_encounters"
    return {"FK_encounters": lambda part: C.constraint_report(_encounter_keys(gold, part)),
            "NOT NULL": lambda part: C.not_null_rules(part, NOT_NULL[name], name),
            "LENGTH": lambda part: C.length_rules(part, WIDTHS[name], name)}
