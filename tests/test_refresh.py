"""End-to-end refresh over small synthetic CSVs in the raw hospital layout (UTF-8 with
BOM, CRLF), two batches.  Each row below exists to exercise one rule."""

import datetime as dt

import numpy as np
import pytest

from strata.plans.refresh import run_refresh
from strata.sources.tables import read_layer

PAYER_H = "Id,NAME,ADDRESS,CITY,STATE_HEADQUARTERED,ZIP,PHONE"
PATIENT_H = ("Id,BIRTHDATE,DEATHDATE,PREFIX,FIRST,LAST,SUFFIX,MAIDEN,MARITAL,RACE,ETHNICITY,GENDER,BIRTHPLACE,"
             "ADDRESS,CITY,STATE,COUNTY,ZIP,LAT,LON")
ENC_H = ("Id,START,STOP,PATIENT,ORGANIZATION,PAYER,ENCOUNTERCLASS,CODE,DESCRIPTION,BASE_ENCOUNTER_COST,"
         "TOTAL_CLAIM_COST,PAYER_COVERAGE,REASONCODE,REASONDESCRIPTION")
PROC_H = "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,BASE_COST,REASONCODE,REASONDESCRIPTION"


def field(v):
    if v is None:
        return ""
    s = str(v)
    return f'"{s}"' if "," in s else s


def write_csv(path, header, rows, raw_lines=()):
    lines = [header] + [",".join(field(v) for v in r) for r in rows] + list(raw_lines)
    path.write_bytes(b"\xef\xbb\xbf" + "\r\n".join(lines).encode() + b"\r\n")


def payers(batch):
    rows = [
        ("pay-1", "Harbor Plan", "10 Harbor Rd", "Annapolis", "MD", "21401", "1-800-000-0001"),
        ("pay-2", "River Health", "22 Elm Ave", "Lexington", "KY", "40507", "1-800-000-0002"),
        ("pay-2", "River Health Dup", "22 Elm Ave", "Lexington", "KY", "40507", "1-800-000-0002"),
        (" pay-3 ", "Oak Mutual", "5 Oak St", "New Haven", "CT", "6510", "1-800-000-0003"),
        (None, "Ghost", None, None, "MA", None, None),
        ("pay-4", "UNINSURED", None, None, None if batch == 1 else "NY", None, None),
        ("pay-5", "Foreign", "1 Main", "Nowhere", "XX", "1", "2"),
        ("pay-6", "Lake Health, Inc.", "1 Lake Plaza", "Springfield", "IL", "62701", "1-800-000-0006"),
    ]
    return rows


def patients(batch):
    p1 = ("pat-1", "1990-12-31", None, "Mr.", "John", "Smith" if batch == 1 else "Smyth", None, None, "m",
          "white", "nonhispanic", "M", "Boston", "1 Elm St", "north andover", "massachusetts", "essex county",
          "01810", "42.100000", "-71.100000")
    p2 = ("pat-2", "1985-06-15", None, None, "Ann", "Lee", "Jr.", "Lee", "S", "", "hispanic", "f", "Quincy",
          "2 Oak St", "boston", "massachusetts", "suffolk county", "02101", "42.3", "-71.0")
    p2_dup = ("pat-2", "1985-06-15", None, None, "Anne", "Lee", "Jr.", "Lee", "S", "", "hispanic", "f", "Quincy",
              "2 Oak St", "boston", "massachusetts", "suffolk county", "02101", "42.3", "-71.0")
    p3 = ("pat-3", None, None, "Mrs.", None, "Doe", None, None, "D", "black", "", "F", "Lynn", "3 Pine St", "",
          "massachusetts", None, "01901", None, None)
    p4 = ("pat-4", "2000-01-01", None, "Ms.", "Zoe", "Kim", None, None, "S", "asian", "nonhispanic", "F", "Salem",
          "4 Ash St", "salem", "massachusetts", "essex county", "01970", "42.5", "-70.9")
    no_id = (None, "1970-01-01", None, "Mr.", "No", "Id", None, None, "M", "white", "x", "M", "x", "x", "x", "x",
             "x", "x", None, None)
    return [p1, p2, p2_dup, p3, no_id] if batch == 1 else [p1, p2, p4]


def encounters(batch):
    e = [
        ("enc-1", "2021-01-01T10:00:59Z", "2021-01-01T10:01:00Z", "pat-1", "org-1", "pay-1", "ambulatory", "C1",
         "Checkup (procedure)", "100.00", "200.00", "150.00", None, None),
        ("enc-2", "2020-09-30T08:00:00Z", "2020-09-30T07:00:00Z", "pat-1", "org-1", "pay-2", " ", "C1", "Checkup",
         "0.00", "-5.00", "0.00", "R1", "Reason one"),
        ("enc-3", "2020-10-01T00:00:00Z", "2020-10-01T00:00:00Z", "pat-2", "org-1", "pay-3", "EMERGENCY", "C2",
         "bbb", None, "50.00", "80.00", None, None),
        ("enc-4", "2020-02-29T12:00:00Z", "2020-03-30T12:00:00Z", "pat-2", "org-1", None, "inpatient", "C2", "aaa",
         "10.00", "10.00", "10.00", None, None),
        ("enc-5", "2021-01-02T09:00:00Z", "2021-01-02T09:30:00Z", "pat-3", "org-1", "pay-4", "wellness", "C3", None,
         "10.00", "10.00", "5.00", None, None),
        ("enc-6", "2021-01-03T09:00:00Z", "2021-01-03T09:45:00Z", "pat-3", "org-1", "pay-1", "wellness", "C3", "zzz",
         "10.00", "10.00", "5.00", None, None),
        ("enc-7", "2021-01-04T09:00:00Z", "2021-01-04T09:10:00Z", "pat-99", "org-1", "pay-1", "urgentcare", "C1",
         "Checkup", "10.00", "10.00", "5.00", None, None),
        ("enc-8", "2021-02-01T09:00:00Z", "2021-02-01T09:20:00Z", "pat-1", "org-1", "pay-1", "outpatient", None,
         "no code", "10.00", "10.00", "5.00", None, None),
        ("enc-1", "2021-01-01T10:00:59Z", "2021-01-01T10:01:00Z", "pat-1", "org-1", "pay-1", "ambulatory", "C1",
         "Checkup (procedure)", "100.00", "200.00", "150.00", None, None),
        (None, "2021-03-01T09:00:00Z", "2021-03-01T09:15:00Z", "pat-1", "org-1", "pay-1", "ambulatory", "C1",
         "Checkup", "10.00", "10.00", "5.00", None, None),
    ]
    if batch == 2:
        e = [r for r in e if r[0] == "enc-1"][:1]
        e[0] = e[0][:9] + ("999.00", "999.00", "999.00") + e[0][12:]
        e.append(("enc-9", "2021-05-01T09:00:00Z", "2021-05-01T10:00:00Z", "pat-4", "org-1", "pay-1", "ambulatory",
                  "C1", "Checkup", "10.00", "20.00", "5.00", None, None))
    return e


def procedures(batch):
    return [
        ("2021-01-01T10:00:59Z", "2021-01-01T10:30:00Z", "pat-1", "enc-1", "P1", "Injection", "50", None, None),
        ("2021-01-01T10:00:59Z", "2021-01-01T10:45:00Z", "pat-1", "enc-1", "P1", "Injection", "60", None, None),
        ("2021-01-01T11:00:00Z", "2021-01-01T11:05:00Z", "pat-1", "enc-404", "P1", "Injection", "50", None, None),
        ("2020-10-01T00:00:00Z", "2020-10-01T00:20:00Z", "pat-2", "enc-3", "P2", "X-ray of chest (procedure)", "0",
         "R2", "Reason"),
        ("2020-10-01T01:00:00Z", "2020-10-01T00:50:00Z", "pat-2", "enc-3", "P2", "X-ray", "-3", None, None),
    ]


def write_batch(d, batch):
    d.mkdir(parents=True, exist_ok=True)
    write_csv(d / "payers.csv", PAYER_H, payers(batch))
    write_csv(d / "patients.csv", PATIENT_H, patients(batch))
    write_csv(d / "encounters.csv", ENC_H, encounters(batch),
              raw_lines=["enc-x,2021-01-01T10:00:00Z,2021-01-01T10:05:00Z,pat-1,org-1,pay-1,a,C1,d,1,1,1,,,EXTRA"])
    write_csv(d / "procedures.csv", PROC_H, procedures(batch))


TS1, TS2 = dt.datetime(2024, 1, 1, 4, 0), dt.datetime(2024, 1, 2, 4, 0)


def minutes(a, b):
    fa = dt.datetime.fromisoformat(a.rstrip("Z")).replace(second=0)
    fb = dt.datetime.fromisoformat(b.rstrip("Z")).replace(second=0)
    return int((fb - fa).total_seconds() // 60)


def expected_limit(rows, start_i, stop_i):
    durs = [minutes(r[start_i], r[stop_i]) for r in rows]
    q1, q3 = np.percentile(durs, [25, 75])
    return int(np.ceil(q3 + 1.5 * (q3 - q1)))


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("refresh")
    write_batch(base / "src1", 1)
    write_batch(base / "src2", 2)
    root = str(base / "warehouse")
    first = run_refresh(spark, str(base / "src1"), root, TS1, version="b1")
    snap1 = {n: {tuple(r) for r in df.collect()} for n, df in first["silver"].items()}
    second = run_refresh(spark, str(base / "src2"), root, TS2, version="b2")
    return spark, root, first, snap1, second


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_bronze_rejects_and_quotes(refreshed):
    spark, root, first, _, _ = refreshed
    audit = {(r.layer, r.table_name): r for r in first["audit"].collect()}
    assert audit[("bronze", "encounters")].rows_rejected == 1
    assert audit[("bronze", "encounters")].rows_out == 10
    names = {r.NAME for r in first["bronze"]["payers"].collect()}
    assert "Lake Health, Inc." in names


def test_silver_payers(refreshed):
    _, _, first, _, _ = refreshed
    p = by(first["silver"]["payers"], "payer_id")
    assert p["0000"].payer_key == 0 and p["0000"].payer_name == "No Payer / Self-Pay"
    assert p["pay-3"].payer_name == "Oak Mutual"                  # trimmed id
    assert p["pay-2"].payer_name == "River Health"                 # duplicate id removed
    assert p["pay-1"].payer_state == "Maryland"
    assert "pay-5" not in p                                  # state outside the 50, never used
    assert p["pay-4"].payer_name == "Unknown Payer / Auto-Generated"   # blank state, used by enc-5
    assert None not in p
    keys = sorted(r.payer_key for r in first["silver"]["payers"].collect())
    assert keys == list(range(0, len(keys)))


def test_silver_patients(refreshed):
    _, _, first, _, _ = refreshed
    p = by(first["silver"]["patients"], "patient_id")
    assert set(p) == {"pat-1", "pat-2", "pat-3"}
    assert p["pat-1"].patient_name == "Mr. John Smith" and p["pat-1"].marital_status == "Married"
    assert p["pat-1"].patient_city == "North andover" and p["pat-1"].suffix == "Unknown"
    assert p["pat-1"].maiden is False and p["pat-2"].maiden is True
    assert p["pat-2"].patient_name == "Ann Lee" and p["pat-2"].race == "Unknown" and p["pat-2"].gender == "Female"
    assert p["pat-3"].patient_name == "Mrs.  Doe" and p["pat-3"].marital_status == "Unknown"
    assert p["pat-3"].patient_city is None and p["pat-3"].birth_date is None


def test_silver_encounters(refreshed):
    _, _, first, _, _ = refreshed
    e = by(first["silver"]["encounters"], "encounter_id")
    assert set(e) == {"enc-1", "enc-2", "enc-3", "enc-4", "enc-5", "enc-6"}    # enc-7 unknown patient, enc-8 NULL code
    limit = expected_limit([r for r in encounters(1)], 1, 2)
    assert e["enc-1"].encounter_duration_min == 1                              # 10:00:59 -> 10:01:00
    assert e["enc-2"].encounter_duration_min == 1                              # stop before start
    assert e["enc-3"].encounter_duration_min == 0                              # zero kept
    assert e["enc-4"].encounter_duration_min == min(limit, 43200)              # capped
    assert e["enc-1"].patient_age_ed == 31                                     # 31 Dec -> 1 Jan counts a year
    assert e["enc-2"].encounterclass == "Unknown" and e["enc-3"].encounterclass == "Emergency"
    assert (float(e["enc-2"].base_encounter_cost), float(e["enc-2"].total_claim_cost),
            float(e["enc-2"].payer_coverage)) == (1.0, 1.0, 1.0)
    assert e["enc-3"].base_encounter_cost is None and float(e["enc-3"].payer_coverage) == 50.0
    assert e["enc-4"].payer_key == 0                                           # NULL payer -> placeholder
    assert e["enc-1"].encounter_description == "Checkup"                       # shortest description
    assert e["enc-3"].encounter_description == "aaa"                           # equal length: text order
    assert e["enc-6"].encounter_description is None                            # NULL description wins
    assert e["enc-2"].reason_code == "R1" and e["enc-1"].reason_code == "Unknown"
    assert e["enc-1"].date_key == 20210101


def test_silver_procedures(refreshed):
    _, _, first, _, _ = refreshed
    rows = first["silver"]["procedures"].orderBy("procedure_key").collect()
    assert [r.procedure_key for r in rows] == [1, 2, 3]
    p1 = [r for r in rows if r.procedure_code == "P1"]
    assert len(p1) == 1 and p1[0].procedure_stop == dt.datetime(2021, 1, 1, 10, 45)   # latest STOP kept
    p2 = [r for r in rows if r.procedure_code == "P2"]
    assert {r.procedure_description for r in p2} == {"X-ray"}
    assert sorted(r.base_procedure_cost for r in p2) == [1, 1]
    assert sorted(r.procedure_duration_min for r in p2) == [1, 20]


def test_gold_and_views(refreshed):
    spark, root, first, _, _ = refreshed
    assert all(r.ok for r in first["report"].collect())
    assert set(first["views"]) >= {"vw_dim_payers", "vw_fact_encounters", "vw_dim_procedure_date"}
    d = spark.table("vw_dim_encounter_date")
    assert d.filter("date_key = 20200229").count() == 1
    assert d.count() == 366 + 365                      # 2020-01-01 .. 2021-12-31
    assert "payer_id" not in spark.table("vw_dim_payers").columns


def test_second_batch(refreshed):
    spark, root, first, snap1, second = refreshed
    p1 = by(first["silver"]["patients"], "patient_id")
    p2 = by(second["silver"]["patients"], "patient_id")
    assert p2["pat-1"].patient_key == p1["pat-1"].patient_key and p2["pat-1"].updated_at == TS2
    assert p2["pat-1"].patient_name == "Mr. John Smyth"
    assert p2["pat-2"].updated_at == TS1                                    # unchanged keeps its stamp
    assert "pat-3" in p2                                                    # absent: kept
    assert p2["pat-4"].patient_key == max(r.patient_key for r in p1.values()) + 1
    e1 = by(first["silver"]["encounters"], "encounter_id")
    e2 = by(second["silver"]["encounters"], "encounter_id")
    assert float(e2["enc-1"].total_claim_cost) == 200.0                     # never updated
    assert e2["enc-9"].encounter_key == max(r.encounter_key for r in e1.values()) + 1
    assert {k: v.encounter_key for k, v in e1.items()} == {k: e2[k].encounter_key for k in e1}
    y1, y2 = by(first["silver"]["payers"], "payer_id"), by(second["silver"]["payers"], "payer_id")
    assert y2["pay-4"].payer_key == y1["pay-4"].payer_key and y2["pay-4"].payer_name == "UNINSURED"
    assert read_layer(spark, root, "silver", "patients").count() == 4       # published pointer moved


def test_gold_questions(refreshed):
    from strata.plans.questions import gold_questions

    spark, root, first, _, _ = refreshed
    answers = {k: df.collect() for k, df in gold_questions(first["gold"], first["bronze"]["encounters"]).items()}
    assert len(answers) == 10
    per_year = {r.calendar_year: r.n_encounters for r in answers["q01_per_year"]}
    assert per_year == {2020: 3, 2021: 3}
    assert answers["q04_zero_coverage"][0].n_zero == 1          # enc-2 in bronze, before the floor to 1
    q7 = {r.payer_key: r.n_encounters for r in answers["q07_claim_by_payer"]}
    assert q7[0] == 1                                           # the NULL-payer encounter, key 0
    assert sum(r.n_encounters for r in answers["q02_class_share"]) == 6
