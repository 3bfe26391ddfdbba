"""Publishing: reruns, failures on the way, lost manifests, appended parts, lasting views."""

import datetime as dt
import os
import shutil

import pytest

from strata import cli
from strata.operators.constraints import ConstraintViolation, length_rules, not_null_rules, unique_rule
from strata.operators.sequence import next_in_key, running_max_before
from strata.plans import gold, refresh
from strata.plans.refresh import run_refresh
from strata.sources import tables
from strata.sources.csv_bronze import LoadRejected
from strata.sources.tables import LostManifest, StaleManifest
from test_refresh import TS1, TS2, write_batch


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("warehouse")
    write_batch(base / "src1", 1)
    write_batch(base / "src2", 2)
    run_refresh(spark, str(base / "src1"), str(base / "wh"), TS1)
    return base


def silver(spark, root, name="patients"):
    return {tuple(r) for r in tables.read_layer(spark, root, "silver", name).collect()}


def copy(loaded, name):
    return str(shutil.copytree(loaded / "wh", loaded / name))


def test_same_stamp_again_changes_nothing(spark, loaded):
    root = copy(loaded, "again")
    before = {n: silver(spark, root, n) for n in ("payers", "patients", "encounters", "procedures")}
    run_refresh(spark, str(loaded / "src1"), root, TS1)
    assert {n: silver(spark, root, n) for n in before} == before
    loads = tables.read_layer(spark, root, "audit", "loads").collect()
    assert len([r for r in loads if r.table_name == "encounters" and r.layer == "silver"]) == 2
    assert all(r.rows_in is not None for r in loads)


def test_failure_on_the_way_leaves_the_published_tables(spark, loaded, monkeypatch):
    root = copy(loaded, "failing")
    before, listed = silver(spark, root), tables.current_tables(spark, root)

    def broken(*_):
        raise RuntimeError("lost on the way")

    with monkeypatch.context() as m:
        m.setattr(refresh, "gold_tables", broken)
        with pytest.raises(RuntimeError, match="lost on the way"):
            run_refresh(spark, str(loaded / "src2"), root, TS2)
    assert tables.current_tables(spark, root) == listed and silver(spark, root) == before
    run_refresh(spark, str(loaded / "src2"), root, TS2)  # the retry
    assert {r[1] for r in silver(spark, root)} == {"pat-1", "pat-2", "pat-3", "pat-4"}


def test_lost_manifests_raise(spark, loaded):
    root = copy(loaded, "lost")
    shutil.rmtree(os.path.join(root, "_manifests"))
    with pytest.raises(LostManifest):
        run_refresh(spark, str(loaded / "src2"), root, TS2)
    with pytest.raises(LostManifest):
        tables.read_layer(spark, root, "silver", "patients")


def test_new_encounters_are_a_part_more(spark, loaded):
    root = copy(loaded, "append")
    first = tables.current_tables(spark, root)["silver/encounters"]
    before = silver(spark, root, "encounters")
    run_refresh(spark, str(loaded / "src2"), root, TS2)
    parts = tables.current_tables(spark, root)["silver/encounters"]
    assert parts[:-1] == first and before < silver(spark, root, "encounters")
    assert spark.read.parquet(f"{root}/{parts[-1]}").count() == 1


def test_two_refreshes_at_once(spark, tmp_path):
    root = str(tmp_path / "race")
    number = tables.open_warehouse(spark, root)
    tables.publish(spark, root, number, {"a/b": ["a/b/v=1"]})
    with pytest.raises(StaleManifest):
        tables.publish(spark, root, number, {"a/b": ["a/b/v=2"]})
    assert tables.current_tables(spark, root) == {"a/b": ["a/b/v=1"]}


def test_parts_are_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    tables.write_part(df, str(tmp_path), "x", "y", "1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        tables.write_part(df, str(tmp_path), "x", "y", "1")


def test_views_in_a_later_session(spark, loaded):
    later = spark.newSession()
    assert "vw_fact_encounters" in tables.open_views(later, str(loaded / "wh"))
    assert later.table("vw_fact_encounters").count() == 6


def test_all_rows_are_printed(spark, capsys):
    cli.print_rows("title", spark.range(45).orderBy("id"))
    assert capsys.readouterr().out.split() == ["title", "id", *map(str, range(45))]


def test_questions_are_written_in_full(spark, loaded, capsys):
    assert cli.main(["questions", "--root", str(loaded / "wh")]) == 0
    out = capsys.readouterr().out
    assert "q10_most_readmissions" in out and os.path.isdir(loaded / "wh" / "answers" / "q02_class_share")


@pytest.mark.parametrize("target_rows", [1, 2, 1000])
def test_null_keys_and_equal_instants(spark, target_rows):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [(None, at(1), 1, 5), (None, at(9), 2, None), (None, dt.datetime(2024, 3, 1), 3, 7), ("a", at(3), 4, 1), ("a", at(3), 5, None),
            ("a", at(3), 6, 2), ("a", None, 7, 3), ("b", at(4), 8, 9)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int, v int")
    df.createOrReplaceTempView("seq")
    got = next_in_key(df, "k", ["ts", "id"], "v", "out", target_rows=target_rows)
    want = spark.sql("SELECT *, lead(v) OVER (PARTITION BY k ORDER BY ts, id) AS out FROM seq")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    got = running_max_before(df, "k", ["ts", "id"], "v", "out", target_rows=target_rows)
    want = spark.sql("SELECT *, max(v) OVER (PARTITION BY k ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
                     "AS out FROM seq")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_too_many_rejected_rows_end_the_load(spark, loaded):
    root, src = copy(loaded, "broken"), loaded / "src-broken"
    shutil.copytree(loaded / "src2", src)
    with open(src / "procedures.csv", "ab") as out:
        out.write(b"not,a,row,of,this,file,at,all,x,y,z\r\n" * 12)
    listed = tables.current_tables(spark, root)
    with pytest.raises(LoadRejected, match=r"procedures.csv: 1\d of \d+ rows rejected, 10 allowed"):
        run_refresh(spark, str(src), root, TS2)
    assert tables.current_tables(spark, root) == listed
    run_refresh(spark, str(src), root, TS2, max_errors=20)
    assert tables.current_tables(spark, root) != listed


def test_only_changed_buckets_of_patients_are_written(spark, loaded):
    root = copy(loaded, "buckets")
    first = tables.current_tables(spark, root)["silver/patients"]
    run_refresh(spark, str(loaded / "src2"), root, TS2)
    then = tables.current_tables(spark, root)["silver/patients"]
    assert set(first) & set(then) and set(first) - set(then) and all("/bucket=" in f for f in then)
    assert {r[1]: r[0] for r in silver(spark, root)} == {"pat-1": 1, "pat-2": 2, "pat-3": 3, "pat-4": 4}


def test_gold_encounters_grow_and_only_the_new_part_is_checked(spark, loaded):
    root = copy(loaded, "growing")
    first = tables.read_manifest(spark, root)
    out = run_refresh(spark, str(loaded / "src2"), root, TS2)
    now = tables.read_manifest(spark, root)
    assert now.tables["gold/fact_encounters"][:-1] == first.tables["gold/fact_encounters"]
    assert all("PK_fact_encounters" in now.facts[f]["checks"] for f in now.tables["gold/fact_encounters"])
    report = {r.rule: r for r in out["report"].collect()}
    for rule in ("FK_encounters_patient", "NN_encounter_start", "LEN_reason_code", "PK_fact_encounters"):
        assert (report[rule].ok, report[rule].n_parts, report[rule].trusted_parts) == (True, 2, 1)
    assert report["FK_procedures_patient"].n_parts is None  # a table written as a whole is checked as a whole
    facts, whole = tables.read_layer(spark, root, "gold", "fact_encounters"), tables.read_layer(spark, root, "silver", "encounters")
    assert sorted(map(tuple, facts.collect()), key=str) == sorted(map(tuple, whole.select(*facts.columns).collect()), key=str)


def test_a_broken_rule_of_new_encounters_publishes_nothing(spark, loaded, monkeypatch):
    root = copy(loaded, "rule")
    listed = tables.current_tables(spark, root)
    with monkeypatch.context() as m:
        m.setitem(gold.WIDTHS, "fact_encounters", {"encounter_code": 0})
        with pytest.raises(ConstraintViolation, match="fact_encounters.LEN_encounter_code: 1"):
            run_refresh(spark, str(loaded / "src2"), root, TS2)  # the first part is trusted, the new one has one row
    assert tables.current_tables(spark, root) == listed


def test_maintenance_between_refreshes(spark, loaded):
    """Compaction changes no row; views of an older manifest's reader last as long as it is kept; answers stay."""
    root = copy(loaded, "maintained")
    for batch in (2, 2, 2):
        run_refresh(spark, str(loaded / f"src{batch}"), root, TS2)
    os.makedirs(os.path.join(root, "answers", "q01", "v=1"))
    want = {n: silver(spark, root, n) for n in ("payers", "patients", "encounters", "procedures")}
    number = tables.open_warehouse(spark, root)
    done = refresh.maintain(spark, root, keep=2, min_age_seconds=0)
    assert len([f for f in done["written"] if f.startswith("silver/encounters")]) == 1 and done["removed"]
    assert {n: silver(spark, root, n) for n in want} == want and os.path.isdir(os.path.join(root, "answers", "q01", "v=1"))
    assert {tuple(r) for r in tables.read_layer(spark, root, "silver", "encounters", number).collect()} == want["encounters"]
    assert len(tables.current_tables(spark, root)["silver/encounters"]) == 1
    run_refresh(spark, str(loaded / "src2"), root, TS2)
    assert silver(spark, root, "encounters") == want["encounters"]


def test_views_of_the_catalog_outlive_the_session(spark, loaded):
    root = copy(loaded, "catalog")
    run_refresh(spark, str(loaded / "src2"), root, TS2, database="strata_lasting")
    later = spark.newSession()  # knows nothing of the warehouse's folders
    assert later.table("strata_lasting.vw_fact_encounters").count() == 7
    assert later.sql("SELECT count(*) FROM strata_lasting.vw_dim_patients").first()[0] == len(silver(spark, root))
    later.sql("DROP DATABASE strata_lasting CASCADE")


def test_load_times_are_in_the_audit(spark, loaded):
    loads = tables.read_layer(spark, str(loaded / "wh"), "audit", "loads").collect()
    assert all(r.seconds >= 0 for r in loads)
    for layer in ("bronze", "silver", "gold"):
        of = [r for r in loads if r.layer == layer]
        whole, = [r for r in of if r.table_name is None]
        assert whole.seconds == pytest.approx(sum(r.seconds for r in of if r.table_name))
        assert whole.rows_out == sum(r.rows_out for r in of if r.table_name)


def test_column_rules(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "long")], "k int, t string")
    counts = {r.rule: r.violating_rows for rule in (not_null_rules(df, ["k", "t"], "x"), length_rules(df, {"t": 3}, "x"),
                                                    unique_rule(df, ["k"], "x", "UQ")) for r in rule.collect()}
    assert counts == {"NN_k": 0, "NN_t": 1, "LEN_t": 1, "UQ": 2}
