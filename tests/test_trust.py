"""Incremental validation against full checks, and operators under a collation."""

import pytest
from pyspark.sql import functions as F

from strata.operators import constraints as C
from strata.operators import refint
from strata.operators.collation import BYTES, as_stored, compare_as
from strata.operators.dedupe import duplicate_groups, duplicate_members, first_per_key
from strata.sources.parts import write_measured
from strata.sources.tables import publish, read_layer, read_manifest, unique_version
from strata.sources.trust import forget, validate

TABLE = "silver/facts"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


def append(spark, root, data):
    manifest = read_manifest(spark, root)
    df = spark.createDataFrame(data, "k long, member long, name string")
    part, facts = write_measured(df, root, "silver", "facts", unique_version("p"), ["k"])
    publish(spark, root, manifest.number, {TABLE: [*manifest.tables.get(TABLE, []), part]}, facts)
    return part


@pytest.fixture
def checks(spark):
    members = spark.createDataFrame([(1,), (2,)], "member long")
    return {"rows": lambda df: C.not_null_rules(df, ["name"], "facts"), "widths": lambda df: C.length_rules(df, {"name": 3}, "facts"),
            "member": lambda df: C.fk_rule(df, "member", members, "member", "facts", "FK_member")}


def check(spark, root, checks):
    manifest = read_manifest(spark, root)
    report, facts, read = validate(spark, root, TABLE, checks, "k", manifest)
    publish(spark, root, manifest.number, {}, facts)
    found = {r.rule: (r.violating_rows, r.trusted_parts) for r in report.collect()}
    whole = read_layer(spark, root, "silver", "facts")
    full = [*(make(whole) for make in checks.values()), C.pk_rule(whole, ["k"], "facts", "PK_facts")]
    assert {r.rule: r.violating_rows for f in full for r in f.collect()} == {rule: n for rule, (n, _) in found.items()}
    return found, read


def test_only_new_parts_are_read(spark, tmp_path, checks):
    root = str(tmp_path / "wh")
    first = append(spark, root, [(1, 1, "a"), (2, 9, None), (3, None, "long")])
    assert check(spark, root, checks) == ({"NN_name": (1, 0), "LEN_name": (1, 0), "FK_member": (1, 0), "PK_facts": (0, 0)}, [first])
    second = append(spark, root, [(4, 2, None), (5, 8, "b"), (6, 8, "c")])
    found, read = check(spark, root, checks)
    assert read == [second] and found == {"NN_name": (2, 1), "LEN_name": (1, 1), "FK_member": (3, 1), "PK_facts": (0, 1)}
    assert check(spark, root, checks)[1] == []  # all is trusted


def test_keys_that_may_meet_are_counted_together(spark, tmp_path, checks):
    root = str(tmp_path / "wh")
    parts = [append(spark, root, [(1, 1, "a"), (5, 1, "b"), (5, 1, "c")]), append(spark, root, [(7, 1, "d"), (9, 1, "e")])]
    assert check(spark, root, checks)[0]["PK_facts"] == (2, 0)
    parts.append(append(spark, root, [(5, 2, "x"), (6, 2, "y")]))  # meets the first, not the second
    found, read = check(spark, root, checks)
    assert found["PK_facts"] == (3, 1) and set(read) == {parts[0], parts[2]}
    parts.append(append(spark, root, [(None, 2, "z")]))
    assert check(spark, root, checks)[0]["PK_facts"][0] == 4


def test_a_new_rule_and_lost_trust_read_all_parts(spark, tmp_path, checks):
    root = str(tmp_path / "wh")
    parts = [append(spark, root, [(i, 1, "a")]) for i in range(3)]
    assert check(spark, root, {"rows": checks["rows"]})[1] == parts
    assert check(spark, root, checks)[1] == parts  # rules never checked before
    manifest = read_manifest(spark, root)
    publish(spark, root, manifest.number, {}, forget(manifest, TABLE, "member"))
    found, read = check(spark, root, checks)
    assert read == parts and found["FK_member"] == (0, 0) and found["NN_name"] == (0, 3)
    assert check(spark, root, checks)[1] == []


def test_an_empty_table_has_an_empty_report(spark, tmp_path, checks):
    report, facts, read = validate(spark, str(tmp_path / "wh"), TABLE, checks, "k")
    assert report.count() == 0 and not facts and not read


# ----------------------------------------------------------------- collation
@pytest.fixture
def loose(spark):
    data = [(1, "Ann"), (2, "ann "), (3, "ANN"), (4, "Bob"), (5, " bob"), (6, None), (7, "Éva"), (8, "éva  ")]
    return compare_as(spark.createDataFrame(data, "n int, id string"), "id")


def test_operators_under_a_collation(spark, loose):
    assert rows(first_per_key(loose, ["id"], [("n", "asc")]), "n") == [(1,), (4,), (5,), (6,), (7,)]
    assert sorted(r.n_copies for r in duplicate_groups(loose, ["id"]).collect()) == [2, 3]
    assert rows(loose.where(F.col("id") == "aNN"), "n") == [(1,), (2,), (3,)]
    known = compare_as(spark.createDataFrame([("ANN  ", 10), ("eva", 11), ("ÉVA", 12)], "id string, k int"), "id")
    assert rows(refint.keep_referenced(loose, "id", known, "id"), "n") == [(1,), (2,), (3,), (7,), (8,)]
    assert {r[0] for r in rows(refint.keep_new(loose, known, "id"), "n")} >= {4, 5}
    assert rows(refint.lookup_key(loose, "id", known, "id", "k"), "n", "k") == [(1, 10), (2, 10), (3, 10), (7, 12), (8, 12)]


def test_numbering_under_a_collation(loose):
    got = duplicate_members(loose, ["id"], ["n"], num_partitions=3)
    assert rows(got, "n", "row_in_key") == [(1, 1), (2, 2), (3, 3), (7, 1), (8, 2)]


def test_spellings_stay_apart_within_a_key(spark):
    df = compare_as(spark.createDataFrame([(1, "Ann"), (1, "ANN"), (1, "ANN"), (2, "x")], "n int, id string"), "id")
    assert sorted(str(r.id) for r in duplicate_members(df, ["id"], ["n"]).collect()) == ["ANN", "ANN", "Ann"]


def test_bytes_are_compared_unless_asked(spark, loose):
    plain = as_stored(loose)
    assert plain.schema == spark.createDataFrame([], "n int, id string").schema
    assert first_per_key(plain, ["id"]).count() == 8
    assert rows(plain) == rows(compare_as(plain, collation=BYTES))  # the values stay what they are
