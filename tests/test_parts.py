"""Parts that say what they hold: pruned appends, bucketed upserts, compaction, retention."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import UNGUARDED, upsert_scd1
from strata.sources import tables
from strata.sources.parts import append_new, compact, expire, highest, meeting, upsert_buckets
from strata.sources.tables import publish, read_layer, read_manifest, unique_version

TS1, TS2, TS3 = (dt.datetime(2024, m, 1) for m in (1, 2, 3))
TABLE = "silver/items"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=str)


def frame(spark, data):
    return spark.createDataFrame(data, "id long, name string, seen timestamp_ntz")


def at(day):
    return dt.datetime(2024, 5, 1) + dt.timedelta(days=day)


def append(spark, root, data):
    manifest = read_manifest(spark, root)
    change, read = append_new(spark, root, TABLE, frame(spark, data), "id", "item_key", unique_version("a"), ["seen"], manifest)
    publish(spark, root, manifest.number, change.tables(), change.facts)
    return change, read


# ----------------------------------------------------------------- appends
@pytest.fixture
def appended(spark, tmp_path):
    root = str(tmp_path / "wh")
    for part in range(3):
        append(spark, root, [(i, f"n{i}", at(part)) for i in range(part * 100, part * 100 + 50)])
    return root


def test_parts_know_their_extremes(spark, appended):
    manifest = read_manifest(spark, appended)
    facts = [manifest.facts[f] for f in manifest.tables[TABLE]]
    assert [(f["rows"], f["low"]["id"], f["high"]["id"], f["low"]["item_key"], f["high"]["item_key"]) for f in facts] == [
        (50, 0, 49, 1, 50), (50, 100, 149, 51, 100), (50, 200, 249, 101, 150)]
    assert facts[0]["high"]["seen"] < facts[1]["low"]["seen"]  # times as numbers
    assert highest(manifest, TABLE, "item_key") == 150 and highest(manifest, TABLE, "name") is None


def test_only_parts_with_such_keys_are_read(spark, appended):
    parts = read_manifest(spark, appended).tables[TABLE]
    change, read = append(spark, appended, [(120, "again", at(9)), (160, "new", at(9)), (130, "again", at(9))])
    assert read == [parts[1]] and len(change.written) == 1
    assert rows(read_layer(spark, appended, "silver", "items").where("id in (120, 130, 160)"), "id", "name", "item_key") == [
        (120, "n120", 71), (130, "n130", 81), (160, "new", 151)]
    _, read = append(spark, appended, [(1000, "far", at(9))])
    assert read == []  # a key beyond all of them opens none
    _, read = append(spark, appended, [(0, "wide", at(9)), (249, "wide", at(9))])
    assert len(read) == 4 and read_layer(spark, appended, "silver", "items").count() == 152


def test_appends_with_null_keys_and_empty_batches(spark, appended):
    before = rows(read_layer(spark, appended, "silver", "items"))
    _, read = append(spark, appended, [])
    assert read == [] and rows(read_layer(spark, appended, "silver", "items")) == before
    append(spark, appended, [(None, "nobody", None)])
    assert read_layer(spark, appended, "silver", "items").count() in (150, 151)


def test_a_part_that_was_not_measured_is_always_read(spark, appended):
    manifest = read_manifest(spark, appended)
    first = manifest.tables[TABLE][0]
    del manifest.facts[first]
    assert meeting(manifest, TABLE, "id", 10_000, 10_001) == [first]
    change, read = append_new(spark, appended, TABLE, frame(spark, [(7777, "x", None)]), "id", "item_key", unique_version("a"),
                              manifest=manifest)
    assert read == [first] and change.facts[change.written[0]]["low"]["item_key"] == 151


# ----------------------------------------------------------------- upserts
TRACKED = {"name": "", "seen": UNGUARDED}


def upsert(spark, root, data, stamp, buckets=8):
    manifest = read_manifest(spark, root)
    change = upsert_buckets(spark, root, TABLE, frame(spark, data), "id", TRACKED, "item_key", "stamp", stamp,
                            unique_version("u"), buckets, manifest)
    publish(spark, root, manifest.number, change.tables(), change.facts)
    return change


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "wh")
    first = upsert(spark, root, [(i, f"n{i}", at(0)) for i in range(200)], TS1)
    assert len(first.folders) == 8
    change = upsert(spark, root, [(7, "changed", at(0)), (8, "n8", at(0)), (900, "new", at(1))], TS2)
    assert len(change.written) <= 2 and set(first.folders) - set(change.folders) and len(change.folders) == 8
    assert set(change.folders) & set(first.folders) >= {f for f in first.folders if f not in change.folders or f in change.folders} - (
        set(first.folders) - set(change.folders))
    now = read_layer(spark, root, "silver", "items")
    assert rows(now.where("id in (7, 8, 900)"), "id", "name", "item_key", "stamp") == [
        (7, "changed", 8, TS2), (8, "n8", 9, TS1), (900, "new", 201, TS2)]
    assert now.count() == 201 and now.select("item_key").distinct().count() == 201
    assert upsert(spark, root, [(7, "changed", at(0)), (900, "new", at(1))], TS3).written == []  # nothing new


def test_buckets_give_what_the_whole_upsert_gives(spark, tmp_path):
    root, rnd = str(tmp_path / "wh"), random.Random(3)
    batches = [[(i, rnd.choice(["a", "b", None]), rnd.choice([at(0), at(1), None])) for i in rnd.sample(range(150), n)]
               for n in (90, 70, 5)]
    target = None
    for batch, stamp in zip(batches, (TS1, TS2, TS3)):
        upsert(spark, root, batch, stamp)
        source = frame(spark, batch)
        if target is None:
            target = source.limit(0).withColumns({"item_key": F.lit(0).cast("long"), "stamp": F.lit(None).cast("timestamp_ntz")})
            target = target.select("item_key", "id", "name", "seen", "stamp")
        target = upsert_scd1(target, source, "id", TRACKED, "item_key", "stamp", stamp)
    assert rows(read_layer(spark, root, "silver", "items")) == rows(target)


# ----------------------------------------------------------------- compaction, retention
def test_compaction_keeps_rows_and_both_manifests(spark, appended):
    for part in range(3, 6):
        append(spark, appended, [(i, f"n{i}", at(part)) for i in range(part * 100, part * 100 + 50)])
    append(spark, appended, [(i, "large", at(7)) for i in range(1000, 3000)])
    before = read_manifest(spark, appended)
    want = rows(read_layer(spark, appended, "silver", "items"))
    change = compact(spark, appended, TABLE, unique_version("c"), fan=4, least=100, manifest=before)
    publish(spark, appended, before.number, change.tables(), change.facts)
    after = read_manifest(spark, appended)
    assert len(before.tables[TABLE]) == 7 and len(after.tables[TABLE]) == 2  # six small ones in one; the large one stays
    assert before.tables[TABLE][-1] in after.tables[TABLE]
    assert rows(read_layer(spark, appended, "silver", "items")) == want == rows(
        read_layer(spark, appended, "silver", "items", before.number))
    merged = after.facts[change.written[0]]
    assert (merged["rows"], merged["low"]["id"], merged["high"]["id"]) == (300, 0, 549)
    assert compact(spark, appended, TABLE, unique_version("c"), fan=4, least=100).written == []
    _, read = append(spark, appended, [(20, "again", at(1)), (600, "new", at(1))])
    assert read == [change.written[0]]


def test_compaction_keeps_buckets_apart(spark, tmp_path):
    root = str(tmp_path / "wh")
    upsert(spark, root, [(i, f"n{i}", at(0)) for i in range(40)], TS1, buckets=4)
    assert compact(spark, root, TABLE, unique_version("c"), fan=2, least=1000).written == []


def folders_on_disk(root):
    return {os.path.relpath(os.path.join(root, *p), root) for p in
            (("silver", "items", v) for v in os.listdir(os.path.join(root, "silver", "items")))}


def test_expiry_spares_what_kept_manifests_name(spark, appended):
    change = compact(spark, appended, TABLE, unique_version("c"), fan=3, least=100)
    number = read_manifest(spark, appended).number
    publish(spark, appended, number, change.tables(), change.facts)
    want = rows(read_layer(spark, appended, "silver", "items"))
    assert expire(spark, appended, keep=2, min_age_seconds=0) == [f"_manifests/{n:09d}" for n in range(number)]
    assert rows(read_layer(spark, appended, "silver", "items", number)) == want  # a reader of the one before
    tables.write_part(frame(spark, [(1, "x", None)]), appended, "silver", "items", "on-its-way")
    gone = expire(spark, appended, keep=1)
    assert gone == [f"_manifests/{number:09d}"]  # young folders stay: a load may be about to publish them
    gone = expire(spark, appended, keep=1, min_age_seconds=0)
    assert len([g for g in gone if g.startswith("silver/")]) == 4
    assert folders_on_disk(appended) == set(change.folders) and rows(read_layer(spark, appended, "silver", "items")) == want
    with pytest.raises(ValueError):
        expire(spark, appended, keep=0)


def test_expiry_drops_single_buckets(spark, tmp_path):
    root = str(tmp_path / "wh")
    upsert(spark, root, [(i, f"n{i}", at(0)) for i in range(200)], TS1)
    upsert(spark, root, [(7, "changed", at(0))], TS2)
    want = rows(read_layer(spark, root, "silver", "items"))
    gone = expire(spark, root, keep=1, min_age_seconds=0)
    assert len([g for g in gone if "/bucket=" in g]) == 1 and rows(read_layer(spark, root, "silver", "items")) == want
