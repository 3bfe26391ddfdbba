"""Operators on hand-written rows: semantics, traps, invariants."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import canonical, constraints, refint
from strata.operators.calendar import date_dimension
from strata.operators.dedupe import duplicate_groups, duplicate_members, first_per_key
from strata.operators.keys import assign_keys, next_key_start
from strata.operators.merge import (UNGUARDED, ensure_placeholder, incremental_insert, infer_missing_members,
                                    upsert_scd1)
from strata.operators.outliers import cap_outliers, iqr_bounds, order_statistics
from strata.operators.quality import key_violations, longest, null_counts
from strata.operators.sequence import adaptive_buckets, next_in_key, running_max_before
from strata.operators.slices import order_slices, running_in_key


def _key(t):
    return tuple((0, 0) if x is None else (1, x) for x in t)


def srt(items):
    return sorted(items, key=_key)


def rows(df, *cols):
    return srt(tuple(r) for r in (df.select(*cols) if cols else df).collect())


# ------------------------------------------------------------------ dedupe
def test_first_per_key_total_order(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("a", 1, "x"), ("b", None, "q"), ("b", 5, "p"),
                                (None, 1, "n")], "id string, v int, s string")
    assert rows(first_per_key(df, ["id"])) == [(None, 1, "n"), ("a", 1, "x"), ("b", None, "q")]
    latest = first_per_key(df, ["id"], [("v", "desc")])
    assert rows(latest) == [(None, 1, "n"), ("a", 2, "y"), ("b", 5, "p")]


def test_first_per_key_plans_partial_limit(spark):
    df = spark.createDataFrame([("a", 1)], "id string, v int")
    plan = first_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_duplicate_groups(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "k int, s string")
    assert rows(duplicate_groups(df, ["k", "s"])) == [(1, "a", 2)]


# --------------------------------------------------------------- canonical
def test_canonical_description_rules(spark):
    df = spark.createDataFrame([
        ("c1", "long description"), ("c1", "short"), ("c1", "short"),
        ("c2", "bbb"), ("c2", "aaa"),              # equal length: text breaks the tie
        ("c3", "abcd  "), ("c3", "abc"),            # trailing blanks ignored: 4 vs 3
        ("c4", "x"), ("c4", None),                  # NULL sorts first and wins
        (None, "orphan"),
    ], "code string, d string")
    got = dict(rows(canonical.canonical_description(df, "code", "d")))
    assert got == {"c1": "short", "c2": "aaa", "c3": "abc", "c4": None, None: "orphan"}


def test_ambiguous_codes(spark):
    df = spark.createDataFrame([("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "a"), ("c3", None), ("c3", "z"),
                                (None, "q"), (None, "r")], "code string, d string")
    got = rows(canonical.ambiguous_codes(df, "code", "d"))
    assert got == srt([("c1", "a"), ("c1", "b"), ("c3", None), ("c3", "z")])


# ------------------------------------------------------------------ refint
def test_semi_anti_and_null_aware(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (None,)], "fk int")
    dims = spark.createDataFrame([(1,), (2,)], "pk int")
    dims_null = spark.createDataFrame([(1,), (None,)], "pk int")
    empty = spark.createDataFrame([], "pk int")
    assert rows(refint.keep_referenced(facts, "fk", dims, "pk")) == [(1,), (2,)]
    assert rows(refint.keep_new(facts, dims, "fk", "pk"), "fk") == srt([(3,), (None,)])
    # NOT IN: one NULL on the right empties the result; empty right keeps all rows
    assert refint.not_in(facts, F.col("fk"), dims_null, "pk").count() == 0
    assert rows(refint.not_in(facts, F.col("fk"), dims, "pk")) == [(3,)]
    assert refint.not_in(facts, F.col("fk"), empty, "pk").count() == 4
    assert rows(refint.orphan_keys(facts, "fk", dims, "pk")) == [(3,)]
    assert refint.orphan_keys(facts, "fk", dims_null, "pk", null_aware=True).count() == 0


def test_not_in_anti_join_is_an_equi_join(spark):
    # the anti join itself is hashed or sort-merged; only the one-row NULL/count
    # statistic is paired with every row (a bounded broadcast)
    facts = spark.createDataFrame([(1,)], "fk int")
    dims = spark.createDataFrame([(1,)], "pk int")
    plan = refint.not_in(facts, F.col("fk"), dims, "pk")._jdf.queryExecution().executedPlan().toString()
    anti = [line for line in plan.splitlines() if "LeftAnti" in line]
    assert anti and all("NestedLoop" not in line for line in anti)


# -------------------------------------------------------------------- keys
def test_assign_keys_contiguous_ordered(spark):
    ids = list(range(0, 3000, 3))
    random.Random(7).shuffle(ids)
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string").repartition(5)
    keyed = assign_keys(df, ["id"], "k", num_partitions=7).collect()
    by_id = sorted((r.id, r.k) for r in keyed)
    assert [k for _, k in by_id] == list(range(1, len(ids) + 1))
    start = next_key_start(spark.createDataFrame([(41,), (7,)], "k long"), "k")
    keyed2 = assign_keys(df, ["id"], "k", start=start, num_partitions=3)
    assert sorted(r.k for r in keyed2.collect()) == list(range(42, 42 + len(ids)))


def test_assign_keys_stable_across_actions(spark):
    # every action reads the one checkpointed copy, so the numbering cannot drift
    df = spark.createDataFrame([(i * 7 % 1000, f"n{i}") for i in range(1000)], "id int, name string")
    keyed = assign_keys(df.repartition(6), ["id"], "k", num_partitions=5)
    first = sorted((r.id, r.k) for r in keyed.collect())
    again = sorted((r.id, r.k) for r in keyed.filter("k > 0").collect())
    assert first == again


def test_assign_keys_with_ties_unique(spark):
    df = spark.createDataFrame([(i % 4,) for i in range(40)], "g int")
    ks = sorted(r.k for r in assign_keys(df, ["g"], "k", num_partitions=3).collect())
    assert ks == list(range(1, 41))


# ------------------------------------------------------------------- merge
TS1, TS2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _target(spark):
    return spark.createDataFrame([(1, "a", "Ann", None, TS1), (2, "b", "Bob", "x", TS1), (3, "c", "Cy", "y", TS1)],
                                 "k int, id string, name string, city string, updated_at timestamp_ntz")


def test_scd1_upsert(spark):
    target = _target(spark)
    source = spark.createDataFrame([("a", "Ann", ""), ("b", "Bobby", "x"), ("d", "Dee", "z"), ("e", "Eve", None)],
                                   "id string, name string, city string")
    tracked = {"name": UNGUARDED, "city": ""}
    out = upsert_scd1(target, source, "id", tracked, "k", "updated_at", TS2)
    got = rows(out, "k", "id", "name", "city", "updated_at")
    assert got == [
        (1, "a", "Ann", None, TS1),      # NULL city vs '' is no change under the sentinel
        (2, "b", "Bobby", "x", TS2),     # changed: restamped, key kept
        (3, "c", "Cy", "y", TS1),        # absent from the source: kept
        (4, "d", "Dee", "z", TS2),       # new: keys continue after max in natural-key order
        (5, "e", "Eve", None, TS2)]
    assert out.schema["k"].dataType.simpleString() == "int"
    again = upsert_scd1(out, source, "id", tracked, "k", "updated_at", dt.datetime(2024, 3, 1))
    assert rows(again, "k", "id", "name", "city", "updated_at") == got  # idempotent


def test_scd1_unguarded_null_is_no_change(spark):
    target = spark.createDataFrame([(1, "a", None, TS1)], "k int, id string, name string, updated_at timestamp_ntz")
    source = spark.createDataFrame([("a", "Ann")], "id string, name string")
    out = upsert_scd1(target, source, "id", {"name": UNGUARDED}, "k", "updated_at", TS2)
    assert rows(out) == [(1, "a", None, TS1)]


def test_incremental_insert_never_updates(spark):
    target = spark.createDataFrame([(1, "e1", 10), (2, "e2", 20)], "k int, id string, cost int")
    source = spark.createDataFrame([("e2", 99), ("e3", 30), ("e0", 5)], "id string, cost int")
    out = incremental_insert(target, source, "id", "k")
    assert rows(out) == [(1, "e1", 10), (2, "e2", 20), (3, "e0", 5), (4, "e3", 30)]


def test_inferred_members_and_placeholder(spark):
    dim = spark.createDataFrame([(1, "p1", "Oak Mutual")], "k int, id string, name string")
    facts = spark.createDataFrame([("p1",), ("p9",), ("p9",), (None,), ("p5",)], "payer string")
    out = infer_missing_members(dim, facts, "payer", "id", "k", {"name": "Unknown Payer / Auto-Generated"})
    assert rows(out) == [(1, "p1", "Oak Mutual"), (2, "p5", "Unknown Payer / Auto-Generated"),
                         (3, "p9", "Unknown Payer / Auto-Generated")]
    placeholder = {"k": 0, "id": "0000", "name": "No Payer / Self-Pay"}
    once = ensure_placeholder(out, placeholder, "k")
    twice = ensure_placeholder(once, placeholder, "k")
    assert rows(twice) == rows(once) and (0, "0000", "No Payer / Self-Pay") in rows(once)


# ----------------------------------------------------------------- outliers
def test_iqr_limit_exact_percentiles(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 100]], "d int")
    b = iqr_bounds(df, "d").first()
    assert (b.q1, b.q3, b.iqr, b.upper_limit) == (2.0, 4.0, 2.0, 7)
    capped = cap_outliers(spark.createDataFrame([(0,), (-3,), (7,), (8,)], "d int"), "d", "c", iqr_bounds(df, "d"))
    assert rows(capped) == [(-3, 1), (0, 0), (7, 7), (8, 7)]


def test_order_statistics_of_distinct_values(spark):
    """Every value different, more of them than a task holds; and no task merges them all."""
    n = 20_011
    df = spark.range(n).select((F.col("id") * 7919 % n - 500).alias("v")).unionByName(
        spark.createDataFrame([(None,)], "v long"))
    got = order_statistics(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], num_partitions=8)
    want = df.agg(F.percentile("v", F.array(*[F.lit(q) for q in (0.0, 0.25, 0.5, 0.9, 1.0)])).alias("p")).first().p
    assert list(got.first()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("values", [[], [None], [3], [3, None, 3], [1, 2], [5, 5, 5, 9], [-2, 7, 7, 7, 100, 3]])
def test_order_statistics_of_few_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    quantiles = (0.25, 0.75, 0.4)
    got = order_statistics(df, "v", quantiles, num_partitions=3).first()
    want = df.agg(F.percentile("v", F.array(*[F.lit(q) for q in quantiles])).alias("p")).first().p
    assert list(got) == (want or [None] * 3)


# ----------------------------------------------------------------- ordered slices
def test_running_in_key_matches_plain_windows(spark):
    """A third of the rows under one key, some under no key, keys across slice borders."""
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, 0 if rnd.random() < 0.33 else rnd.choice([None, *range(1, 40)]),
                                 rnd.randint(0, 5), rnd.choice([None, 1, 2, 3])) for i in range(4000)],
                               "id long, k int, t int, v int")
    got = running_in_key(df, ["k"], ["t", "id"], {"upto": "v"}, {"all": "v"}, num_partitions=16)
    w = Window.partitionBy("k")
    upto = w.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    v = F.coalesce("v", F.lit(0))
    want = df.select("*", F.sum(v).over(upto).alias("upto"), F.sum(v).over(w).alias("all"))
    assert rows(got) == rows(want)


def test_hot_key_is_spread_over_slices(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                  F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ts"), "id")
    sliced = order_slices(df, ["k", "ts", "id"], 12)
    per = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(per) == 6000 and max(per) < 6000 / 4  # the key with 2000 rows, all at one instant, lies in several
    assert len({r[0] for r in sliced.where("k = 0").select("_slice").distinct().collect()}) >= 3


@pytest.mark.parametrize("parts", [1, 7])
def test_duplicate_members_with_copies_and_null_keys(spark, parts):
    data = [(1, "a", 1.0)] * 5 + [(1, "b", 2.0)] + [(2, "c", 3.0)] + [(None, "x", None)] * 2 + [(None, "w", 1.0)]
    data += [(7, f"s{i:03d}", 0.5) for i in range(300)]  # one key with most of the rows
    df = spark.createDataFrame(data, "k int, s string, x double")
    got = duplicate_members(df, ["k"], ["s"], num_partitions=parts)
    w = Window.partitionBy("k")
    want = (df.withColumn("row_in_key", F.row_number().over(w.orderBy("s", "x"))).withColumn("n", F.count("*").over(w))
            .where("n > 1").drop("n"))
    assert rows(got) == rows(want)
    assert duplicate_members(df.limit(0), ["k"], ["s"]).count() == 0


# ----------------------------------------------------------------- calendar
def test_date_dimension(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 9, 30, 8),), (dt.datetime(2024, 10, 1, 9),)], "ts timestamp_ntz")
    dim = date_dimension(df, "ts")
    days = [r.full_date for r in dim.orderBy("full_date").collect()]
    assert days[0] == dt.date(2023, 1, 1) and days[-1] == dt.date(2024, 12, 31)
    assert len(days) == 365 + 366 and all((b - a).days == 1 for a, b in zip(days, days[1:]))
    leap = dim.filter("date_key = 20240229").first()
    assert leap.fiscal_year == 2024 and leap.day_name == "Thursday" and not leap.is_weekend
    assert date_dimension(df.limit(0), "ts").count() == 0


# ----------------------------------------------------------------- sequence
def _events(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        user = 0 if rnd.random() < 0.4 else rnd.randint(1, 20)   # user 0 is a hot key
        data.append((i, user, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))))
    return spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz")


def test_next_in_key_matches_plain_window(spark):
    ev = _events(spark)
    got = next_in_key(ev, "user_id", ["ts", "event_id"], "ts", "nxt", F.to_date("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.withColumn("nxt", F.lead("ts").over(w))
    assert rows(got, "event_id", "nxt") == rows(want, "event_id", "nxt")


def test_running_max_before_matches_plain_window(spark):
    ev = _events(spark).withColumn("stop", F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    got = running_max_before(ev, "user_id", ["ts", "event_id"], "stop", "prev", F.to_date("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.withColumn("prev", F.max("stop").over(w))
    assert rows(got, "event_id", "prev") == rows(want, "event_id", "prev")


def test_adaptive_buckets_slice_hot_pairs(spark):
    ev = _events(spark)
    b = adaptive_buckets(ev, "user_id", "ts", "day", target_rows=20)
    per = b.groupBy("user_id", "_bkt").count().collect()
    hot = [r["count"] for r in per if r.user_id == 0]
    assert max(hot) <= 3 * 20          # the hot user's days are cut into slices
    assert len({r._bkt.slice for r in per if r.user_id == 0}) > 1
    # buckets never go back in time within a key
    rows = sorted((r.user_id, r.ts, (r._bkt.start, r._bkt.slice)) for r in b.collect())
    for (u1, _, b1), (u2, _, b2) in zip(rows, rows[1:]):
        assert u1 != u2 or b1 <= b2


def test_sequence_ops_with_sliced_buckets_match_plain_windows(spark):
    ev = _events(spark).withColumn("stop", F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    got_next = next_in_key(ev, "user_id", ["ts", "event_id"], "ts", "nxt", unit="day", target_rows=15)
    got_max = running_max_before(ev, "user_id", ["ts", "event_id"], "stop", "prev", unit="month", target_rows=40)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = (ev.withColumn("nxt", F.lead("ts").over(w))
            .withColumn("prev", F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    assert rows(got_next, "event_id", "nxt") == rows(want, "event_id", "nxt")
    assert rows(got_max, "event_id", "prev") == rows(want, "event_id", "prev")


def test_sequence_ops_with_rows_piled_on_one_instant(spark):
    burst = F.when(F.col("event_id") % 3 == 0, F.lit(dt.datetime(2024, 1, 5))).otherwise(F.col("ts"))
    ev = _events(spark).withColumn("ts", burst.cast("timestamp_ntz")).withColumn("stop", F.col("event_id") % 97)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = (ev.withColumn("nxt", F.lead("event_id").over(w))
            .withColumn("prev", F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    assert rows(next_in_key(ev, "user_id", ["ts", "event_id"], "event_id", "nxt"), "event_id", "nxt") == rows(
        want, "event_id", "nxt")
    assert rows(running_max_before(ev, "user_id", ["ts", "event_id"], "stop", "prev"), "event_id", "prev") == rows(
        want, "event_id", "prev")


# ------------------------------------------------------------ quality / C1-C4
def test_quality_and_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, s string")
    assert rows(key_violations(df, ["k"])) == srt([(None, 1), (1, 2)])
    assert dict(rows(null_counts(df, ["k", "s"]))) == {"k": 1, "s": 1}
    assert [r.k for r in longest(df.fillna(0, ["k"]), "k", 2, ["s"]).collect()] == [2, 1]
    dim = spark.createDataFrame([(1,)], "pk int")
    rep = constraints.constraint_report([
        constraints.fk_rule(df, "k", dim, "pk", "t", "fk_k"),
        constraints.pk_rule(df, ["k"], "t", "pk_k"),
        constraints.not_null_rule(df, "s", "t", "nn_s")])
    assert rows(rep, "rule", "violating_rows", "ok") == [("fk_k", 1, False), ("nn_s", 1, False),
                                                         ("pk_k", 3, False)]
    with pytest.raises(constraints.ConstraintViolation):
        constraints.assert_constraints(rep)
