import random

from pyspark.sql import functions as F

from strata.operators.dedupe import first_per_key
from strata.operators.keys import PLACE, assign_keys, first_in_slices, number_places


def _rows(spark):
    r = random.Random(5)
    rows = [(r.choice([None, "a", "b", " b", "C"]), r.choice([None, 1, 2, 3, 40]), r.choice([None, 5, 6]), r.choice([None, "x", "y"]))
            for _ in range(400)]
    return spark.createDataFrame(rows, "k string, t long, v long, code string").repartition(3)


def test_same_rows_and_keys_as_dedupe_then_keys(spark):
    """NULL and repeated keys, a filter after the dedupe, and a join that moves the rows before they are numbered."""
    df = _rows(spark)
    old = assign_keys(first_per_key(df, ["k", "t"], [("v", "desc")]).where("code IS NOT NULL"), ["k", "t"], "key", start=7)
    codes = df.select("code").where("code IS NOT NULL").distinct().withColumn("name", F.upper("code"))
    placed = first_in_slices(df, ["k", "t"], [("v", "desc")], where=F.col("code").isNotNull(), num_partitions=5)
    new = number_places(placed.join(codes.hint("merge"), "code"), "key", start=7)
    got = sorted(map(tuple, new.select("k", "t", "v", "code", "key").collect()), key=str)
    assert got == sorted(map(tuple, old.collect()), key=str)
    assert sorted(x[-1] for x in got) == list(range(7, 7 + len(got)))


def test_no_rows(spark):
    keyed = number_places(first_in_slices(_rows(spark).where("1 = 0"), ["k"]), "key")
    assert keyed.columns == ["k", "t", "v", "code", "key"] and keyed.collect() == []


def test_one_exchange_for_dedupe_and_keys(spark):
    """The window is served by the range slices: a hash exchange after them would undo the order."""
    df = spark.range(1000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    plan = first_in_slices(df, ["k"], [("v", "desc")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert PLACE in plan.columns
    assert text.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in text
