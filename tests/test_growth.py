"""What a task reads and holds: stored layers by column, canonical pairs before their sort, slices by rows."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import slices
from strata.operators.canonical import canonical_description
from strata.operators.dedupe import duplicate_members
from strata.operators.keys import assign_keys


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_rows_are_read_by_column(spark):
    df = spark.createDataFrame([(3, "c"), (None, "x"), (1, "a"), (3, "c")], "id int, s string")
    keyed = assign_keys(df, ["id", "s"], "k", num_partitions=3)
    assert [(r.k, r.id, r.s) for r in keyed.orderBy("k").collect()] == [(1, None, "x"), (2, 1, "a"), (3, 3, "c"), (4, 3, "c")]
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(keyed.select("id")))
    assert read and read.group(1) == "id:int"


def test_canonical_pairs_are_distinct_before_the_sort(spark):
    df = spark.createDataFrame([("A", "long text"), ("A", "short")] * 50 + [("B", None), ("B", "b"), (None, "n")], "c string, d string")
    best = canonical_description(df, "c", "d")
    assert sorted(map(tuple, best.collect()), key=str) == sorted([("A", "short"), ("B", None), (None, "n")], key=str)
    assert "HashAggregate" in plan_of(best)


def test_slices_of_duplicate_members_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ROWS", 200, raising=False)
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("k"),
                                  "id", (F.col("id") % 7).alias("v"))
    df = df.unionByName(df.where("id < 30"))
    got = duplicate_members(df, ["k"], ["id"])
    assert got.rdd.getNumPartitions() >= 20  # 4 by the setting
    w = Window.partitionBy("k")
    want = (df.withColumn("row_in_key", F.row_number().over(w.orderBy("id", "v"))).withColumn("n", F.count("*").over(w))
            .where("n > 1").drop("n"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
