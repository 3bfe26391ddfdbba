"""Physical-plan properties the operators are designed for (checked on sf0.001)."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(fn(spark, SF)) for k, fn in entry.queries().items()}


def test_no_python_and_no_cartesian(plans):
    for key, p in plans.items():
        assert "PythonUDF" not in p and "EvalPython" not in p, key
        assert "CartesianProduct" not in p, key


def test_nested_loop_joins_only_pair_with_bounded_sides(plans):
    # a nested-loop join may only appear against a one-row aggregate, a one-row literal
    # or an existence probe (LocalLimit 1)
    for key, p in plans.items():
        lines = p.splitlines()
        for i, line in enumerate(lines):
            if "BroadcastNestedLoopJoin" in line:
                tail = "\n".join(lines[i:i + 40])
                assert ("HashAggregate(keys=[]" in tail or "LocalLimit 1" in tail or "Range (0, 1" in tail
                        or "Scan OneRowRelation" in tail), (key, tail)


def test_filters_and_columns_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plans["keep_new"]
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in plans["q07_claim_by_payer"]
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,0.0)" in plans["keep_referenced"]


def test_facts_aggregate_before_dimension_join(plans):
    p = plans["q07_claim_by_payer"]
    join_at = p.index("Join")
    assert "partial_sum" in p[join_at:], "lineitem must be pre-aggregated below the join"


def test_top1_is_prelimited_map_side(plans):
    for key in ("dedupe_by_id", "dedupe_latest", "canonical_description"):
        assert "WindowGroupLimit" in plans[key] and "Partial" in plans[key], key


def test_per_key_windows_are_bucketed(plans):
    for key in ("q09_readmitted_30d", "minute_boundaries", "q03_over_24h"):
        windows = [line for line in plans[key].splitlines() if "Window [" in line]
        assert windows and any("_bkt" in w for w in windows), key
