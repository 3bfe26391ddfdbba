"""Property tests: operators against straightforward Python references on generated rows.
Each example builds one DataFrame holding many generated rows, so examples stay few."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions import expr as X
from strata.operators.dedupe import first_per_key
from strata.operators.keys import assign_keys

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

stamps = st.datetimes(min_value=dt.datetime(1960, 1, 1), max_value=dt.datetime(2040, 1, 1))


def minute_floor(t: dt.datetime) -> int:
    return int((t - dt.datetime(1970, 1, 1)) // dt.timedelta(minutes=1))


@SETTINGS
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=60))
def test_minute_diff_matches_boundary_count(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(X.minute_diff("a", "b")).collect()]
    assert got == [minute_floor(b) - minute_floor(a) for a, b in pairs]


rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-3, 3)),
                             st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))), min_size=1, max_size=80)


def _brute_first(rows, desc_v):
    def key(r):
        v, s = r[1], r[2]
        if desc_v:   # v DESC NULLS LAST, then s ASC NULLS FIRST
            vk = (1, 0) if v is None else (0, -v)
        else:        # v ASC NULLS FIRST
            vk = (0, 0) if v is None else (1, v)
        return vk, ((0, "") if s is None else (1, s))
    best = {}
    for r in rows:
        if r[0] not in best or key(r) < key(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=repr)


@SETTINGS
@given(rows_st, st.booleans())
def test_first_per_key_matches_brute_force(spark, rows, desc_v):
    df = spark.createDataFrame(rows, "k string, v int, s string")
    got = first_per_key(df, ["k"], [("v", "desc" if desc_v else "asc")])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute_first(rows, desc_v)


@SETTINGS
@given(st.sets(st.integers(-10_000, 10_000), min_size=1, max_size=300), st.integers(1, 9), st.integers(1, 50))
def test_assign_keys_is_rank_plus_start(spark, ids, slices, start):
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    got = {r.id: r.k for r in assign_keys(df, ["id"], "k", start=start, num_partitions=slices).collect()}
    assert got == {i: start + rank for rank, i in enumerate(sorted(ids))}
