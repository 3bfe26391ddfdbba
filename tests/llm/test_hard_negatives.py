"""Hard negatives by the threshold algorithm, against a search of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives
from strata.llm.hard_negatives import SortedLists, mine

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """rows: (id, label, vector) that take part, ids distinct."""
    width = max((len(v) for _, _, v in rows), default=0)
    whole = {i: (label, [int(np.floor(scale * x)) for x in v] + [0] * (width - len(v))) for i, label, v in rows}
    out = set()
    for a in filter(is_anchor, whole):
        label, vector = whole[a]
        scored = sorted((-sum(x * y for x, y in zip(vector, w)), i, other) for i, (other, w) in whole.items() if i != a)
        for score, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(n, s) for s, n, other in scored if other != label and low * -score <= 100 * -s <= high * -score]
            out |= {(a, p, r + 1, n, -score, -s) for r, (n, s) in enumerate(inside[:negatives])}
    return out


def mined(spark, rows, is_anchor="vec_id % 3 = 0", **options):
    got = mine(spark.createDataFrame(rows, SCHEMA), F.expr(is_anchor), **options).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def random_rows(n, width, seed, labels=3, digits=1):
    """Few different values, so that there are many ties."""
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(labels)), [float(x) for x in rng.normal(0.2, 0.6, width).round(digits)]) for i in range(n)]


@pytest.mark.parametrize("shard_rows, block_anchors", [(65_536, 8192), (10, 20)])
def test_equals_a_search_of_all_rows(spark, shard_rows, block_anchors):
    rows = random_rows(300, 5, seed=1)
    assert mined(spark, rows, shard_rows=shard_rows, block_anchors=block_anchors) == brute(rows, lambda i: i % 3 == 0)


def test_other_parameters(spark):
    rows = random_rows(120, 4, seed=2, labels=2)
    assert mined(spark, rows, positives=2, negatives=7, low=10, high=60, scale=10) == brute(
        rows, lambda i: i % 3 == 0, 2, 7, 10, 60, 10)


def test_copies_of_one_vector(spark):
    """A third of the rows are the same vector under different labels: ties go to the smaller id."""
    rows = [(i, label, [0.5, 0.5, 0.1] if i % 3 == 0 else v) for i, label, v in random_rows(240, 3, seed=3)]
    assert mined(spark, rows, "vec_id % 50 = 0") == brute(rows, lambda i: i % 50 == 0)


def test_rows_that_take_no_part(spark):
    good = random_rows(60, 4, seed=4)
    bad = [(None, 1, [1.0] * 4), (1000, None, [1.0] * 4), (1002, 1, None), (1005, 1, [1.0, None, 1.0, 1.0]),
           (1008, 2, [float("nan")] * 4), (1011, 2, [1.0, float("inf"), 0.0, 0.0]), (1014, 0, [1e200, 0.0, 0.0, 0.0])]
    assert mined(spark, good + bad) == brute(good, lambda i: i % 3 == 0)


def test_vectors_of_different_length_empty_and_zero(spark):
    rows = random_rows(40, 4, seed=5) + [(100, 1, []), (102, 1, [0.0] * 4), (105, 2, [0.7]), (108, 0, [0.3, 0.4, 0.1, 0.2, 0.9])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 3 == 0)


def test_large_components_are_exact(spark):
    """Scores near 2**60, which doubles don't hold."""
    rows = [(i, label, [x * 2e6 + 0.37 * i for x in v]) for i, label, v in random_rows(50, 4, seed=6, digits=6)]
    assert any(abs(r[-1]) > 2 ** 53 for r in brute(rows, lambda i: i % 3 == 0))
    assert mined(spark, rows) == brute(rows, lambda i: i % 3 == 0)


def test_repeated_ids_and_clashing_columns(spark):
    rows = random_rows(60, 4, seed=7)
    again = [(i, label + 1, v) for i, label, v in rows[:20]] + rows[:30]
    frame = spark.createDataFrame(rows + again, SCHEMA)
    for name in ("id", "q", "width", "shard", "block", "rank", "score", "anchor", "positives"):
        frame = frame.withColumn(name, F.lit("x"))
    assert set(map(tuple, mine(frame, F.expr("vec_id % 3 = 0")).collect())) == brute(rows, lambda i: i % 3 == 0)


def test_empty_one_row_and_no_negatives(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(0, 1, [1.0])]) == set()
    assert mined(spark, [(i, 1, [1.0]) for i in range(9)]) == set()


def test_stops_before_the_end_of_the_lists():
    """Where few rows are near, the threshold ends the search: not every row is scored."""
    rng = np.random.default_rng(8)
    vectors = rng.integers(-50, 50, (5000, 3))
    vectors[:20] += 900
    lists = SortedLists(np.arange(5000), np.zeros(5000, int), vectors)
    scored = []
    plain = lists.scores
    lists.scores = lambda rows, *a: scored.append(len(rows)) or plain(rows, *a)
    (found, scores), = lists.nearest(np.array([3, 2, 1]), True, np.ones(5000, bool), [(-10 ** 9, 10 ** 9)], 5)
    want = np.lexsort((np.arange(5000), -(vectors @ np.array([3, 2, 1]))))[:5]
    assert list(found) == list(want) and sum(scored) < 500


def test_query_is_registered():
    from strata.llm.queries import ORACLE_SQL, QUERIES

    assert "op12_threshold_negatives" in QUERIES and "op12_threshold_negatives" in ORACLE_SQL
    assert hard_negatives.SHARD_ROWS <= 1 << 16
