"""Hard negatives by Fagin's threshold algorithm.

For each anchor the nearest rows of its own label are its positives; a hard negative of an
anchor and a positive is a row of another label whose score lies in a window below the
positive's: ``low * positive <= 100 * score <= high * positive``.  Scores are integer inner
products of vectors whose components are ``floor(scale * x)``.

Rows are dealt to shards by a hash of their id, anchors to blocks; a cell is one shard and one
block, both of bounded size, so the stated set of anchors meets all rows in cells.  A cell
sorts its rows by every dimension once.  For an anchor it then reads the lists in step, a list
from its top where the anchor's component is positive, from its bottom where it is negative
(sorted access), scores every row that turns up (random access) and keeps the best k of each
window.  The *threshold* is the score of a row that had in each dimension the value just read:
no row that has not turned up can score more.  A window is closed when the threshold is strictly
below its k-th score, so that ties are all seen, or below the window itself; the anchor is done
when all its windows are closed.  Positives are one window, the label's, without bounds; the
negatives of an anchor have one window for each positive and are searched in the same pass.
The best of each cell are merged by a window function over at most k rows from each shard.

Defined cases.  A row takes no part if its id, label or vector is null, if a component is null
or not finite, or if its squared length exceeds 2**62 (its scores need not fit a long).  Of rows
with the same id the one with the smallest label and vector stands for all.  A shorter vector
counts as filled up with zeros.  An anchor without positives, a window without rows and an empty
table give no rows; ties go to the smaller id.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship_package
from strata.session import ensure_checkpoint_dir

SHARD_ROWS = 65_536  # at most about so many rows in a shard, and so many anchors in a block:
BLOCK_ANCHORS = 8_192  # these bound a task's memory, not the result
LEAST_SHARDS = 16
FIRST_STEP = 32  # places read of every list before the first look at the threshold; then doubled
EXACT = 2.0 ** 44  # up to this squared length doubles hold every score and threshold exactly


class SortedLists:
    """One shard: its rows by id, and for each dimension their order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.lists = np.ascontiguousarray(np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(self.vectors, self.lists.T, axis=0).T
        self.doubles = self.vectors.astype(np.float64) if _exact(vectors) else None

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact and self.doubles is not None:
            return (self.doubles[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor  # partial sums may wrap around, the whole fits

    def nearest(self, anchor: np.ndarray, exact: bool, allowed: np.ndarray, windows: list[tuple[int, int]],
                k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (least and largest score) the rows and scores of its best ``k`` allowed rows."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, dtype=bool)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(windows)
        is_open = list(range(len(windows)))
        depth, step = 0, FIRST_STEP
        while is_open:
            whole = depth + step >= n or not len(up) + len(down)
            if whole:
                new = np.flatnonzero(~seen)
            else:
                hit = np.zeros(n, dtype=bool)
                hit[self.lists[up, n - depth - step:n - depth]] = True
                hit[self.lists[down, depth:depth + step]] = True
                new = np.flatnonzero(hit & ~seen)
                seen |= hit
                depth += step
                step = depth
            new = new[allowed[new]]
            scores = self.scores(new, anchor, exact)
            for w in is_open:
                best[w] = _best(*best[w], new, scores, windows[w], k)
            if whole:
                break
            threshold = sum(int(a) * int(v) for a, v in zip(anchor[up], self.values[up, n - depth])) + sum(
                int(a) * int(v) for a, v in zip(anchor[down], self.values[down, depth - 1]))
            is_open = [w for w in is_open if threshold >= windows[w][0]
                       and (len(best[w][0]) < k or threshold >= best[w][1][-1])]
        return best


def _exact(vectors: np.ndarray) -> bool:
    return not len(vectors) or float((vectors.astype(np.float64) ** 2).sum(axis=1).max()) <= EXACT


def _best(rows, scores, new_rows, new_scores, window, k):
    inside = (new_scores >= window[0]) & (new_scores <= window[1])
    rows, scores = np.concatenate([rows, new_rows[inside]]), np.concatenate([scores, new_scores[inside]])
    if len(rows) > k:
        kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        rows, scores = rows[kept], scores[kept]
    order = np.lexsort((rows, -scores))[:k]  # rows stand in the order of their ids
    return rows[order], scores[order]


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _width(*tables: pa.Table) -> int:
    return max((t["width"].to_numpy().max() for t in tables if t.num_rows), default=0)


def _cell(rows: pa.Table, anchors: pa.Table) -> tuple[SortedLists, np.ndarray]:
    width = _width(rows, anchors)
    return (SortedLists(rows["id"].to_numpy(), rows["label"].to_numpy(), _vectors(rows["q"], width)),
            _vectors(anchors["q"], width))


def _positives_of(k: int, schema: pa.Schema):
    everything = [(-(1 << 63), (1 << 63) - 1)]

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            shard, vectors = _cell(rows, anchors)
            exact = _exact(vectors)
            for me, label, vector in zip(anchors["id"].to_numpy(), anchors["label"].to_numpy(), vectors):
                (found, scores), = shard.nearest(vector, exact, (shard.labels == label) & (shard.ids != me), everything, k)
                out += [(me, i, s) for i, s in zip(shard.ids[found], scores)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 3)], schema=schema)

    return run


def _negatives_of(k: int, low: int, high: int, schema: pa.Schema):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            shard, vectors = _cell(rows, anchors)
            exact = _exact(vectors)
            for me, label, vector, positives in zip(anchors["id"].to_numpy(), anchors["label"].to_numpy(), vectors,
                                                    anchors["positives"].to_pylist()):
                # least and largest integer with low * p <= 100 * s <= high * p
                windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
                best = shard.nearest(vector, exact, shard.labels != label, windows, k)
                for p, (found, scores) in zip(positives, best):
                    out += [(me, p["id"], p["score"], i, s) for i, s in zip(shard.ids[found], scores)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], schema=schema)

    return run


def quantised(vectors: DataFrame, anchor: Column, label: Column, scale: int = 256, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """The rows that take part: id, label, anchor, q (integer components) and width."""
    def whole(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                          F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("v", whole))
    rows = rows.withColumn("q", F.transform("v", lambda x: F.floor(x.cast("double") * scale))).drop("v")
    length2 = F.aggregate("q", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    rows = rows.where(length2 <= 2.0 ** 62)
    one = rows.groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"), F.max("anchor").alias("anchor"))
    return one.select("id", "row.label", "anchor", "row.q", F.size("row.q").cast("long").alias("width"))


def _first(df: DataFrame, of: list[str], by: str, k: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.col("score").desc(), F.col(by))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score (long): for each
    row that ``anchor`` marks and each of its ``positives`` nearest rows of the same label, the first ``negatives``
    rows of another label in the window.  ``label`` (default: the column) is the label to go by."""
    spark = vectors.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    rows = quantised(vectors, anchor, F.col(label_col) if label is None else label, scale, id_col, vector_col).checkpoint()
    size = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    shards, blocks = max(LEAST_SHARDS, math.ceil(size[0] / shard_rows)), max(1, math.ceil(size[1] / block_anchors))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    here = rows.select("id", "label", "q", "width", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"),
                       every(blocks).alias("block"))

    def in_cells(anchors: DataFrame, find, schema: str) -> DataFrame:
        dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
        dealt = dealt.withColumn("shard", every(shards))
        left, right = here.toDF(*here.columns), dealt.toDF(*dealt.columns)  # both come from ``rows``: new attributes
        return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(find, schema)

    def longs(*names: str) -> tuple[pa.Schema, str]:
        return pa.schema([(n, pa.int64()) for n in names]), ", ".join(f"{n} long" for n in names)

    anchors = rows.where("anchor").select("id", "label", "q", "width")
    arrow, schema = longs("anchor_id", "vec_id", "score")
    near = _first(in_cells(anchors, _positives_of(positives, arrow), schema), ["anchor_id"], "vec_id", positives)
    near = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(  # at most ``positives`` of them
        F.struct("rank", "score", F.col("vec_id").alias("id")))).alias("positives"))
    anchors = anchors.join(near, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    arrow, schema = longs("anchor_id", "positive_id", "positive_score", "vec_id", "score")
    found = in_cells(anchors, _negatives_of(negatives, low, high, arrow), schema)
    found = _first(found, ["anchor_id", "positive_id"], "vec_id", negatives)
    return found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                        F.col("score").alias("negative_score"))
