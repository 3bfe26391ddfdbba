"""Near-duplicate groups by MinHash with tensored banding.

A document's set holds the hashes of its distinct five-word shingles.  Instead of hashing a set
anew for each of L tables, two small collections of ``m`` half keys are computed, each half key
from ``half`` minhashes; a table's key is a pair, one half key of either collection.  So
``2 * m * half`` minhashes give ``m * m`` tables.  Documents of similarity 0.75 share a key with
probability (1 - (1 - 0.75 ** half) ** m) ** 2: 0.9999 for m = 12, half = 2.

The pairs are formed after the shuffle, which goes by the first half key alone: rows that share
it with no other are dropped there, and only the rest meet their second half keys.  Half keys that
very many share go without this shuffle.

Equal sets are one class from the start, represented by the smallest id.  A bucket of a few
classes gives all its pairs.  A larger one gives each member's pair with the smallest member.
What is in different components of a large bucket then is compared in full, all members with
those outside the commonest component, in cells of bounded size; of the links found, a cell gives
only those that join components.  So no bucket,
whatever its size, makes rows for all its pairs, and no pair that shares a bucket is left out.
Every link is confirmed on the full sets.  Components come from alternating star contraction on
the links.

Null or empty text has an empty set and links with nothing.  A row without an id is kept and
linked with nothing.  Repeated rows fall into one class; rows of one id are one node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import lookup, map_rows
from strata.session import ensure_checkpoint_dir

WORDS = 5
SMALL_BUCKET = 16  # at most so many classes: all pairs; more: the cells
BROADCAST_IDS = 1_000_000  # 8 MB of candidate ids
CELL_SHINGLES = 250_000  # about so many hashes on either side of a cell: 2 MB

_U = np.uint64
_BASE, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64, as many as asked for so far."""

    def __init__(self):
        self.up = self.down = np.ones(0, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << int(n - 1).bit_length()
            inverse = _U(pow(int(_BASE), -1, 1 << 64))
            self.up = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, _BASE))])
            self.down = np.concatenate([np.ones(1, _U), np.cumprod(np.full(size, inverse))])
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it is shorter."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.empty(0, _U)
    data = np.frombuffer(b"".join(tokens), np.uint8).astype(_U) + _U(1)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(data * up[:-1])])
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    width = min(words, len(tokens))
    out = np.full(len(tokens) - width + 1, _U(width))
    for k in range(width):
        out = _mix(out * _BASE + hashes[k : len(tokens) - width + 1 + k])
    return np.unique(out)


class HalfKeys:
    """The two collections of half keys of a set."""

    def __init__(self, m: int, half: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.m, self.half, n = m, half, 2 * m * half
        self.factor = rng.integers(0, 1 << 63, n).astype(_U) * _U(2) + _U(1)
        self.shift = rng.integers(0, 1 << 63, n).astype(_U)
        self.place = _mix(np.arange(1, 2 * m + 1).astype(_U))

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least = np.full(len(self.factor), _U(0xFFFFFFFFFFFFFFFF))
        for i in range(0, len(hashes), 4096):
            values = hashes[i : i + 4096, None] * self.factor + self.shift
            values ^= values >> _U(32)
            values *= _MIX2
            np.minimum(least, values.min(axis=0), out=least)
        keys = self.place.copy()
        for k in range(self.half):
            keys = _mix(keys * _BASE + least[k :: self.half])
        return keys[: self.m].view(np.int64), keys[self.m :].view(np.int64) >> 32


def signatures(docs: DataFrame, m: int, half: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, first, second): set_id names the set, the others hold half keys."""

    def make():
        keys = HalfKeys(m, half)

        def row(doc_id, text):
            hashes = shingle_set(text)
            if not len(hashes):
                yield doc_id, 0, None, [], []
                return
            a, b = keys(hashes)
            yield doc_id, len(hashes), hashlib.md5(hashes.tobytes()).digest(), a.tolist(), b.tolist()

        return row

    return map_rows(docs, "doc_id long, n_shingles long, set_id binary, first array<long>, second array<int>", make)


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def buckets(classes: DataFrame) -> DataFrame:
    """(a, b, node, n, size, low) of all buckets with two classes or more.

    Rows meet by their first half key, unless over a thousandth of all rows have it: such crowded keys are known
    from a count that is combined before the shuffle, and their rows stay where they are.  Their buckets are
    counted in the same way, and the counts go back to the rows, those of crowded buckets by broadcast."""
    rows = classes.select("node", "n", "second", F.explode("first").alias("a"))
    keys = rows.groupBy("a").agg(F.count("*").alias("_k")).checkpoint()
    total = keys.agg(F.coalesce(F.sum("_k"), F.lit(0))).first()[0]
    crowded = F.broadcast(keys.where(F.col("_k") > total / 1000).select(F.col("a").alias("_crowded")))  # fewer than a thousand
    apart = rows.join(crowded, F.col("a") == F.col("_crowded"), "left")

    usual = apart.where("_crowded IS NULL")
    usual = usual.withColumn("_shared", F.count("*").over(Window.partitionBy("a"))).where("_shared > 1")
    # keyed by ``a`` already: the second half keys meet without another shuffle
    usual = usual.select("a", "node", "n", F.explode("second").alias("b"))
    bucket = Window.partitionBy("a", "b")
    usual = usual.select("*", F.count("*").over(bucket).alias("size"),
                         F.min(F.struct("node", "n")).over(bucket).alias("low")).where("size > 1")

    crowded = apart.where("_crowded IS NOT NULL").select("a", "node", "n", F.explode("second").alias("b"))
    sizes = crowded.groupBy("a", "b").agg(F.count("*").alias("size"), F.min(F.struct("node", "n")).alias("low"))
    sizes = sizes.where("size > 1").checkpoint()
    # a bucket has a thousandth of the rows or more at most 12,000 times, as each row is in 12 buckets
    crowded = lookup(crowded, {"a": "a", "b": "b"}, sizes, ["size", "low"], "size", total).where("size IS NOT NULL")
    return usual.unionByName(crowded.select(*usual.columns))


def first_pairs(found: DataFrame, percent: int) -> DataFrame:
    """(x, y), x < y: all pairs of small buckets, those with the smallest member of large ones."""
    small = (found.where(F.col("size") <= SMALL_BUCKET).groupBy("a", "b")
             .agg(F.sort_array(F.collect_set(F.struct("node", "n"))).alias("of")).select("of").distinct())
    small = small.select(F.explode(F.flatten(F.transform("of", lambda x, i: F.transform(
        F.slice("of", i + 2, F.size("of")), lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("p")).select("p.x", "p.y")
    large = found.where(F.col("size") > SMALL_BUCKET).select(F.col("low").alias("x"), F.struct("node", "n").alias("y"))
    return (small.unionByName(large).where((F.col("x.node") < F.col("y.node")) & similar_sizes(F.col("x.n"), F.col("y.n"), percent))
            .select(F.col("x.node").alias("x"), F.col("y.node").alias("y")).distinct())


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar.  Sets are made anew for documents in pairs only."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    make = lambda: lambda doc_id, text: [(doc_id, shingle_set(text).tobytes())]
    sets = map_rows(docs.join(ids, "doc_id", "left_semi"), "doc_id long, hashes binary", make).checkpoint()
    both = (pairs.join(sets.select(F.col("doc_id").alias("y"), F.col("hashes").alias("_y")), "y")
            .join(sets.select(F.col("doc_id").alias("x"), F.col("hashes").alias("_x")), "x"))

    def verify():
        def row(x, y, a, b):
            a, b = np.frombuffer(a, _U), np.frombuffer(b, _U)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            if 100 * common >= percent * (len(a) + len(b) - common):
                yield x, y

        return row

    return map_rows(both.select("x", "y", "_x", "_y"), "x long, y long", verify).distinct().checkpoint()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of linked nodes, component being the smallest node reachable, by
    alternating large and small stars until nothing changes."""
    edges, before = links.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("u > v"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u")
        edges = (small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct().checkpoint())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def separate_members(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, node, component, active): the members of large buckets that hold several components, once
    per first half key; active are those outside the commonest component there."""
    large = found.where(F.col("size") > SMALL_BUCKET).select("a", "b", "node")
    rows = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (rows.groupBy("a", "b").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
             .where("_low < _high").select("a", "b"))
    rows = rows.join(mixed, ["a", "b"]).groupBy("a", "node").agg(F.first("component").alias("component")).checkpoint()
    main = (rows.groupBy("a", "component").agg(F.count("*").alias("_k"))
            .groupBy("a").agg(F.max(F.struct("_k", "component"))["component"].alias("_main"), F.sum("_k").alias("_n")).checkpoint())
    total = main.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rows = lookup(rows, {"a": "a"}, main, ["_main"], "_n", total)
    return rows.select("a", "node", "component", (F.col("component") != F.col("_main")).alias("active"))


def spanning_links(asked, there, percent: int) -> list[tuple[int, int]]:
    """Links between ``asked`` and ``there`` that join all components joined by any similar pair of
    them.  A pair is tested under the first of its common half keys only."""
    sets = [np.frombuffer(h, _U) for h in there["hashes"]]
    sizes, nodes = np.array([len(h) for h in sets]), there["node"].to_numpy()
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first, label = np.stack(there["first"].to_numpy()), there["component"].to_numpy().copy()
    mine, links = asked["component"].to_numpy().copy(), []
    for i, (a, node, hashes, keys) in enumerate(zip(asked["a"], asked["node"], asked["hashes"], asked["first"])):
        own = np.frombuffer(hashes, _U)
        equal = first == keys
        may = ((label != mine[i]) & equal.any(axis=1) & (keys[equal.argmax(axis=1)] == a)
               & (100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))))
        if not may.any():
            continue
        lo, hi = np.searchsorted(flat, own), np.searchsorted(flat, own, "right")
        ends = np.cumsum(hi - lo)
        at = np.arange(ends[-1]) + np.repeat(hi - ends, hi - lo)
        common = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero(may & (100 * common >= percent * (len(own) + sizes - common))):
            if label[j] != mine[i]:
                links.append((min(node, nodes[j]), max(node, nodes[j])))
                old, now = label[j], mine[i]
                label[label == old] = now
                mine[mine == old] = now
    return links


def remaining_links(members: DataFrame, docs: DataFrame, percent: int, m: int, half: int) -> DataFrame:
    """(x, y): links that join every two components of which a similar pair shares a large bucket.

    Each active member is compared with all members under its first half key, in cells of blocks
    of bounded size; within a cell an inverted index counts the common shingles."""
    ids = members.select(F.col("node").alias("doc_id")).distinct()
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)

    def make():
        keys = HalfKeys(m, half)

        def row(doc_id, text):
            hashes = shingle_set(text)
            if len(hashes):
                yield doc_id, len(hashes), hashes.tobytes(), keys(hashes)[0].tolist()

        return row

    sets = map_rows(docs.join(ids, "doc_id", "left_semi"), "node long, n long, hashes binary, first array<long>", make).checkpoint()
    sized = members.join(sets.select("node", "n"), "node")
    parts = lambda n: F.ceil(F.sum(n) / CELL_SHINGLES).cast("int")
    blocks = sized.groupBy("a").agg(parts(F.when(F.col("active"), F.col("n"))).alias("_for"), parts(F.col("n")).alias("_there"),
                                    F.count("*").alias("_n")).checkpoint()
    total = blocks.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    rows = lookup(members, {"a": "a"}, blocks, ["_for", "_there"], "_n", total).where("_for > 0")
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.where("active").select("a", "node", "component", number("_for").alias("i"), every("_there").alias("j"))
    there = rows.select("a", "node", "component", every("_for").alias("i"), number("_there").alias("j"))

    def search(asked, there):
        links = spanning_links(asked, there, percent) if len(asked) and len(there) else []
        return pd.DataFrame(links, columns=["x", "y"]).astype("int64")

    # toDF: columns of their own, as both sides come from the same rows
    asked, there = (d.join(sets, "node").select("a", "i", "j", "node", "component", "hashes", "first") for d in (asked, there))
    asked, there = (d.toDF(*d.columns).groupBy("a", "i", "j") for d in (asked, there))
    return asked.cogroup(there).applyInPandas(search, "x long, y long").distinct().checkpoint()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    m: int = 12, half: int = 2) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = signatures(rows, m, half).checkpoint()
    classes = (signed.where("doc_id is not null and n_shingles > 0").groupBy("set_id")
               .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("first").alias("first"),
                    F.first("second").alias("second"))).checkpoint()
    found = buckets(classes).checkpoint()  # shared keys only: few rows beside all keys
    pairs = first_pairs(found, percent).checkpoint()
    links = confirmed(pairs, rows, percent)
    labels = components(links)
    members = separate_members(found, labels).checkpoint()
    if not members.isEmpty():
        more = remaining_links(members, rows, percent, m, half)
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    named = classes.select("set_id", "node").join(labels, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("_component"))
    out = signed.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The documents with one of each group, the smallest id.  Columns stay as they are, whatever their
    names.  Documents without words or without an id stay; of rows with the same id one stays."""
    found = near_duplicates(docs, id_col, text_col, **parameters)
    columns = [f"c{i}" for i in range(len(docs.columns))]  # helper columns can't clash with these
    rows, id_at = docs.toDF(*columns), columns[docs.columns.index(id_col)]
    dropped = found.where(~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct()
    same = F.col(id_at).cast("long") == F.col("_id")
    out = rows.join(dropped, same, "left_anti")
    repeated = found.groupBy(F.col("doc_id").alias("_id")).count().where("count > 1 and _id is not null").select("_id")
    if not repeated.isEmpty():
        out = out.join(repeated, same, "left_anti").unionByName(
            out.join(repeated, same, "left_semi").dropDuplicates([id_at]))
    return out.toDF(*docs.columns)
