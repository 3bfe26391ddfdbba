"""Prefix trie of conversations by vertical bitmaps.

A node of depth d is a distinct sequence of the first d turns; its members are the
conversations that begin with it.  Turns are put in order and range-partitioned by
(conversation, depth); a task cuts its slice into shards of bounded size, each some whole
conversations that follow one another (or a piece of a long one).  A shard indexes every
(position, turn) to the bitset of its conversations and goes depth first: the child of a node
that holds the first member left over is the node's bitset intersected with the posting of that
member's next turn; popcount gives its members in the shard, the lowest bit the smallest of them,
and the members that end there its end list.  A node's name, the same in all shards, is the sum
of 128-bit hashes of its (position, turn) pairs; a piece of a long conversation begins with the
sum of what earlier slices hold of it, one row per slice.

What shards say about a node is merged in order of their conversations, at most one row from
each shard: members add up, end lists follow each other.  Parents are looked up by name; names
that over a thousandth of all nodes ask for are fewer than a thousand and are broadcast, the
others joined.  Subtree sums need the shared nodes only (below a node with one member there is
one leaf and nothing saved).  The nodes with the same smallest member form a path downwards, and
these paths a tree; its sums come by pointer doubling, in as many rounds as its height has bits,
and the sums of the nodes on a path are running sums from its lower end (``slices``).

Defined cases.  Rows without conv_id name no conversation and are left out.  Turns are ordered by
turn (null first), then role, then the digest of the text; null role or text is empty; repeated
rows are turns like others.  An empty table has no nodes, not even the root.  Texts of any length
count by digest and number of words.  Other columns are ignored, whatever their names.
SHA-256 goes through a list in order: one task hashes the end list of a node, in pieces, without
holding it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import lookup, ship_package
from strata.operators.slices import running_in_key, slice_count
from strata.session import ensure_checkpoint_dir

SHARD_TURNS = 8_192
WORD = r"[^\x20\x09-\x0D]+"
_MASK = (1 << 64) - 1
_SHARD_NODES = ("lo long, hi long, depth long, up_lo long, up_hi long, n_convs long, conv long, words long, "
                "n_ends long, ends string")
_NODES = "lo long, hi long, depth long, up_lo long, up_hi long, n_convs long, conv long, words long, ends_sha256 string"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Shard:
    """Vertical bitmaps over the turns of some conversations, given in order of (conv, depth).

    ``start`` is the name of the node above the first row, if that conversation began earlier."""

    def __init__(self, conv, depth, lo, hi, words, last, start: tuple[int, int] | None):
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(conv)) + 1])
        self.conv, self.first = conv[firsts].tolist(), firsts.tolist()
        self.depth, self.lo, self.hi, self.words = depth.tolist(), lo.tolist(), hi.tolist(), words.tolist()
        self.start = start
        self.postings: dict[tuple[int, int, int], int] = {}
        self.stops: dict[int, int] = {}  # by depth: whose last row here it is
        self.ends: dict[int, int] = {}  # by depth: whose last turn it is
        for i, (begin, end) in enumerate(zip(self.first, [*self.first[1:], len(self.depth)])):
            bit = 1 << i
            for r in range(begin, end):
                key = (self.depth[r], self.lo[r], self.hi[r])
                self.postings[key] = self.postings.get(key, 0) | bit
            at = self.depth[end - 1]
            self.stops[at] = self.stops.get(at, 0) | bit
            if last[end - 1]:
                self.ends[at] = self.ends.get(at, 0) | bit

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.conv[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """Depth first: name, depth, the parent's name, members, smallest member, words, ends."""
        everyone = (1 << len(self.conv)) - 1
        todo = []
        if self.start is not None:  # goes on from an earlier shard
            todo.append((1, self.depth[0], *self.start))
            everyone ^= 1
        if everyone:
            todo.append((everyone, 0, 0, 0))
        while todo:
            left, d, up_lo, up_hi = todo.pop()
            stops, ends = self.stops.get(d, 0), self.ends.get(d, 0)
            while left:
                i = (left & -left).bit_length() - 1
                r = self.first[i] + d - self.depth[self.first[i]]
                child = left & self.postings[d, self.lo[r], self.hi[r]]
                left ^= child
                lo, hi = (up_lo + self.lo[r]) & _MASK, (up_hi + self.hi[r]) & _MASK
                here = child & ends
                yield (_signed(lo), _signed(hi), d, _signed(up_lo), _signed(up_hi), child.bit_count(), self.conv[i],
                       self.words[r], here.bit_count(), ",".join(map(str, self.members(here))) if here else None)
                if child & ~stops:
                    todo.append((child & ~stops, d + 1, lo, hi))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in ddl.split(", "))])


def _shards_of(carried: dict[int, tuple[int, int]], shard_turns: int):
    names = ["conv_id", "depth", "lo", "hi", "words", "last"]
    schema = _arrow(_SHARD_NODES)

    def cut(batches):
        """The sorted rows of a slice, in pieces that end with a conversation where they can."""
        held, start, begun = None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch[n].to_numpy(zero_copy_only=False) for n in names]
            if not begun:
                begun, start = True, carried.get(batch["slice"][0].as_py())
            held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns)]
            while len(held[0]) >= 2 * shard_turns:
                conv = held[0]
                # after the last whole conversation of the first turns; within one if it is all there is
                at = int(np.searchsorted(conv, conv[shard_turns], "left")) or shard_turns
                piece, held = [c[:at] for c in held], [c[at:] for c in held]
                yield piece, start
                start = _sum(piece, start) if held[0][0] == piece[0][-1] else None
        if held is not None and len(held[0]):
            yield held, start

    def _sum(piece, start):
        """The node at the end of a piece of one conversation."""
        lo, hi = start or (0, 0)
        return ((lo + sum(piece[2].tolist())) & _MASK, (hi + sum(piece[3].tolist())) & _MASK)

    def run(batches):
        for piece, start in cut(batches):
            rows = list(Shard(*piece, start).nodes())
            for at in range(0, len(rows), shard_turns):
                yield _table(rows[at:at + shard_turns], schema)

    return run


def _merge(batches):
    """Rows of one node follow each other, in order of their conversations."""
    schema = _arrow(_NODES)
    now, digest, out = None, None, []

    def done():
        out.append((*now, digest.hexdigest()))

    for batch in batches:
        for lo, hi, depth, up_lo, up_hi, n, conv, words, n_ends, ends in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or (lo, hi, depth) != tuple(now[:3]):
                if now is not None:
                    done()
                now, digest, any_yet = [lo, hi, depth, up_lo, up_hi, 0, conv, words], hashlib.sha256(), False
            now[5] += n
            if n_ends:
                digest.update((b"," if any_yet else b"") + ends.encode())
                any_yet = True
        if len(out) >= SHARD_TURNS:
            yield _table(out, schema)
            out.clear()
    if now is not None:
        done()
    if out:
        yield _table(out, schema)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, key (digest of role and text), words of the text, and own: how often the row occurs."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return (rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id", "turn", "role", "key", "words")
            .agg(F.count(F.lit(1)).alias("own")))


def heads_of(turns: DataFrame, most: int) -> DataFrame:
    """The first ``most`` turns of each conversation of ``turns``, numbered from 1 (``at``)."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    first = turns.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= most)  # limited before the shuffle
    copies = first.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("own", F.lit(most)).cast("int"))))
    at = Window.partitionBy("conv_id").orderBy("_at", "_copy")
    return copies.withColumn("at", F.row_number().over(at)).where(F.col("at") <= most).select(
        "conv_id", "at", "role", "key", "words")


def numbered(turns: DataFrame, heads: DataFrame | None = None, skip: Column | None = None) -> DataFrame:
    """Every turn at its depth, with the textless root at depth 0: conv_id, depth, lo, hi (hash of position and
    turn), words, last.  ``heads`` (conv_id, at, role, key, words) stand before a conversation's own turns, of
    which the first ``skip`` (an expression over conv_id) are left out."""
    nothing = F.lit(0).cast("long")
    skip = nothing if skip is None else skip.cast("long")

    def rows(df: DataFrame, part: int, turn: Column, role, key, words, n_heads, n_own) -> DataFrame:
        return df.select("conv_id", F.lit(part).alias("part"), turn.cast("long").alias("turn"), role.alias("role"),
                         key.alias("key"), words.alias("words"), n_heads.alias("heads"), n_own.alias("own"))

    blank, one = F.lit(""), F.lit(1).cast("long")
    all_rows = rows(turns.select("conv_id").distinct(), 0, F.lit(None), blank, blank, nothing, nothing, nothing)
    all_rows = all_rows.unionByName(rows(turns, 2, F.col("turn"), F.col("role"), F.col("key"), F.col("words"), nothing, F.col("own")))
    if heads is not None:
        all_rows = all_rows.unionByName(rows(heads, 1, F.col("at"), F.col("role"), F.col("key"), F.col("words"), one, nothing))
    upto = running_in_key(all_rows, ["conv_id"], ["part", "turn", "role", "key"], {"heads_upto": "heads", "own_upto": "own"},
                          {"heads_all": "heads", "own_all": "own"})
    is_own = F.col("part") == 2
    first = F.greatest(F.col("own_upto") - F.col("own"), skip) + 1
    upto = upto.where(~is_own | (first <= F.col("own_upto")))
    upto = upto.withColumn("copy", F.explode(F.when(is_own, F.sequence(first, F.col("own_upto"))).otherwise(F.array(nothing))))
    depth = F.when(is_own, F.col("heads_all") + F.col("copy") - skip).otherwise(F.col("heads_upto"))
    total = F.col("heads_all") + F.greatest(F.col("own_all") - skip, nothing)
    at_depth = upto.select("conv_id", depth.alias("depth"), "key", "words", total.alias("total"))
    name = [F.when(F.col("depth") == 0, nothing).otherwise(F.xxhash64(F.lit(i), "depth", "key")).alias(n)
            for i, n in ((1, "lo"), (2, "hi"))]
    return at_depth.select("conv_id", "depth", *name, "words", (F.col("depth") == F.col("total")).alias("last"))


def _carried(ranged: DataFrame) -> dict[int, tuple[int, int]]:
    """For each slice that begins within a conversation the name of the node before it: at most one row per
    slice.  Sums run over 32-bit halves, so that longs hold them."""
    halves = {f"{n}{part}": F.shiftrightunsigned(n, 32) if part else F.col(n).bitwiseAND(F.lit(0xFFFFFFFF))
              for n in ("lo", "hi") for part in (0, 1)}
    totals = ranged.groupBy("slice", "conv_id").agg(*[F.sum(c).alias(n) for n, c in halves.items()])
    before = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.select("slice", *[F.sum(n).over(before).alias(n) for n in halves]).where("lo0 IS NOT NULL").collect()
    return {r.slice: tuple(((r[f"{n}1"] << 32) + r[f"{n}0"]) & _MASK for n in ("lo", "hi")) for r in rows}


def shard_nodes(turns: DataFrame, shard_turns: int = SHARD_TURNS, num_partitions: int | None = None) -> DataFrame:
    """The nodes of every shard of ``numbered`` turns: name, parent's name, members, smallest member, end list."""
    ship_package(turns.sparkSession)
    ensure_checkpoint_dir(turns.sparkSession)
    ranged = (turns.repartitionByRange(slice_count(turns, num_partitions), "conv_id", "depth")
              .sortWithinPartitions("conv_id", "depth").withColumn("slice", F.spark_partition_id()).checkpoint())
    return ranged.mapInArrow(_shards_of(_carried(ranged), shard_turns), _SHARD_NODES)


def _path_totals(paths: DataFrame, names: list[str]) -> DataFrame:
    """Sums over each path and all that hang on it, by pointer doubling: after round k a path holds the sums of
    all within 2**k steps below it, and points 2**k steps up."""
    state = paths.withColumn("to", F.col("above")).checkpoint()
    total = state.count()
    while True:
        below = state.where("to IS NOT NULL").groupBy(F.col("to").alias("_to")).agg(
            F.count(F.lit(1)).alias("_asked"), *[F.sum(n).alias(f"_s_{n}") for n in names])
        below = below.checkpoint()
        if below.isEmpty():
            return state.drop("to")
        summed = state.join(below, F.col("conv") == F.col("_to"), "left")
        up = summed.where("_asked IS NOT NULL").select("conv", F.col("to").alias("next"), "_asked")
        summed = summed.select("conv", "above", "top", *[(F.col(n) + F.coalesce(f"_s_{n}", F.lit(0))).alias(n) for n in names], "to")
        moved = lookup(summed, {"conv": "to"}, up, ["next"], "_asked", total)
        state = moved.select("conv", "above", "top", *names, F.col("next").alias("to")).checkpoint()


def trie(turns: DataFrame, shard_turns: int = SHARD_TURNS, num_partitions: int | None = None) -> DataFrame:
    """All nodes of ``numbered`` turns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.  (conv_id, depth) names a node."""
    pieces = shard_nodes(turns, shard_turns, num_partitions)
    nodes = (pieces.repartition("lo", "hi", "depth").sortWithinPartitions("lo", "hi", "depth", "conv")
             .mapInArrow(_merge, _NODES).checkpoint())
    total = nodes.count()
    children = nodes.where("depth > 0").groupBy(F.col("up_lo").alias("_lo"), F.col("up_hi").alias("_hi"),
                                                (F.col("depth") - 1).alias("_depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("_single"))
    nodes = nodes.join(children, (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi")) & (F.col("depth") == F.col("_depth")), "left")
    nodes = nodes.drop("_lo", "_hi", "_depth").fillna(0, ["n_children", "_single"]).checkpoint()
    parents = nodes.where("n_children > 0").select("lo", "hi", (F.col("depth") + 1).alias("level"), F.col("conv").alias("parent"),
                                                   F.col("n_children").alias("asked"))
    nodes = lookup(nodes, {"lo": "up_lo", "hi": "up_hi", "level": "depth"}, parents, ["parent"], "asked", total)
    nodes = nodes.select("conv", "depth", "parent", "n_convs", "n_children", "_single", "words", "ends_sha256").checkpoint()

    shared = nodes.where("n_convs > 1").withColumns({
        "leaves": F.when(F.col("n_children") == 0, 1).otherwise(F.col("_single")).cast("long"),
        "saved": (F.col("n_convs") - 1) * F.col("words")})
    is_top = F.col("parent").isNull() | (F.col("parent") != F.col("conv"))
    paths = shared.groupBy("conv").agg(F.max(F.when(is_top, F.col("parent"))).alias("above"), F.min("depth").alias("top"),
                                       F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    hung = _path_totals(paths, ["leaves", "saved"]).where("above IS NOT NULL").groupBy(
        F.col("above").alias("_conv"), (F.col("top") - 1).alias("_at")).agg(
        F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    shared = shared.join(hung, (F.col("conv") == F.col("_conv")) & (F.col("depth") == F.col("_at")), "left").withColumns({
        "leaves": F.col("leaves") + F.coalesce("_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("_saved", F.lit(0)),
        "_up": -F.col("depth")}).drop("_conv", "_at", "_leaves", "_saved")
    shared = running_in_key(shared, ["conv"], ["_up"], {"n_leaves": "leaves", "saved_tokens": "saved"}, num_partitions=num_partitions)
    alone = nodes.where("n_convs = 1").withColumns({"n_leaves": F.lit(1).cast("long"), "saved_tokens": F.lit(0).cast("long")})
    columns = [F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
               "n_leaves", "saved_tokens", "ends_sha256"]
    return shared.select(*columns).unionByName(alone.select(*columns))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the conversations as they are."""
    return trie(numbered(turns_of(conversations)))


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``numbered`` turns of rebuilt conversations: the first h turns of the conversation whose id is the next
    multiple of ``every`` towards 0, then the own turns after the first h; h = crc32(id in decimal) % ``most``."""
    turns = turns_of(conversations)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    first = heads_of(turns.where(F.col("conv_id") % every == 0), most - 1).withColumnRenamed("conv_id", "_base")
    ids = turns.select("conv_id").distinct()
    heads = ids.join(first, (F.col("conv_id") - F.col("conv_id") % every == F.col("_base")) & (F.col("at") <= h))
    return numbered(turns, heads.drop("_base"), h)
