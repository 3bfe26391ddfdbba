"""Parts that say what they hold: measured writes, pruning, buckets, compaction, retention.

The manifest keeps for each part its rows and the least and greatest value of measured
columns, so a load can tell which parts its keys may be in without opening any.

* ``append_new`` (incremental insert) looks for known keys only in parts whose key range
  meets the batch's, and takes the next surrogate key from the manifest.
* ``upsert_buckets`` (type-1 upsert) keeps a dimension in buckets by a hash of its natural
  key, one part per bucket; a batch reads the buckets it has keys in and rewrites those in
  which a row changed or is new.  All other parts stay listed as they are.
* ``compact`` merges parts of like size, tier by tier, so that a table grown by many small
  appends has few parts, and a row is rewritten about once per tier.
* ``expire`` drops old manifests, then the folders that no kept manifest names.

None of them changes a written part; each gives a ``Change`` for the caller to publish, so
that several tables change in one manifest.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import epoch_micros, ntz_lit
from strata.operators.keys import assign_keys
from strata.operators.merge import new_rows, scd1_merge
from strata.sources.tables import (MANIFESTS, Facts, Manifest, Tables, _fs, _manifest_numbers, read_manifest,
                                   read_parts, write_part)

BUCKET = "bucket"


@dataclass
class Change:
    """The folders of one table after a load, and what is known of the new ones."""

    table: str
    folders: list[str]
    facts: Facts = field(default_factory=dict)
    written: list[str] = field(default_factory=list)

    def tables(self) -> Tables:
        return {self.table: self.folders}


def ordinal(df: DataFrame, column: str) -> Column:
    """``column`` as a value that JSON holds and Python orders like Spark: numbers and texts as
    they are, times in microseconds, dates in days."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return epoch_micros(F.col(column).cast("timestamp_ntz"))
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date"))
    if isinstance(kind, T.DecimalType):
        return F.col(column).cast("double")  # monotone, so still a bound
    return F.col(column)


def _extremes(df: DataFrame, measure: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[f(ordinal(df, c)).alias(f"{n}_{c}") for c in measure
                                               for n, f in (("low", F.min), ("high", F.max))]]


def _facts(found: Mapping[str, Any], measure: Sequence[str]) -> dict[str, Any]:
    return {"rows": found["rows"], "low": {c: found[f"low_{c}"] for c in measure}, "high": {c: found[f"high_{c}"] for c in measure}}


def write_measured(df: DataFrame, root: str, layer: str, name: str, version: str, measure: Sequence[str]) -> tuple[str, Facts]:
    """Write a part; its rows and extremes are observed while it is written, without another pass."""
    seen = Observation(f"{layer}/{name}/{version}")
    folder = write_part(df.observe(seen, *_extremes(df, measure)), root, layer, name, version)
    return folder, {folder: _facts(seen.get, measure)}


def meeting(manifest: Manifest, table: str, column: str, low: Any, high: Any) -> list[str]:
    """The parts that may hold a value of ``column`` in [low, high]: all but those whose facts rule it out."""
    kept = []
    for folder in manifest.tables.get(table, []):
        facts = manifest.facts.get(folder)
        if facts and column in facts["low"]:
            least, most = facts["low"][column], facts["high"][column]
            if low is None or least is None or most < low or least > high:
                continue
        kept.append(folder)
    return kept


def highest(manifest: Manifest, table: str, column: str) -> Any:
    """The greatest value of a column that every part with rows has measured; None if one hasn't, or there is none."""
    facts = [manifest.facts.get(f, {}) for f in manifest.tables.get(table, [])]
    highs = [f.get("high", {}).get(column) for f in facts if f.get("rows") != 0]
    return max(highs) if highs and None not in highs else None


def append_new(spark: SparkSession, root: str, table: str, source: DataFrame, key: str, surrogate_key: str, version: str,
               measure: Sequence[str] = (), manifest: Manifest | None = None) -> tuple[Change, list[str]]:
    """Write the rows of ``source`` (one per key) whose key isn't in the table as one part more, numbered on from
    its greatest surrogate key.  Also returns the parts that were read: those whose keys meet the batch's."""
    manifest = manifest or read_manifest(spark, root)
    layer, name = table.split("/")
    measured = list(dict.fromkeys([key, surrogate_key, *measure]))
    folders = manifest.tables.get(table, [])
    if not folders:
        fresh, read = assign_keys(source, [key], surrogate_key).select(surrogate_key, *source.columns), []
    else:
        source = source.checkpoint()  # its keys are looked at before it is joined
        span = source.agg(F.min(ordinal(source, key)).alias("low"), F.max(ordinal(source, key)).alias("high")).first()
        read = meeting(manifest, table, key, span.low, span.high)
        target = read_parts(spark, root, read) if read else read_parts(spark, root, folders[:1]).limit(0)
        known = highest(manifest, table, surrogate_key)
        if known is None:  # a part that wasn't measured
            known = read_parts(spark, root, folders).agg(F.max(surrogate_key)).first()[0] or 0
        fresh = new_rows(target, source, key, surrogate_key, start=known + 1)
    folder, facts = write_measured(fresh, root, layer, name, version, measured)
    return Change(table, [*folders, folder], facts, [folder]), read


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, root: str, layer: str, name: str, version: str, buckets: int,
                   measure: Sequence[str]) -> Facts:
    """One folder per bucket, each a part of its own; without rows, one empty part that is in none."""
    spark = rows.sparkSession
    base = write_part(rows.repartition(buckets, BUCKET), root, layer, name, version, partition_by=[BUCKET])
    if not any(inner.startswith(f"{BUCKET}=") for inner, _ in _folders_below(spark, f"{root}/{base}")):
        base = write_part(rows.drop(BUCKET).limit(0), root, layer, name, f"{version}-empty")
        none = dict.fromkeys(measure)
        return {base: {"rows": 0, "low": none, "high": none, BUCKET: [-1, buckets]}}
    written = spark.read.parquet(f"{root}/{base}")
    held = written.groupBy(BUCKET).agg(*_extremes(written, measure)).collect()  # one row per bucket
    return {f"{base}/{BUCKET}={r[BUCKET]}": _facts(r, measure) | {BUCKET: [r[BUCKET], buckets]} for r in held}


def upsert_buckets(spark: SparkSession, root: str, table: str, source: DataFrame, key: str, tracked: Mapping[str, Any],
                   surrogate_key: str, stamp_col: str, batch_ts: Any, version: str, buckets: int = 64,
                   manifest: Manifest | None = None) -> Change:
    """Type-1 upsert of ``source`` (one row per key, the table's data columns) into a bucketed table: see
    ``merge.upsert_scd1`` for the rules.  The number of buckets is the table's once it has parts; it bounds what
    one changed row makes the batch rewrite, so choose it for parts of some 100 MB."""
    manifest = manifest or read_manifest(spark, root)
    layer, name = table.split("/")
    folders = manifest.tables.get(table, [])
    measure = [key, surrogate_key]
    placed = {folder: manifest.facts.get(folder, {}).get(BUCKET) for folder in folders}
    if not folders:
        keyed = assign_keys(source, [key], surrogate_key, key_type="long").withColumn(stamp_col, ntz_lit(batch_ts))
        columns = [surrogate_key, *source.columns, stamp_col]
        facts = _write_buckets(keyed.select(*columns, bucket_of(key, buckets).alias(BUCKET)), root, layer, name, version, buckets, measure)
        return Change(table, sorted(facts), facts, sorted(facts))
    if None in placed.values():  # a table that isn't in buckets yet: all of it is rewritten, once
        read, came = folders, set(range(buckets))
    else:
        buckets = next(iter(placed.values()))[1]
        came = {r[0] for r in source.select(bucket_of(key, buckets)).distinct().collect()}  # at most one row per bucket
        read = [f for f in folders if placed[f][0] in came]
    target = read_parts(spark, root, read) if read else read_parts(spark, root, folders[:1]).limit(0)
    merged = scd1_merge(target, source, key, tracked, stamp_col, batch_ts).withColumn(BUCKET, bucket_of(key, buckets))
    touched = came if None in placed.values() else {
        r[0] for r in merged.where("_new OR _takes").select(BUCKET).distinct().collect()}
    if not touched:
        return Change(table, folders)
    known = highest(manifest, table, surrogate_key)
    if known is None:
        known = read_parts(spark, root, folders).agg(F.max(surrogate_key)).first()[0] or 0
    mine = merged.where(F.col(BUCKET).isin(sorted(touched)))
    new = assign_keys(mine.where("_new").drop(surrogate_key), [key], surrogate_key, start=known + 1,
                      key_type=target.schema[surrogate_key].dataType.simpleString())
    columns = [*target.columns, BUCKET]
    rows = mine.where("NOT _new").select(*columns).unionByName(new.select(*columns))
    facts = _write_buckets(rows, root, layer, name, version, buckets, measure)
    return Change(table, [f for f in folders if f not in read or placed[f] and placed[f][0] not in touched] + sorted(facts),
                  facts, sorted(facts))


def _tier(rows: int, least: int, fan: int) -> int:
    return 0 if rows <= least else int(math.log(rows / least, fan) + 1e-9) + 1


def _added(counts) -> list[list]:
    """Sums of [rule, kind, violating rows] over parts."""
    out: dict[tuple[str, str], int] = {}
    for part in counts:
        for rule, kind, n in part:
            out[rule, kind] = out.get((rule, kind), 0) + n
    return [[rule, kind, n] for (rule, kind), n in out.items()]


def compact(spark: SparkSession, root: str, table: str, version: str, fan: int = 4, least: int = 100_000,
            rows_per_file: int = 5_000_000, manifest: Manifest | None = None) -> Change:
    """Merge parts of one size tier (rows, in powers of ``fan`` above ``least``) wherever a tier, or a bucket's,
    has ``fan`` of them or more.  Rows and keys stay what they are; the merged part's facts follow from those of
    its parts.  Readers of the manifest before keep reading the parts it names."""
    manifest = manifest or read_manifest(spark, root)
    layer, name = table.split("/")
    folders, facts = list(manifest.tables.get(table, [])), manifest.facts
    groups: dict[Any, list[str]] = {}
    for folder in folders:
        known = facts.get(folder)
        if known:
            groups.setdefault((_tier(known["rows"], least, fan), tuple(known.get(BUCKET) or ())), []).append(folder)
    change = Change(table, folders)
    for number, (_, small) in enumerate(sorted(g for g in groups.items() if len(g[1]) >= fan)):
        rows = sum(facts[f]["rows"] for f in small)
        whole = read_parts(spark, root, small).coalesce(max(1, math.ceil(rows / rows_per_file)))
        part = write_part(whole, root, layer, name, f"{version}-{number}")
        merged = {"rows": rows}
        for side, best in (("low", min), ("high", max)):
            columns = set.intersection(*(set(facts[f][side]) for f in small))
            values = {c: [v for f in small if (v := facts[f][side][c]) is not None] for c in sorted(columns)}
            merged[side] = {c: best(v) if v else None for c, v in values.items()}
        checks = [facts[f].get("checks", {}) for f in small]
        both = set.intersection(*(set(c) for c in checks))  # what was counted of all parts adds up, but for keys
        merged["checks"] = {g: _added(c[g] for c in checks) for g in sorted(both) if not g.startswith("PK_")}
        if BUCKET in facts[small[0]]:
            merged[BUCKET] = facts[small[0]][BUCKET]
        at = change.folders.index(small[0])
        change.folders = [f for f in [*change.folders[:at], part, *change.folders[at:]] if f not in small]
        change.facts[part] = merged
        change.written.append(part)
    return change


def _folders_below(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(hpath) if s.isDirectory()]


def expire(spark: SparkSession, root: str, keep: int = 3, min_age_seconds: float = 86_400) -> list[str]:
    """Keep the last ``keep`` manifests; remove the others, then every folder of their tables that no kept manifest
    names and that nothing was written to for ``min_age_seconds`` (a load on its way has folders that no manifest names yet).
    Returns what was removed, relative to the root.  A reader of a kept manifest loses nothing."""
    if keep < 1:
        raise ValueError("keep at least the current manifest")
    numbers = _manifest_numbers(spark, root)
    manifests = [read_manifest(spark, root, n) for n in numbers]
    kept = manifests[-keep:]
    named = {folder for m in kept for folders in m.tables.values() for folder in folders}
    tables = sorted({table for m in manifests for table in m.tables})  # what else lies in the root isn't ours
    removed = [f"{MANIFESTS}/{n:09d}" for n in numbers[:-keep]]
    before = time.time() - min_age_seconds
    for table in tables:
        for version, written in _folders_below(spark, f"{root}/{table}"):
            folder = f"{table}/{version}"
            if folder in named or written > before:
                continue
            inner = [f"{folder}/{b}" for b, _ in _folders_below(spark, f"{root}/{folder}") if b.startswith(f"{BUCKET}=")]
            removed += [b for b in inner if b not in named] if named & set(inner) else [folder]
    for path in removed:
        fs, hpath = _fs(spark, f"{root}/{path}")
        fs.delete(hpath, True)
    return removed
