"""Incremental validation: what was checked of a part stays checked.

Parts never change, so the violations of a rule in a part are counted once and kept in the
manifest beside the part's facts ("trusted" for this rule).  A check after a load reads the
new parts only; the report adds what is known of the others.

* Rules about single rows (NOT NULL, LENGTH, any condition) and foreign keys into a dimension
  that never loses members add up over parts.
* A key is unique if it is within each part and the parts' measured key ranges don't meet;
  parts whose ranges meet are counted together.

``forget`` takes the trust off, for a dimension that did lose members or a rule that changed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import constraints as C
from strata.sources.tables import Facts, Manifest, read_manifest, read_parts

#: name of a group of rules -> what gives one report row per rule (``operators.constraints``)
Checks = Mapping[str, Callable[[DataFrame], DataFrame]]
REPORT = ("table_name string, rule string, kind string, violating_rows long, ok boolean, n_parts int, "
          "trusted_parts int")


def _meeting_parts(manifest: Manifest, folders: list[str], key: str) -> list[list[str]]:
    """Groups of two parts or more whose measured ranges of ``key`` meet; parts without facts meet all."""
    known = [f for f in folders if manifest.facts.get(f, {}).get("rows") != 0]
    if any(key not in manifest.facts.get(f, {}).get("low", {}) for f in known):
        return [known] if len(known) > 1 else []
    spans = sorted((manifest.facts[f]["low"][key], manifest.facts[f]["high"][key], f) for f in known
                   if manifest.facts[f]["low"][key] is not None)
    groups: list[list[str]] = []
    reach = None
    for low, high, folder in spans:
        if reach is not None and low <= reach:
            groups[-1].append(folder)
        else:
            groups.append([folder])
        reach = high if reach is None else max(reach, high)
    return [g for g in groups if len(g) > 1]


def validate(spark: SparkSession, root: str, table: str, checks: Checks, key: str | None = None,
             manifest: Manifest | None = None) -> tuple[DataFrame, Facts, list[str]]:
    """The report over all parts of a table, the facts to publish with it, and the parts that were read.  ``key``:
    a column that must be unique and not NULL (rule ``PK_<table>``)."""
    manifest = manifest or read_manifest(spark, root)
    folders, name = manifest.tables.get(table, []), table.split("/")[-1]
    groups = dict(checks)
    if key:
        groups[f"PK_{name}"] = lambda df: C.pk_rule(df, [key], name, f"PK_{name}")
    facts, read, sums, trusted = {}, [], {}, {}
    for folder in folders:
        known = dict(manifest.facts.get(folder, {}))
        done = dict(known.get("checks", {}))
        missing = [g for g in groups if g not in done]
        if missing:
            part = read_parts(spark, root, [folder])
            for group in missing:
                done[group] = [[r.rule, r.kind, r.violating_rows] for r in groups[group](part).collect()]  # one per rule
            facts[folder] = known | {"checks": done}
            read.append(folder)
        for group in groups:
            for rule, kind, violating in done[group]:
                sums[rule, kind] = sums.get((rule, kind), 0) + violating
                trusted[rule, kind] = trusted.get((rule, kind), 0) + (group not in missing)
    if key:
        for together in _meeting_parts(manifest, folders, key):
            within = sum(v for f in together for _, _, v in (facts.get(f) or manifest.facts[f])["checks"][f"PK_{name}"])
            whole = C.pk_rule(read_parts(spark, root, together), [key], name, f"PK_{name}").first().violating_rows
            sums[f"PK_{name}", "PRIMARY KEY"] += whole - within
            trusted[f"PK_{name}", "PRIMARY KEY"] -= sum(f not in read for f in together)
            read += [f for f in together if f not in read]
    rows = [(name, rule, kind, n, n == 0, len(folders), trusted[rule, kind]) for (rule, kind), n in sums.items()]
    report = spark.createDataFrame(rows, REPORT).orderBy(F.col("kind").desc(), "table_name", "rule")
    return report, facts, read


def forget(manifest: Manifest, table: str, *groups: str) -> Facts:
    """The facts of a table's parts without the trust in some groups of rules (in all, if none is named)."""
    out = {}
    for folder in manifest.tables.get(table, []):
        known = manifest.facts.get(folder, {})
        if "checks" in known:
            out[folder] = known | {"checks": {g: v for g, v in known["checks"].items() if groups and g not in groups}}
    return out
