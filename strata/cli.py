"""Command line for scheduled runs (``spark-submit strata/cli.py refresh ...``).

    refresh   --src <landing folder> --root <warehouse root> [--batch-ts ISO] [--version V]
              [--max-errors N] [--database D]  (rejected rows that a file may have; lasting views)
    maintain  --root <warehouse root> [--keep N]  (compact appended tables, drop old manifests and
                                                what only they name)
    questions --root <warehouse root>          (Q1-Q10 over the published gold layer; each answer is
                                                written as a table under answers/ and printed in full)
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.questions import gold_questions  # noqa: E402
from strata.plans.refresh import maintain, run_refresh  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata import schemas  # noqa: E402
from strata.sources.csv_bronze import MAX_ERRORS, good_rows  # noqa: E402
from strata.sources.tables import current_tables, read_layer, read_parts, unique_version, write_part  # noqa: E402


def print_rows(title: str, df: DataFrame) -> None:
    """All rows, in order; the driver holds one partition at a time."""
    print(title)
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="CSV -> bronze -> silver -> gold -> checks -> publish")
    r.add_argument("--src", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--batch-ts", default=None, help="load stamp, ISO text (default: now)")
    r.add_argument("--version", default=None)
    r.add_argument("--max-errors", type=int, default=MAX_ERRORS)
    r.add_argument("--database", default=None, help="catalog database for views that outlive the session")
    m = sub.add_parser("maintain", help="compaction and retention")
    m.add_argument("--root", required=True)
    m.add_argument("--keep", type=int, default=7, help="manifests to keep")
    q = sub.add_parser("questions", help="the ten business questions over the published gold layer")
    q.add_argument("--root", required=True)
    args = parser.parse_args(argv)

    spark = build_session(app_name=f"strata-{args.command}")
    if args.command == "refresh":
        ts = dt.datetime.fromisoformat(args.batch_ts) if args.batch_ts else dt.datetime.now().replace(microsecond=0)
        out = run_refresh(spark, args.src, args.root, ts, args.version, args.max_errors, args.database)
        print_rows("load audit", out["audit"].orderBy("layer", "table_name"))  # one row per table
        print_rows("constraints", out["report"])  # one row per rule
        return 0
    if args.command == "maintain":
        for what, folders in maintain(spark, args.root, args.keep).items():
            print(what, *folders, sep="\n  ")
        return 0
    gold = {n: read_layer(spark, args.root, "gold", n)
            for n in ("dim_payers", "dim_patients", "fact_encounters", "fact_procedures")}
    parts = current_tables(spark, args.root)["bronze/encounters"]
    bronze = good_rows(spark, f"{args.root}/{parts[0]}", schemas.BRONZE["encounters"])
    version = unique_version("answers")
    for name, df in gold_questions(gold, bronze).items():
        part = write_part(df, args.root, "answers", name, version)
        # what was written, printed in full, row by row as it arrives
        print_rows(f"{name} ({part})", read_parts(spark, args.root, [part]).orderBy(*df.columns))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
