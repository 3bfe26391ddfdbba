"""The ten business questions, as functions over fact/dimension DataFrames.

The source states them in English only; the definitions fixed here:

* Q1 encounters per calendar year of the start timestamp.
* Q2 per year, each class's share of that year's encounters (percent, unrounded).
* Q3 share of encounters whose elapsed time exceeds 24 h (exactly 24 h counts as under).
* Q4 encounters with zero coverage (on the raw value; the silver floor turns 0 into 1).
* Q5/Q6 top-k procedure codes by frequency / by average cost, ties by code.
* Q7 average claim per payer.
* Q8 distinct patients per (year, quarter).
* Q9/Q10 readmission: an encounter whose start lies 0..30 days after the latest stop of
  the same patient's earlier encounters.

Money averages are exact: sums run in decimal and one final division happens in double.
Aggregations run before joins to dimensions, so the fact side is reduced map-side first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import elapsed_micros
from strata.operators.sequence import running_max_before

_DAY_MICROS = 86_400_000_000


def exact_avg(value: str, scale: int = 2) -> Column:
    """Average of a money column: decimal sum (order independent) / count, as double."""
    total = F.sum(F.col(value).cast(f"decimal(18,{scale})"))
    return total.cast("double") / F.count(F.col(value)).cast("double")


def percent(part: Column, whole: Column) -> Column:
    return part.cast("double") * 100 / whole.cast("double")


def encounters_per_year(df: DataFrame, start: str) -> DataFrame:
    return (df.groupBy(F.year(start).alias("calendar_year"))
            .agg(F.count(F.lit(1)).alias("n_encounters")))


def class_share(df: DataFrame, start: str, cls: str, class_name: str = "encounter_class") -> DataFrame:
    counts = (df.groupBy(F.year(start).alias("calendar_year"), F.col(cls).alias(class_name))
              .agg(F.count(F.lit(1)).alias("n_encounters")))
    # the window runs over the aggregated (year, class) rows only
    from pyspark.sql import Window

    year_total = F.sum("n_encounters").over(Window.partitionBy("calendar_year"))
    return counts.withColumn("pct_of_year", F.round(percent(F.col("n_encounters"), year_total), 2))


def duration_share(df: DataFrame, start: str, stop: str, threshold_hours: float = 24.0) -> DataFrame:
    """One row: n_over, n_under, pct_over, pct_under (rows with a NULL stop are left out)."""
    gap = elapsed_micros(start, stop)
    limit = int(threshold_hours * 3_600_000_000)
    counted = df.filter(F.col(stop).isNotNull()).agg(
        F.count_if(gap > limit).alias("n_over"), F.count_if(gap <= limit).alias("n_under"))
    total = F.col("n_over") + F.col("n_under")
    return counted.select("n_over", "n_under", percent(F.col("n_over"), total).alias("pct_over"),
                          percent(F.col("n_under"), total).alias("pct_under"))


def zero_share(df: DataFrame, value: str) -> DataFrame:
    counted = df.agg(F.count_if(F.col(value) == 0).alias("n_zero"), F.count(F.lit(1)).alias("n_total"))
    return counted.select("n_zero", "n_total", percent(F.col("n_zero"), F.col("n_total")).alias("pct_zero"))


def code_stats(df: DataFrame, code: str, cost: str, *more: str) -> DataFrame:
    return df.groupBy(code, *more).agg(F.count(F.lit(1)).alias("n_procedures"),
                                exact_avg(cost).alias("avg_base_cost"))


def top_codes(stats: DataFrame, code: str, by: str, k: int) -> DataFrame:
    """Top ``k`` rows of ``by`` descending, ties by code (a distributed top-k)."""
    return stats.orderBy(F.col(by).desc(), F.col(code).asc()).limit(k)


def name_codes(top: DataFrame, code: str, names: DataFrame, names_key: str, name_col: str) -> DataFrame:
    """Attach a name to the top codes.  No broadcast is forced: the planner measures both sides."""
    n = names.select(F.col(names_key).alias("_nk"), F.col(name_col))
    return top.join(n, F.col(code) == F.col("_nk"), "inner").drop("_nk")


def avg_by_member(facts: DataFrame, fk: str, value: str, dim: DataFrame, dim_natural_key: str,
                  dim_key: str, dim_name: str, count_name: str = "n_encounters",
                  avg_name: str = "avg_total_claim_cost") -> DataFrame:
    """Average of ``value`` per dimension member (inner join, so members without facts
    are absent).  Facts are aggregated by the natural key before the join."""
    per_fk = (facts.groupBy(F.col(fk).alias("_fk"))
              .agg(F.count(F.lit(1)).alias(count_name), exact_avg(value).alias(avg_name)))
    d = dim.select(F.col(dim_natural_key).alias("_nk"), F.col(dim_key).alias("_dk"), F.col(dim_name).alias("_dn"))
    return per_fk.join(d, F.col("_fk") == F.col("_nk"), "inner").select(
        F.col("_dk").alias(dim_key), F.col("_dn").alias(dim_name), count_name, avg_name)


def distinct_per_quarter(df: DataFrame, start: str, entity: str, cls: str | None = None,
                         classes: Sequence[str] | None = None) -> DataFrame:
    """Distinct entities per quarter; only rows whose ``cls`` is one of ``classes``, if given."""
    if classes is not None:
        df = df.filter(F.col(cls).isin(*classes))
    return (df.groupBy(F.year(start).alias("calendar_year"), F.quarter(start).alias("calendar_quarter"))
            .agg(F.countDistinct(entity).alias("n_patients")))


def quarter_of(start: str) -> list[Column]:
    return [F.year(start).alias("calendar_year"), F.quarter(start).alias("calendar_quarter")]


def distinct_bitmaps(df: DataFrame, groups: Sequence[Column], key: str) -> DataFrame:
    """Which surrogate keys occur in each group, as bitmaps: ``groups``, ``bucket``, ``bits``.  Keys are dense
    numbers from 1, so a bitmap of 4 KB stands for 32,768 of them.  The rows are a state that can be stored with
    a part and merged with that of others (``merged_bitmaps``) without reading the part again."""
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(F.col(key)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits"))


def merged_bitmaps(states: Sequence[DataFrame]) -> DataFrame:
    """One state of several of the same groups."""
    out = states[0]
    for state in states[1:]:
        out = out.unionByName(state)
    return out.groupBy(*[c for c in out.columns if c != "bits"]).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_of_bitmaps(state: DataFrame, count_name: str = "n_patients") -> DataFrame:
    """The exact number of distinct keys per group."""
    groups = [c for c in state.columns if c not in ("bucket", "bits")]
    return state.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(count_name))


def readmission_rows(df: DataFrame, patient: str, start: str, stop: str, order: Sequence[str],
                     days: int = 30, bucket: Column | None = None) -> DataFrame:
    """Encounters that start 0..``days`` days after the latest stop of the same patient's
    earlier encounters (earlier in ``order``).  The running max is computed per range slice
    of (patient, order) plus a small per-patient stitch, so a patient with a huge history,
    or with many encounters at one instant, is spread over many tasks."""
    with_prev = running_max_before(df, patient, list(order), stop, "_prev_stop", bucket)
    gap = elapsed_micros(F.col("_prev_stop"), F.col(start))
    return with_prev.filter(F.col("_prev_stop").isNotNull() & (gap >= 0) & (gap <= days * _DAY_MICROS))


def readmission_summary(rows: DataFrame, patient: str) -> DataFrame:
    return rows.agg(F.countDistinct(patient).alias("readmitted_patients"),
                    F.count(F.lit(1)).alias("readmissions"))


def most_readmissions(rows: DataFrame, patient: str, k: int = 10) -> DataFrame:
    per = rows.groupBy(patient).agg(F.count(F.lit(1)).alias("n_readmissions"))
    return per.orderBy(F.col("n_readmissions").desc(), F.col(patient).asc()).limit(k)


# the gold tables that each question reads
QUESTION_TABLES = {
    "q01_per_year": ("fact_encounters",), "q02_class_share": ("fact_encounters",), "q03_over_24h": ("fact_encounters",),
    "q04_zero_coverage": (), "q05_top_frequent": ("fact_procedures",), "q06_top_cost": ("fact_procedures",),
    "q07_claim_by_payer": ("fact_encounters", "dim_payers"), "q08_patients_per_quarter": ("fact_encounters",),
    "q09_readmitted_30d": ("fact_encounters",), "q10_most_readmissions": ("fact_encounters",),
}


def gold_questions(gold: dict[str, DataFrame], bronze_encounters: DataFrame | None = None,
                   k: int = 10, classes: Sequence[str] | None = None, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Q1-Q10, or those of ``names``, over the published gold star schema (``gold_tables`` output; only the
    tables of ``QUESTION_TABLES`` are needed).  Q4 needs the bronze encounters, because silver raises a zero
    coverage to 1; it is left out without them."""
    def enc() -> DataFrame:
        return gold["fact_encounters"]

    def stats() -> DataFrame:
        # a code has one canonical description, so grouping by both is grouping by the code
        return code_stats(gold["fact_procedures"], "procedure_code", "base_procedure_cost", "procedure_description")

    def readmits() -> DataFrame:
        return readmission_rows(enc(), "patient_key", "encounter_start", "encounter_stop", ["encounter_start", "encounter_key"])

    wanted = [n for n in sorted(names or QUESTION_TABLES) if n != "q04_zero_coverage" or bronze_encounters is not None]
    both = readmits() if {"q09_readmitted_30d", "q10_most_readmissions"} & set(wanted) else None  # sliced once for both
    make = {
        "q01_per_year": lambda: encounters_per_year(enc(), "encounter_start"),
        "q02_class_share": lambda: class_share(enc(), "encounter_start", "encounterclass"),
        "q03_over_24h": lambda: duration_share(enc(), "encounter_start", "encounter_stop", 24.0),
        "q04_zero_coverage": lambda: zero_share(bronze_encounters, "PAYER_COVERAGE"),
        "q05_top_frequent": lambda: top_codes(stats(), "procedure_code", "n_procedures", k),
        "q06_top_cost": lambda: top_codes(stats(), "procedure_code", "avg_base_cost", k),
        "q07_claim_by_payer": lambda: avg_by_member(enc(), "payer_key", "total_claim_cost", gold["dim_payers"], "payer_key",
                                                    "payer_key", "payer_name"),
        "q08_patients_per_quarter": lambda: distinct_per_quarter(enc(), "encounter_start", "patient_key", "encounterclass", classes),
        "q09_readmitted_30d": lambda: readmission_summary(both, "patient_key"),
        "q10_most_readmissions": lambda: most_readmissions(both, "patient_key", k),
    }
    return {name: make[name]() for name in wanted}
