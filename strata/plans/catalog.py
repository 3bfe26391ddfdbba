"""Registered queries over the driver's tables, one per operator of the inventory.

Role mapping (the warehouse's entities played by the TPC-H-like tables):

* patients <- ``customer`` (id ``c_custkey``); payers <- ``supplier`` (id ``s_suppkey``);
  states lookup <- ``nation``;
* encounters <- ``orders`` (start ``o_orderdate``) and, for minute-level timing,
  ``events`` (one user's consecutive events);
* procedures <- ``lineitem`` joined to ``orders`` (START = o_orderdate,
  STOP = l_shipdate, PATIENT = o_custkey, ENCOUNTER = l_orderkey) and ``part``
  (CODE = p_type, DESCRIPTION = p_name);
* money: claim = ``l_extendedprice``, coverage <- ``l_discount``;
* the silver loads read files shaped like the raw CSVs, derived from the same tables:
  payers <- suppliers (without a state unless in good standing), patients <- ``customer``, encounters <-
  ``orders`` with STOP = the order's last ship date (see ``bronze_*`` below).

Every query reads whole tables; nothing is sampled or capped except the top-k reports,
where the limit is the feature.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import expr as X
from strata.operators import canonical, constraints, quality, refint
from strata.operators.calendar import date_dimension
from strata.operators.collation import as_stored, compare_as
from strata.operators.dedupe import duplicate_groups, duplicate_members, first_per_key
from strata.operators.keys import assign_keys
from strata.operators.merge import ensure_placeholder, incremental_insert, infer_missing_members, new_rows, upsert_scd1
from strata.operators.outliers import cap_outliers, iqr_bounds, order_statistics
from strata.operators.sequence import next_in_key
from strata.plans import questions as Q
from strata.plans.silver import silver_encounters, silver_patients, silver_payers, silver_procedures
from strata import schemas
from strata.session import ensure_checkpoint_dir, stored
from strata.sources.audit import load_audit, observed
from strata.sources.csv_bronze import REJECTED, file_verdicts, good_rows, read_bronze, rejected_rows
from strata.sources.lookups import us_states
from strata.sources.parts import append_new, compact, upsert_buckets
from strata.sources.tables import (create_views, current_tables, open_warehouse, preview, publish, read_layer, read_manifest,
                                   unique_version, write_part)
from strata.sources.trust import validate

LINE_KEY = ["l_orderkey", "l_linenumber"]

# Fixed values of the scenario queries (batch stamps, cut-over date, labels).
BATCH1_TS = dt.datetime(2024, 1, 1)
BATCH2_TS = dt.datetime(2024, 2, 1)
LOADED_BEFORE = dt.datetime(1999, 1, 1)
INFERRED_NAME = "Unknown Payer / Auto-Generated"
PLACEHOLDER_NAME = "No Payer / Self-Pay"
SEGMENT_LABELS = {"BUILDING": "Construction", "MACHINERY": "Industrial"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ shared inputs
def line_durations(spark: SparkSession, d: str) -> DataFrame:
    """lineitem x orders with the procedure duration in minutes (boundary counting)."""
    li = table(spark, d, "lineitem").select(*LINE_KEY, "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(*LINE_KEY, "o_orderdate", "l_shipdate",
                    X.minute_diff("o_orderdate", "l_shipdate").alias("duration_min")))


def bronze_procedures(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, d, "part").select("p_partkey", "p_type", "p_name")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("o_orderdate").alias("START"), F.col("l_shipdate").alias("STOP"),
                    F.col("o_custkey").alias("PATIENT"), F.col("l_orderkey").alias("ENCOUNTER"),
                    F.col("p_type").alias("CODE"), F.col("p_name").alias("DESCRIPTION"),
                    F.col("l_extendedprice").cast("int").alias("BASE_COST")))


def user_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Each event with the same user's next event time."""
    ev = table(spark, d, "events").select("event_id", "user_id", "ts")
    return next_in_key(ev, "user_id", ["ts", "event_id"], "ts", "next_ts")


def keyed_customers(spark: SparkSession, d: str) -> DataFrame:
    return assign_keys(table(spark, d, "customer"), ["c_custkey"], "customer_key")


def payer_dim(spark: SparkSession, d: str) -> DataFrame:
    """Silver payers from ``supplier``: dedupe by id, keep only ids whose state is in the
    lookup (inner join), surrogate keys, the key-0 placeholder, and inferred members for
    payer ids used by facts but missing here."""
    sup = first_per_key(table(spark, d, "supplier").filter(F.col("s_suppkey").isNotNull()), ["s_suppkey"])
    states = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("payer_state"))
    enriched = sup.join(states, F.col("s_nationkey") == F.col("n_nationkey"), "inner").select(
        F.col("s_suppkey").alias("payer_id"), F.col("s_name").alias("payer_name"), "payer_state")
    keyed = assign_keys(enriched, ["payer_id"], "payer_key").select("payer_key", "payer_id", "payer_name",
                                                                     "payer_state")
    with_zero = ensure_placeholder(keyed, {"payer_key": 0, "payer_id": -1, "payer_name": PLACEHOLDER_NAME,
                                           "payer_state": "Not Applicable"}, "payer_key")
    return infer_missing_members(with_zero, table(spark, d, "lineitem"), "l_suppkey", "payer_id", "payer_key",
                                 {"payer_name": INFERRED_NAME, "payer_state": "Not Applicable"})


def coverage_columns(li: DataFrame) -> DataFrame:
    """Money columns in decimal(10,2): base cost = price - 1000 * quantity (can be <= 0),
    claim = price, coverage = price + (100 * discount - 5) * 1000 (0 when the discount is
    low, above the claim when it is high)."""
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    qty = (F.col("l_quantity") * 1000).cast("decimal(10,2)")
    step = F.round(F.col("l_discount") * 100).cast("int") - 5
    return li.select(*LINE_KEY,
                     (price - qty).cast("decimal(10,2)").alias("base_cost_raw"),
                     price.alias("total_claim"),
                     (price + step * 1000).cast("decimal(10,2)").alias("coverage_raw"))


# ------------------------------------------------------------------- W1 / W2 / N1
def q_dedupe_by_id(spark, d):
    return first_per_key(table(spark, d, "lineitem"), LINE_KEY)


def q_dedupe_latest(spark, d):
    order = [("l_shipdate", "desc"), ("l_partkey", "asc"), ("l_suppkey", "asc"), ("l_extendedprice", "asc")]
    return first_per_key(table(spark, d, "lineitem"), LINE_KEY, order)


def q_canonical_description(spark, d):
    return canonical.canonical_description(table(spark, d, "part"), "p_type", "p_name")


def q_ambiguous_codes(spark, d):
    return canonical.ambiguous_codes(table(spark, d, "part"), "p_name", "p_type")


# --------------------------------------------------------------- A6 / O-IQR / X3-X5
def q_iqr_limit(spark, d):
    return iqr_bounds(line_durations(spark, d), "duration_min")


def q_capped_duration(spark, d):
    dur = line_durations(spark, d)
    return cap_outliers(dur, "duration_min", "cleaned_duration", iqr_bounds(dur, "duration_min")).select(
        *LINE_KEY, "duration_min", "cleaned_duration")


def q_negative_durations(spark, d):
    return line_durations(spark, d).filter(F.col("duration_min") < 0)


def q_longest_durations(spark, d):
    return quality.longest(line_durations(spark, d), "duration_min", 100, LINE_KEY)


# ----------------------------------------------------------------- F2-F20 scalars
def q_minute_boundaries(spark, d):
    g = user_gaps(spark, d).filter(F.col("next_ts").isNotNull())
    return g.select("event_id", "user_id", "ts", "next_ts", X.minute_diff("ts", "next_ts").alias("minutes"))


def q_sliced_gaps(spark, d):
    """The gaps again with every busy day of a user cut into time slices of a few rows."""
    return next_in_key(table(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"],
                       "ts", "next_ts", unit="month", target_rows=2)


def q_burst_gaps(spark, d):
    """The gaps again with a third of each user's events at one instant: the event's number
    alone orders them."""
    burst = F.when(F.col("event_id") % 3 == 0, X.ntz_lit(BATCH1_TS)).otherwise(F.col("ts"))
    return next_in_key(table(spark, d, "events").select("event_id", "user_id", burst.alias("ts")), "user_id",
                       ["ts", "event_id"], "event_id", "next_event")


def q_percentiles_distinct(spark, d):
    """Percentiles of values that are all different: the orders' numbers, spread by a product."""
    spread = (F.col("o_orderkey") * 7919) % 1_000_003
    return order_statistics(table(spark, d, "orders").select((spread * 1_000_000 + F.col("o_orderkey")).alias("v")),
                            "v", [0.0, 0.1, 0.5, 0.99, 1.0])


def q_age_by_year(spark, d):
    dur = line_durations(spark, d)
    return dur.select(*LINE_KEY, X.year_diff("o_orderdate", "l_shipdate").alias("years_between"))


def q_title_case(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.title_or("p_name", "Unknown").alias("name_title"),
                    X.title_or("p_type", "Unknown").alias("type_title"))


def q_recode_segment(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", X.recode("c_mktsegment", SEGMENT_LABELS, "Unknown").alias("segment_label"))


def q_person_name(spark, d):
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    prefix = F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD"))
    return j.select("c_custkey", X.person_name(prefix, "c_name", "n_name").alias("person_name"))


def q_floor_and_cap(spark, d):
    m = coverage_columns(table(spark, d, "lineitem"))
    return m.select(*LINE_KEY,
                    X.floor_to_one("base_cost_raw", "decimal(10,2)").alias("base_cost"),
                    "total_claim",
                    X.cap_coverage("coverage_raw", "total_claim", "decimal(10,2)").alias("payer_coverage"))


# --------------------------------------------------------------------- J1-J8, K1
def _positive_customers(spark, d):
    return table(spark, d, "customer").filter(F.col("c_acctbal") > 0)


def q_keep_referenced(spark, d):
    return refint.keep_referenced(table(spark, d, "orders"), "o_custkey", _positive_customers(spark, d),
                                  "c_custkey")


def q_keep_new(spark, d):
    o = table(spark, d, "orders")
    loaded = o.filter(F.col("o_orderdate") < X.ntz_lit(LOADED_BEFORE))
    return refint.keep_new(o, loaded, "o_orderkey")


def q_orphans(spark, d):
    return refint.orphan_keys(table(spark, d, "orders"), "o_custkey", _positive_customers(spark, d), "c_custkey")


def q_orphan_counts(spark, d):
    o = table(spark, d, "orders")
    orphans = refint.orphan_keys(o, "o_custkey", _positive_customers(spark, d), "c_custkey")
    return refint.rows_with_orphans(o, "o_custkey", orphans)


def q_not_in_null_aware(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    with_nulls = c.select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("c_custkey"))
    n_not_in = refint.not_in(o, F.col("o_custkey"), with_nulls, "c_custkey").agg(
        F.count(F.lit(1)).alias("n_not_in"))
    n_not_exists = refint.keep_new(o, _positive_customers(spark, d), "o_custkey", "c_custkey").agg(
        F.count(F.lit(1)).alias("n_not_exists"))
    return n_not_in.select("n_not_in", n_not_exists.scalar().alias("n_not_exists"))


def q_lookup_keys(spark, d):
    keys = keyed_customers(spark, d)
    return refint.lookup_key(table(spark, d, "orders"), "o_custkey", keys, "c_custkey", "customer_key").select(
        "o_orderkey", "customer_key")


def q_enrich_state(spark, d):
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("state_name"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "inner").select(
        "s_suppkey", "s_name", "s_nationkey", "state_name")


def q_surrogate_keys(spark, d):
    return keyed_customers(spark, d).select("c_custkey", "customer_key")


# ------------------------------------------------------------------------ M1-M4
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def q_scd1_upsert(spark, d):
    c = table(spark, d, "customer")
    v1 = assign_keys(c.filter(F.col("c_acctbal") > 0).select(*CUSTOMER_COLS), ["c_custkey"], "customer_key")
    target = v1.select("customer_key", *CUSTOMER_COLS,
                       X.ntz_lit(BATCH1_TS).alias("updated_at"))
    seg = F.when(F.col("c_nationkey") == 1, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    source = c.filter(F.col("c_nationkey") != 0).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", seg.alias("c_mktsegment"))
    tracked = {"c_name": "", "c_nationkey": 0, "c_acctbal": 0.0, "c_mktsegment": ""}
    return upsert_scd1(target, source, "c_custkey", tracked, "customer_key", "updated_at", BATCH2_TS)


def q_scd1_two_batches(spark, d):
    """The same upsert as two published loads of a dimension in buckets: the second rewrites
    the buckets in which it changes or adds a customer."""
    root, table_name = _scratch_root(spark), "silver/customers"
    c = table(spark, d, "customer").select(*CUSTOMER_COLS)
    seg = F.when(F.col("c_nationkey") == 1, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    batches = [(c.where(F.col("c_acctbal") > 0), BATCH1_TS),
               (c.where(F.col("c_nationkey") != 0).withColumn("c_mktsegment", seg), BATCH2_TS)]
    tracked = {"c_name": "", "c_nationkey": 0, "c_acctbal": 0.0, "c_mktsegment": ""}
    for rows, stamp in batches:
        manifest = read_manifest(spark, root)
        change = upsert_buckets(spark, root, table_name, rows, "c_custkey", tracked, "customer_key", "updated_at", stamp,
                                unique_version("b"), buckets=16, manifest=manifest)
        publish(spark, root, manifest.number, change.tables(), change.facts)
    return read_layer(spark, root, "silver", "customers")


def _append(spark: SparkSession, root: str, rows: DataFrame, stamp: str) -> None:
    manifest = read_manifest(spark, root)
    change, _ = append_new(spark, root, "silver/orders", rows, "o_orderkey", "order_key", unique_version(stamp),
                           ["o_orderdate"], manifest)
    publish(spark, root, manifest.number, change.tables(), change.facts)


def q_pruned_batches(spark, d):
    """Three published appends by ranges of the order's number; the second and third send some of
    the orders before them again, with another price, and look for them only in the parts whose
    numbers meet theirs."""
    root = _scratch_root(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    top = F.lit(o.agg(F.max("o_orderkey")).first()[0] or 0)
    third, again = F.floor(top / 3), F.floor(top / 30)
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    for number, (low, high) in enumerate([(None, third), (third - again, 2 * third), (2 * third - again, None)]):
        inside = (F.lit(True) if low is None else key > low) & (F.lit(True) if high is None else key <= high)
        new = F.lit(True) if low is None else key > low + again
        rows = o.where(inside).withColumn("o_totalprice", F.when(new, price).otherwise(price * 2))
        _append(spark, root, rows.withColumn("batch", F.lit(number)), f"b{number}")
    return read_layer(spark, root, "silver", "orders")


def q_trusted_report(spark, d):
    """Two appended batches of orders, some without a customer or status, checked after each:
    the second check reads the second batch only and reports on both."""
    root = _scratch_root(spark)
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderdate")
    customers = table(spark, d, "customer")
    checks = {
        "rows": lambda df: constraints.not_null_rules(df, ["o_custkey", "o_orderstatus"], "orders"),
        "customer": lambda df: constraints.fk_rule(df, "o_custkey", customers, "c_custkey", "orders", "FK_orders_customer")}
    early = F.col("o_orderdate") < X.ntz_lit(LOADED_BEFORE)
    for batch in (early, ~early | F.col("o_orderdate").isNull()):
        _append(spark, root, o.where(batch), "b")
        manifest = read_manifest(spark, root)
        report, facts, _ = validate(spark, root, "silver/orders", checks, "order_key", manifest)
        publish(spark, root, manifest.number, {}, facts)
    return report


def q_collated_lookup(spark, d):
    """Each customer's first order and the customer's key, where orders and customers write the
    customer's id in other cases and with trailing blanks."""
    number = F.col("o_custkey").cast("string")
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("CUST-"), number))
                                         .otherwise(F.concat(F.lit("Cust-"), number, F.lit("  "))).alias("patient"))
    c = assign_keys(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "customer_key")
    c = c.select("customer_key", F.concat(F.lit("cUsT-"), F.col("c_custkey").cast("string")).alias("id"))
    first = first_per_key(compare_as(o, "patient"), ["patient"], [("o_orderkey", "asc")])
    found = refint.lookup_key(first, "patient", compare_as(c, "id"), "id", "customer_key")
    return as_stored(found).select("o_orderkey", "patient", "customer_key")


def q_compacted(spark, d):
    """Orders appended in eight small parts, then compacted: the rows by the manifest before
    and by the one after."""
    root = _scratch_root(spark)
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    for number in range(8):
        _append(spark, root, o.where(F.col("o_orderkey") % 8 == number), f"b{number}")
    before = read_manifest(spark, root)
    change = compact(spark, root, "silver/orders", unique_version("c"), fan=4, least=1_000, manifest=before)
    after = publish(spark, root, before.number, change.tables(), change.facts)
    return (read_layer(spark, root, "silver", "orders", before.number).withColumn("manifest", F.lit("before"))
            .unionByName(read_layer(spark, root, "silver", "orders", after).withColumn("manifest", F.lit("after"))))


def q_incremental_insert(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    loaded = o.filter(F.col("o_orderdate") < X.ntz_lit(LOADED_BEFORE))
    target = assign_keys(loaded, ["o_orderkey"], "order_key")
    source = o.withColumn("o_totalprice", F.col("o_totalprice") * 2)  # re-sent rows are ignored
    return incremental_insert(target, source, "o_orderkey", "order_key")


SUPPLIER_COLS = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]


def q_inferred_members(spark, d):
    s = table(spark, d, "supplier").filter(F.col("s_acctbal") > 0).select(*SUPPLIER_COLS)
    dim = assign_keys(s, ["s_suppkey"], "supplier_key")
    return infer_missing_members(dim, table(spark, d, "lineitem"), "l_suppkey", "s_suppkey", "supplier_key",
                                 {"s_name": INFERRED_NAME, "s_nationkey": -1, "s_acctbal": 0.0})


def q_placeholder_member(spark, d):
    dim = assign_keys(table(spark, d, "supplier").select(*SUPPLIER_COLS), ["s_suppkey"], "supplier_key")
    return ensure_placeholder(dim, {"supplier_key": 0, "s_suppkey": -1, "s_name": PLACEHOLDER_NAME,
                                    "s_nationkey": -1, "s_acctbal": 0.0}, "supplier_key")


# ---------------------------------------------------------------------- T1
def q_silver_payers(spark, d):
    """Silver payers through the warehouse's own load: the payer file lists all suppliers
    (ids as text, state = nation key, blank without a positive balance), the state lookup
    is ``nation``, which drops payers without a state, and of these the ones that
    ``lineitem`` uses come back as inferred members after the key-0 placeholder."""
    s = table(spark, d, "supplier")
    key = F.col("s_suppkey")
    state = F.when(F.col("s_acctbal") > 0, F.col("s_nationkey").cast("string"))
    bronze = s.select(key.cast("string").alias("Id"), F.col("s_name").alias("NAME"),
                      F.concat(key, F.lit(" Main St")).alias("ADDRESS"),
                      F.concat(F.lit("City "), key % 50).alias("CITY"), state.alias("STATE_HEADQUARTERED"),
                      F.lpad(key.cast("string"), 5, "0").alias("ZIP"),
                      F.concat(F.lit("1-800-"), key).alias("PHONE"))
    states = table(spark, d, "nation").select(F.col("n_nationkey").alias("StateID"),
                                              F.col("n_name").alias("StateName"),
                                              F.col("n_nationkey").cast("string").alias("Abbreviation"))
    used = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("PAYER"))
    return silver_payers(bronze, used, None, BATCH1_TS, states=states)


def bronze_patients(spark: SparkSession, d: str) -> DataFrame:
    """Patients file from ``customer``: id as text, the name as FIRST, the market segment as
    RACE and its first letter as MARITAL (only 'M' is a known code); the other fields follow
    from the customer's and nation's numbers, some of them missing."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    birth = F.when(key % 17 != 0, F.date_add(F.lit("1930-01-01").cast("date"), (key % 25000).cast("int")))
    text = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    return table(spark, d, "customer").select(
        key.cast("string").alias("Id"), birth.alias("BIRTHDATE"),
        F.when(key % 13 == 0, F.date_add(birth, 20000)).alias("DEATHDATE"),
        F.when(key % 3 == 0, "Mr.").when(key % 3 == 1, " Ms. ").alias("PREFIX"), F.col("c_name").alias("FIRST"),
        F.when(key % 19 != 0, text("Family", key % 100)).alias("LAST"), F.when(key % 11 == 0, "Jr.").alias("SUFFIX"),
        F.when(key % 4 == 0, text("Maiden", key % 90)).alias("MAIDEN"), F.substring("c_mktsegment", 1, 1).alias("MARITAL"),
        F.col("c_mktsegment").alias("RACE"),
        F.when(key % 5 == 0, "hispanic").when(key % 5 == 1, "").otherwise("nonhispanic").alias("ETHNICITY"),
        F.when(key % 7 == 0, "x").when(key % 2 == 0, "f").otherwise("M").alias("GENDER"),
        text("Place ", nation).alias("BIRTHPLACE"), text("Road ", key).alias("ADDRESS"), text("cITY ", nation).alias("CITY"),
        text("state ", nation).alias("STATE"), F.when(key % 6 != 0, text("county ", key % 30)).alias("COUNTY"),
        F.lpad(key.cast("string"), 5, "0").alias("ZIP"), (nation + 0.5).cast("decimal(9,6)").alias("LAT"),
        (-nation - 0.25).cast("decimal(9,6)").alias("LON"))


def bronze_encounters(spark: SparkSession, d: str) -> DataFrame:
    """Encounters file from ``orders``: an encounter runs from the order date to its last
    line's ship date; the payer is the order's lowest supplier key; CODE / DESCRIPTION are
    status / priority; claim = sum of line prices, coverage = the order total.  Lines are
    aggregated per order before the join (one row per order)."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_stop"), F.min("l_suppkey").alias("_payer"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).alias("_claim"))
    o = table(spark, d, "orders")
    j = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    money = "decimal(10,2)"
    return j.select(
        F.col("o_orderkey").cast("string").alias("Id"), F.col("o_orderdate").alias("START"),
        F.col("_stop").alias("STOP"), F.col("o_custkey").cast("string").alias("PATIENT"),
        F.col("o_orderstatus").alias("ORGANIZATION"), F.col("_payer").cast("string").alias("PAYER"),
        F.col("o_orderpriority").alias("ENCOUNTERCLASS"), F.col("o_orderstatus").alias("CODE"),
        F.col("o_orderpriority").alias("DESCRIPTION"), F.col("o_totalprice").cast(money).alias("BASE_ENCOUNTER_COST"),
        F.col("_claim").cast(money).alias("TOTAL_CLAIM_COST"), F.col("o_totalprice").cast(money).alias("PAYER_COVERAGE"),
        *reasons(F.col("o_orderkey")))


def reasons(key) -> list:
    """Reason code and description of every third key."""
    return [F.when(key % 3 == 0, F.concat(F.lit(p), (key % 7).cast("string"))).alias(c)
            for c, p in (("REASONCODE", "R"), ("REASONDESCRIPTION", "Reason "))]


def q_silver_patients(spark, d):
    """Silver patients through the warehouse's own load (dedupe, name and recode rules,
    type-1 upsert into an empty table)."""
    return silver_patients(bronze_patients(spark, d), None, BATCH1_TS)


def q_silver_encounters(spark, d):
    """Silver encounters through the warehouse's own load: IQR limit over all bronze
    rows, canonical descriptions, patient / payer filters (NULL payer -> placeholder),
    dedupe, key lookups, floors and caps, incremental insert into an empty table."""
    bronze = stored(bronze_encounters(spark, d))  # bronze is a stored layer, and so are the dimensions
    patients = stored(silver_patients(bronze_patients(spark, d), None, BATCH1_TS))
    payers = stored(q_silver_payers(spark, d))
    return silver_encounters(bronze, patients, payers, None, BATCH1_TS)


def bronze_procedures_text_ids(spark: SparkSession, d: str) -> DataFrame:
    """``bronze_procedures`` with the patient and encounter ids as text, matching the
    silver patient and encounter loads."""
    b = bronze_procedures(spark, d)
    code, description = reasons(F.col("ENCOUNTER"))
    return (b.select("*", code, description).withColumn("PATIENT", F.col("PATIENT").cast("string"))
            .withColumn("ENCOUNTER", F.col("ENCOUNTER").cast("string")))


def gold_layer(spark: SparkSession, d: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The silver -> gold path on the driver tables, as far as the gold tables ``names`` (all by
    default) need it.  Silver is a stored layer: each of its tables is made once and read by
    everything that follows (the encounters and procedures are stored with their keys)."""
    from strata.plans.gold import gold_tables

    silver = {"payers": stored(q_silver_payers(spark, d)),
              "patients": stored(silver_patients(bronze_patients(spark, d), None, BATCH1_TS))}
    silver["encounters"] = silver_encounters(stored(bronze_encounters(spark, d)), silver["patients"], silver["payers"],
                                             None, BATCH1_TS)
    if names is None or any("procedure" in n for n in names):
        silver["procedures"] = silver_procedures(stored(bronze_procedures_text_ids(spark, d)), silver["patients"],
                                                 "patient_id", silver["encounters"], "encounter_id")
    return gold_tables(silver, names) if names else gold_tables(silver)


def q_gold_constraints(spark, d):
    """The gold constraint report: foreign and primary keys, NOT NULL columns, widths."""
    from strata.plans.gold import gold_constraint_report

    return gold_constraint_report(gold_layer(spark, d))


def q_gold_dim_payers(spark, d):
    from strata.plans.gold import gold_tables

    return gold_tables({"payers": q_silver_payers(spark, d)}, ["dim_payers"])["dim_payers"]


def q_gold_dim_patients(spark, d):
    from strata.plans.gold import gold_tables

    return gold_tables({"patients": q_silver_patients(spark, d)}, ["dim_patients"])["dim_patients"]


def q_gold_fact_encounters(spark, d):
    from strata.plans.gold import gold_tables

    return gold_tables({"encounters": q_silver_encounters(spark, d)}, ["fact_encounters"])["fact_encounters"]


def q_gold_fact_procedures(spark, d):
    return gold_layer(spark, d, ["fact_procedures"])["fact_procedures"]


def q_gold_encounter_date(spark, d):
    from strata.plans.gold import gold_tables

    return gold_tables({"encounters": q_silver_encounters(spark, d)}, ["dim_encounter_date"])[
        "dim_encounter_date"].select("date_key")


def q_gold_procedure_date(spark, d):
    return gold_layer(spark, d)["dim_procedure_date"].select("date_key")


def _gold_question(name: str):
    def run(spark, d):
        return Q.gold_questions(gold_layer(spark, d, list(Q.QUESTION_TABLES[name])), names=[name])[name]

    return run


# ------------------------------------------------------------------- D1, T4/T5
def q_date_dimension(spark, d):
    return date_dimension(table(spark, d, "orders"), "o_orderdate")


def q_gold_dim(spark, d):
    c = first_per_key(table(spark, d, "customer").filter(F.col("c_custkey").isNotNull()), ["c_custkey"])
    keyed = assign_keys(c, ["c_custkey"], "customer_key")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = keyed.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return j.select("customer_key", F.trim("c_name").alias("customer_name"),
                    X.title_or("c_mktsegment", "Unknown").alias("market_segment"),
                    F.col("n_name").alias("nation_name"),
                    X.floor_to_one(F.col("c_acctbal").cast("decimal(12,2)"), "decimal(12,2)").alias("balance"))


def q_gold_fact(spark, d):
    """Fact procedures: IQR limit over all bronze rows, canonical descriptions, RI filters
    before the dedupe, latest STOP per (START, PATIENT, CODE), key lookups, capped
    duration, floored cost, keys from 1 in natural-key order."""
    patients = assign_keys(table(spark, d, "customer").select("c_custkey"), ["c_custkey"], "patient_key")
    encounters = assign_keys(table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "encounter_key")
    # bronze is a stored layer: derive it once (a three-way join here) and let the IQR
    # limit, the canonical descriptions and the main path all read the written copy
    bronze = stored(bronze_procedures(spark, d))
    return silver_procedures(bronze, patients, "c_custkey", encounters, "o_orderkey", birth_date_col=None)


# ------------------------------------------------------------------- C1-C4
def _fk_rules(spark, d):
    t = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem", "part", "supplier", "nation")}
    return [
        constraints.fk_rule(t["orders"], "o_custkey", t["customer"], "c_custkey", "orders", "fk_orders_customer"),
        constraints.fk_rule(t["lineitem"], "l_orderkey", t["orders"], "o_orderkey", "lineitem", "fk_lineitem_orders"),
        constraints.fk_rule(t["lineitem"], "l_partkey", t["part"], "p_partkey", "lineitem", "fk_lineitem_part"),
        constraints.fk_rule(t["lineitem"], "l_suppkey", t["supplier"], "s_suppkey", "lineitem",
                            "fk_lineitem_supplier"),
        constraints.fk_rule(t["customer"], "c_nationkey", t["nation"], "n_nationkey", "customer",
                            "fk_customer_nation"),
        constraints.fk_rule(t["supplier"], "s_nationkey", t["nation"], "n_nationkey", "supplier",
                            "fk_supplier_nation"),
    ]


def _pk_rules(spark, d):
    specs = [("customer", ["c_custkey"]), ("orders", ["o_orderkey"]), ("part", ["p_partkey"]),
             ("supplier", ["s_suppkey"]), ("nation", ["n_nationkey"]), ("lineitem", LINE_KEY)]
    return [constraints.pk_rule(table(spark, d, n), k, n, "pk_" + n) for n, k in specs]


def _not_null_rules(spark, d):
    return [constraints.not_null_rule(table(spark, d, "orders"), "o_orderdate", "orders", "nn_o_orderdate"),
            constraints.not_null_rule(table(spark, d, "lineitem"), "l_shipdate", "lineitem", "nn_l_shipdate")]


def q_fk_report(spark, d):
    return constraints.constraint_report(_fk_rules(spark, d))


def q_pk_report(spark, d):
    return constraints.constraint_report(_pk_rules(spark, d))


def q_constraint_report(spark, d):
    return constraints.constraint_report(_fk_rules(spark, d) + _pk_rules(spark, d) + _not_null_rules(spark, d))


# ------------------------------------------------------------------- X1-X15
def q_row_counts(spark, d):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return quality.row_counts({n: table(spark, d, n) for n in names})


def q_profile_nulls(spark, d):
    o = table(spark, d, "orders")
    return quality.null_counts(o, o.columns)


def q_profile_range(spark, d):
    return quality.value_range(table(spark, d, "orders"), ["o_orderdate", "o_totalprice"])


def q_domain_values(spark, d):
    return quality.domain_values(table(spark, d, "orders"), "o_orderpriority")


def q_pattern_match(spark, d):
    return canonical.descriptions_like(table(spark, d, "part"), "p_type", "p_name", "%ring%")


def q_cross_column_rule(spark, d):
    li = table(spark, d, "lineitem")
    rule = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    return quality.rows_where(li, rule).select(*LINE_KEY, "l_returnflag", "l_linestatus")


def q_coverage_over_claim(spark, d):
    m = coverage_columns(table(spark, d, "lineitem"))
    return quality.coverage_over_claim(m, "coverage_raw", "total_claim").select(*LINE_KEY, "total_claim",
                                                                                "coverage_raw")


def q_key_check(spark, d):
    return quality.key_violations(table(spark, d, "lineitem"), LINE_KEY)


def q_duplicate_rows(spark, d):
    return duplicate_groups(table(spark, d, "lineitem"), LINE_KEY + ["l_shipdate"])


def q_duplicate_members(spark, d):
    """Every row of each composite key with its number within the key."""
    lines = table(spark, d, "lineitem").select(*LINE_KEY, "l_partkey")
    return duplicate_members(lines, ["l_orderkey", "l_partkey"], ["l_linenumber"])


def q_duplicate_members_hot(spark, d):
    """The same with a third of all lines under one key."""
    hot = F.col("l_orderkey") % 3 == 0
    lines = table(spark, d, "lineitem").select(
        F.when(hot, F.lit(0)).otherwise(F.col("l_suppkey")).alias("member"), *LINE_KEY, "l_partkey")
    return duplicate_members(lines, ["member"], [*LINE_KEY, "l_partkey"])


def q_missing_or_present(spark, d):
    """Patients without a birth date, or with a suffix."""
    b = bronze_patients(spark, d)
    return quality.rows_where(b, F.col("BIRTHDATE").isNull() | F.col("SUFFIX").isNotNull()).select(
        "Id", "BIRTHDATE", "SUFFIX")


def q_first_rows(spark, d):
    return preview(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 100)


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"


def q_csv_round_trip(spark, d):
    """Suppliers as a CSV file with a rejected row, read back as bronze through a published table."""
    root = _scratch_root(spark)
    s = table(spark, d, "supplier")
    good = {"Id": F.col("s_suppkey"), "NAME": F.concat("s_name", F.lit(", Inc.")), "ADDRESS": F.lit(None).cast("string"),
            "CITY": F.lit("Town"), "STATE_HEADQUARTERED": F.col("s_nationkey"), "ZIP": F.lit("00001"), "PHONE": F.lit("1-800")}
    s.select(*[c.alias(n) for n, c in good.items()]).write.option("header", True).csv(f"{root}-csv/payers.csv")
    broken = s.agg(F.concat_ws(",", F.min("s_suppkey"), F.lit("a,b,c,d,e,f,g,h")).alias("line"))  # too many fields
    broken.select(F.explode(F.array(F.lit(",".join(good)), "line"))).write.mode("append").text(f"{root}-csv/payers.csv")
    number = open_warehouse(spark, root)
    rows = read_bronze(spark, f"{root}-csv/payers.csv", schemas.BRONZE["payers"])
    part = write_part(rows, root, "bronze", "payers", unique_version("trip"), partition_by=[REJECTED])
    publish(spark, root, number, {"bronze/payers": [part]})
    path = f"{root}/{current_tables(spark, root)['bronze/payers'][0]}"
    read = good_rows(spark, path, schemas.BRONZE["payers"]).select("Id", "NAME", "CITY", "STATE_HEADQUARTERED")
    bad = rejected_rows(spark, path, schemas.BRONZE["payers"]).agg(F.count("*").cast("string").alias("Id"))
    return read.unionByName(bad.select("Id", F.lit("rejected").alias("NAME"), F.lit(None).cast("string").alias("CITY"),
                                       F.lit(None).cast("string").alias("STATE_HEADQUARTERED")))


def q_load_verdict(spark, d):
    """Suppliers as two CSV files, one of them with a row too wide for every nation: which file
    a load accepts."""
    root, schema = _scratch_root(spark), schemas.BRONZE["payers"]
    s = table(spark, d, "supplier")
    names = schema.fieldNames()
    line = F.concat_ws(",", F.col("s_suppkey"), *[F.lit("x") for _ in names[1:]])
    wide = table(spark, d, "nation").select(F.concat_ws(",", F.col("n_nationkey"), *[F.lit("y")] * (len(names) + 2)).alias("line"))
    header = spark.createDataFrame([(",".join(names),)], "line string")
    for name, rows in (("good", s.select(line.alias("line"))), ("broken", s.select(line.alias("line")).unionByName(wide))):
        # one file each: its header stands in front
        ordered = header.withColumn("n", F.lit(0)).unionByName(rows.withColumn("n", F.lit(1))).coalesce(1).sortWithinPartitions("n")
        ordered.select("line").write.text(f"{root}-csv/file={name}")
    found = None
    for name in ("good", "broken"):
        part = write_part(read_bronze(spark, f"{root}-csv/file={name}", schema), root, "bronze", "payers", name, partition_by=[REJECTED])
        verdict = file_verdicts(spark, f"{root}/{part}").withColumn("source_file", F.lit(name))
        found = verdict if found is None else found.unionByName(verdict)
    return found


def q_load_audit(spark, d):
    """Suppliers and nations as CSV files, the latter's rows too wide: what the load audit says of
    writing them as bronze tables, counted while they were written, and per layer."""
    root, schema, entries = _scratch_root(spark), schemas.BRONZE["payers"], []
    width = len(schema.fieldNames())
    for name, key, more in (("supplier", "s_suppkey", 0), ("nation", "n_nationkey", 3)):
        lines = table(spark, d, name).select(F.concat_ws(",", F.col(key), *[F.lit("x")] * (width - 1 + more)).alias("line"))
        header = spark.createDataFrame([(",".join(schema.fieldNames()),)], "line string").withColumn("n", F.lit(0))
        whole = header.unionByName(lines.withColumn("n", F.lit(1))).coalesce(1).sortWithinPartitions("n")
        whole.select("line").write.text(f"{root}-csv/{name}.csv")
        begun = time.monotonic()
        tracked, seen = observed(read_bronze(spark, f"{root}-csv/{name}.csv", schema), f"{name}/{uuid.uuid4().hex}", REJECTED)
        write_part(tracked, root, "bronze", name, unique_version("a"), partition_by=[REJECTED])
        rows, rejected = seen.get["rows"], seen.get["rejected"]
        entries.append(("bronze", name, rows, rows - rejected, rejected, time.monotonic() - begun))
    return load_audit(spark, entries, BATCH1_TS).where("seconds >= 0").drop("seconds")


def q_state_names(spark, d):
    """Suppliers with the name of a state of the fixed lookup; numbers beyond it have none."""
    s = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 60 + 1).cast("int").alias("state_id"))
    states = F.broadcast(us_states(spark))  # 50 rows
    return s.join(states, F.col("state_id") == F.col("StateID"), "left").select(
        "s_suppkey", F.col("StateName").alias("state_name"), F.col("Abbreviation").alias("abbreviation"))


def q_published_view(spark, d):
    """The payers' dimension, published and read by another session through a view of the catalog."""
    root = _scratch_root(spark)
    number = open_warehouse(spark, root)
    part = write_part(q_gold_dim_payers(spark, d), root, "gold", "dim_payers", unique_version("v"))
    publish(spark, root, number, {"gold/dim_payers": [part]})
    database = f"strata_{uuid.uuid4().hex[:12]}"
    create_views(spark, root, database)
    return spark.newSession().table(f"{database}.vw_dim_payers")


def q_two_batches(spark, d):
    """Orders loaded in two batches, the second as an appended part: a published table of two
    parts, with the keys of the first batch unchanged."""
    root = _scratch_root(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    number = open_warehouse(spark, root)
    early = orders.filter(F.col("o_orderdate") < X.ntz_lit(LOADED_BEFORE))
    first = write_part(assign_keys(early, ["o_orderkey"], "order_key"), root, "silver", "orders", unique_version("b"))
    number = publish(spark, root, number, {"silver/orders": [first]})
    there = read_layer(spark, root, "silver", "orders")
    later = new_rows(there, orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_orderkey", "order_key")
    second = write_part(later, root, "silver", "orders", unique_version("b"))
    publish(spark, root, number, {"silver/orders": [first, second]})
    return read_layer(spark, root, "silver", "orders")


# ------------------------------------------------------------------- Q1-Q10
def q01_per_year(spark, d):
    return Q.encounters_per_year(table(spark, d, "orders"), "o_orderdate")


def q02_class_share(spark, d):
    return Q.class_share(table(spark, d, "orders"), "o_orderdate", "o_orderpriority")


def q03_over_24h(spark, d):
    return Q.duration_share(user_gaps(spark, d), "ts", "next_ts", 24.0)


def q04_zero_coverage(spark, d):
    return Q.zero_share(table(spark, d, "lineitem"), "l_discount")


def _code_stats(spark, d):
    return Q.code_stats(table(spark, d, "lineitem"), "l_partkey", "l_extendedprice")


def q05_top_frequent(spark, d):
    top = Q.top_codes(_code_stats(spark, d), "l_partkey", "n_procedures", 10)
    return Q.name_codes(top, "l_partkey", table(spark, d, "part"), "p_partkey", "p_name")


def q06_top_cost(spark, d):
    top = Q.top_codes(_code_stats(spark, d), "l_partkey", "avg_base_cost", 10)
    return Q.name_codes(top, "l_partkey", table(spark, d, "part"), "p_partkey", "p_name")


def q07_claim_by_payer(spark, d):
    return Q.avg_by_member(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", payer_dim(spark, d),
                           "payer_id", "payer_key", "payer_name")


def q08_patients_per_quarter(spark, d):
    return Q.distinct_per_quarter(table(spark, d, "orders"), "o_orderdate", "o_custkey")


def q08_bitmap_batches(spark, d):
    """Patients per quarter over the gold facts, loaded in two batches: the first batch's bitmaps
    are stored, and the second's merged into them."""
    root = _scratch_root(spark)
    facts = gold_layer(spark, d, ["fact_encounters"])["fact_encounters"].checkpoint()
    early = F.col("encounter_start") < X.ntz_lit(LOADED_BEFORE)
    number = open_warehouse(spark, root)
    parts = []
    for rows in (facts.where(early), facts.where(~early | F.col("encounter_start").isNull())):
        state = Q.distinct_bitmaps(rows, Q.quarter_of("encounter_start"), "patient_key")
        parts.append(write_part(state, root, "state", "patients_per_quarter", unique_version("b")))
        number = publish(spark, root, number, {"state/patients_per_quarter": list(parts)})
    return Q.distinct_of_bitmaps(Q.merged_bitmaps([read_layer(spark, root, "state", "patients_per_quarter")]))


def q08_urgent_per_quarter(spark, d):
    return Q.distinct_per_quarter(table(spark, d, "orders"), "o_orderdate", "o_custkey", "o_orderpriority",
                                  ["1-URGENT", "2-HIGH"])


def _readmissions(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return Q.readmission_rows(o, "o_custkey", "o_orderdate", "o_orderdate", ["o_orderdate", "o_orderkey"])


def q09_readmitted_30d(spark, d):
    return Q.readmission_summary(_readmissions(spark, d), "o_custkey")


def q10_most_readmissions(spark, d):
    return Q.most_readmissions(_readmissions(spark, d), "o_custkey", 10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedupe_by_id": q_dedupe_by_id,
    "dedupe_latest": q_dedupe_latest,
    "canonical_description": q_canonical_description,
    "ambiguous_codes": q_ambiguous_codes,
    "iqr_limit": q_iqr_limit,
    "capped_duration": q_capped_duration,
    "negative_durations": q_negative_durations,
    "longest_durations": q_longest_durations,
    "minute_boundaries": q_minute_boundaries,
    "sliced_gaps": q_sliced_gaps,
    "age_by_year": q_age_by_year,
    "title_case": q_title_case,
    "recode_segment": q_recode_segment,
    "person_name": q_person_name,
    "floor_and_cap": q_floor_and_cap,
    "keep_referenced": q_keep_referenced,
    "keep_new": q_keep_new,
    "orphans": q_orphans,
    "orphan_counts": q_orphan_counts,
    "not_in_null_aware": q_not_in_null_aware,
    "lookup_keys": q_lookup_keys,
    "enrich_state": q_enrich_state,
    "surrogate_keys": q_surrogate_keys,
    "scd1_upsert": q_scd1_upsert,
    "scd1_two_batches": q_scd1_two_batches,
    "pruned_batches": q_pruned_batches,
    "compacted": q_compacted,
    "trusted_report": q_trusted_report,
    "collated_lookup": q_collated_lookup,
    "incremental_insert": q_incremental_insert,
    "inferred_members": q_inferred_members,
    "placeholder_member": q_placeholder_member,
    "silver_payers": q_silver_payers,
    "silver_patients": q_silver_patients,
    "silver_encounters": q_silver_encounters,
    "date_dimension": q_date_dimension,
    "gold_dim": q_gold_dim,
    "gold_fact": q_gold_fact,
    "gold_constraints": q_gold_constraints,
    "gold_dim_payers": q_gold_dim_payers,
    "gold_dim_patients": q_gold_dim_patients,
    "gold_encounter_date": q_gold_encounter_date,
    "gold_procedure_date": q_gold_procedure_date,
    "gold_fact_encounters": q_gold_fact_encounters,
    "gold_fact_procedures": q_gold_fact_procedures,
    "gold_q05_top_frequent": _gold_question("q05_top_frequent"),
    "gold_q07_claim_by_payer": _gold_question("q07_claim_by_payer"),
    "gold_q09_readmitted_30d": _gold_question("q09_readmitted_30d"),
    "fk_report": q_fk_report,
    "pk_report": q_pk_report,
    "constraint_report": q_constraint_report,
    "row_counts": q_row_counts,
    "profile_nulls": q_profile_nulls,
    "profile_range": q_profile_range,
    "domain_values": q_domain_values,
    "pattern_match": q_pattern_match,
    "cross_column_rule": q_cross_column_rule,
    "coverage_over_claim": q_coverage_over_claim,
    "key_check": q_key_check,
    "duplicate_rows": q_duplicate_rows,
    "duplicate_members": q_duplicate_members,
    "duplicate_members_hot": q_duplicate_members_hot,
    "burst_gaps": q_burst_gaps,
    "percentiles_distinct": q_percentiles_distinct,
    "missing_or_present": q_missing_or_present,
    "first_rows": q_first_rows,
    "load_verdict": q_load_verdict,
    "published_view": q_published_view,
    "load_audit": q_load_audit,
    "state_names": q_state_names,
    "q08_bitmap_batches": q08_bitmap_batches,
    "csv_round_trip": q_csv_round_trip,
    "two_batches": q_two_batches,
    "q01_per_year": q01_per_year,
    "q02_class_share": q02_class_share,
    "q03_over_24h": q03_over_24h,
    "q04_zero_coverage": q04_zero_coverage,
    "q05_top_frequent": q05_top_frequent,
    "q06_top_cost": q06_top_cost,
    "q07_claim_by_payer": q07_claim_by_payer,
    "q08_patients_per_quarter": q08_patients_per_quarter,
    "q08_urgent_per_quarter": q08_urgent_per_quarter,
    "q09_readmitted_30d": q09_readmitted_30d,
    "q10_most_readmissions": q10_most_readmissions,
}
