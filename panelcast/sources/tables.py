"""Event, entity and attribute sources derived from the given parquet tables.

The inputs of a panel build are an event inventory (one row per event with a
comma-separated list of affected places), an entity domain, and per-place
attribute tables.  On the TPC-H-like test tables they are derived as follows:

* event      = order with priority ``1-URGENT`` and total price above 450,000
* places     = the distinct suppliers of the order's line items, as ``SUPPLIER_<key>``
* state      = the customer's region name
* measures   = severity (total price / 50,000, missing for every 7th order key),
               fatalities (key mod 13), displaced (key mod 1000), duration (line count)
* entities   = the suppliers, named in title case, with the configured aliases
* attributes = per-supplier aggregates (balance, discounts, quantities, line counts)

The entity count grows with the data, so the panel (entities x months) and the
event rate per cell stay proportionate at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_PRIORITY = "1-URGENT"
EVENT_MIN_PRICE = 450000.0
# Entity aliases of the test analogue: alternate spelling -> canonical name.
ANALOGUE_ALIAS = {"Supplier_7": "Supplier_Seven", "Supplier_13": "Supplier_Thirteen"}
# Regions covered by the impact attribute source (regex on the region name).
IMPACT_REGION_PATTERN = "A"


#: Line items that one task joins to the event orders.
LINES_PER_TASK = 1_000_000

#: The tables that the panel is made from.
PANEL_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as its files are now (a table that is rewritten in place is listed anew)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def place_label(key: Column) -> Column:
    return F.concat(F.lit("SUPPLIER_"), key.cast("string"))


def _dealt(keys: DataFrame, key: str, rows: int, task_rows: int = LINES_PER_TASK) -> DataFrame:
    """Join keys shuffled to as many tasks as the ``rows`` they meet ask for, where that is more than
    the session's shuffle partitions (the rows follow the keys): a fixed number of tasks would hold
    ever more rows each."""
    parts = -(-rows // task_rows)
    return keys.repartition(parts, key) if parts > int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")) else keys


def event_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: event_id, event_seq, start_date, date_text, state,
    districts (comma list or null), severity, fatalities, displaced, duration."""
    orders = (read(spark, sf_dir, "orders")
              .where((F.col("o_orderpriority") == EVENT_PRIORITY)
                     & (F.col("o_totalprice") > EVENT_MIN_PRICE))
              .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))
    nation = read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    state = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("c_custkey", F.col("r_name").alias("state")))
    # Line items of event orders only (semi join before aggregation); an order has
    # at most a handful of lines, so the per-order set stays small.
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    keys = _dealt(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", lines.count())
    lines = lines.join(keys, "l_orderkey", "left_semi")
    places = (lines.groupBy("l_orderkey")
              .agg(F.array_join(F.array_sort(F.collect_set(place_label(F.col("l_suppkey")))), ", ")
                   .alias("districts"),
                   F.count(F.lit(1)).cast("double").alias("duration")))
    d = F.to_date("o_orderdate")
    return (orders.join(state, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(places, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(F.col("o_orderkey").alias("event_id"),
                    F.col("o_orderkey").alias("event_seq"),
                    d.alias("start_date"),
                    F.date_format(d, "d/M/yyyy").alias("date_text"),
                    "state", "districts",
                    F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("o_totalprice") / 50000.0).alias("severity"),
                    (F.col("o_orderkey") % 13).cast("double").alias("fatalities"),
                    (F.col("o_orderkey") % 1000).cast("double").alias("displaced"),
                    "duration"))


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw place names of the entity dimension (``SUPPLIER_<key>``)."""
    return read(spark, sf_dir, "supplier").select(place_label(F.col("s_suppkey")).alias("raw_name"))


def index_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity-index table: blank-header name column (``_c0``) and ``dfsi``."""
    s = read(spark, sf_dir, "supplier")
    return s.select(place_label(F.col("s_suppkey")).alias("_c0"), (F.col("s_acctbal") / 1000.0).alias("dfsi"))


def line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate of the line items per (supplier, return flag); the area, impact
    and census sources derive from it.  Pass the same (materialized) frame to all
    three so the largest table is read once for them: planned separately, each would
    prune the aggregate differently and scan again."""
    li = read(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_discount", "l_tax", "l_quantity")
    return (li.groupBy("l_suppkey", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_discount").alias("sum_discount"),
                 F.sum("l_tax").alias("sum_tax"), F.sum("l_quantity").alias("sum_quantity"),
                 F.count_if(F.col("l_discount") < 0.05).alias("n_low_discount")))


def area_source(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    """Flooded-area table keyed by ``dist_name``: 100 x mean discount and tax."""
    st = line_stats(spark, sf_dir) if stats is None else stats
    n = F.sum("n_lines")
    return (st.groupBy("l_suppkey")
            .agg((F.sum("sum_discount") / n * 100.0).alias("percent_flooded_area"),
                 (F.sum("sum_tax") / n * 100.0).alias("corrected_flooded_area"))
            .select(place_label(F.col("l_suppkey")).alias("dist_name"),
                    "percent_flooded_area", "corrected_flooded_area"))


def impact_source(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None,
                  region_pattern: str = IMPACT_REGION_PATTERN) -> DataFrame:
    """Impact table (population, mean duration) for suppliers of the covered regions."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    covered = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
               .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
               .where(F.coalesce(F.col("r_name").rlike(region_pattern), F.lit(False)))
               .select(F.col("s_suppkey").alias("l_suppkey")))
    st = line_stats(spark, sf_dir) if stats is None else stats
    return (st.join(covered, "l_suppkey", "left_semi").groupBy("l_suppkey")
            .agg((F.sum("n_lines") * 100).cast("double").alias("population"),
                 (F.sum("sum_quantity") / F.sum("n_lines") / 10.0).alias("mean_flood_duration"))
            .select(place_label(F.col("l_suppkey")).alias("dist_name"), "population", "mean_flood_duration"))


def census_source(spark: SparkSession, sf_dir: str, stats: DataFrame | None = None) -> DataFrame:
    """Census rows, several per place (one per return flag) with differing case and
    padding; ``row_seq`` is the file order (later rows win on a case-insensitive match)."""
    st = line_stats(spark, sf_dir) if stats is None else stats
    label = place_label(F.col("l_suppkey"))
    name = (F.when(F.col("l_returnflag") == "A", F.lower(label))
            .when(F.col("l_returnflag") == "N", F.concat(F.lit(" "), label, F.lit(" ")))
            .otherwise(label))
    cnt, low = F.col("n_lines"), F.col("n_low_discount")
    return st.select((F.col("l_suppkey") * 1000 + F.ascii("l_returnflag")).cast("bigint").alias("row_seq"),
                     name.alias("district_name"), (cnt * 1000).alias("population"),
                     (cnt * 200).alias("households"), (low * 200).alias("rural_households"),
                     ((cnt - low) * 200).alias("urban_households"))
