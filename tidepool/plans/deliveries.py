"""Delivery data derived from the driver's order tables.

Binding (orders -> delivery):
- delivery_id      'DEL' || o_orderkey
- customer_id      'CUS' || o_custkey
- restaurant_name  n_name || ' KITCHEN', padded with spaces on every 4th key
- order_amount     o_totalprice
- delivery_minutes 5 + o_orderkey % 176
- city_zone        compass zone of the customer's region, case and padding mixed by key % 3
- delivery_status  from o_orderstatus (F completed, P preparing, O out for delivery), mixed case

The customer side (customer + nation + region) is joined first; nation and
region are fixed-size TPC-H dimensions (25 and 5 rows) and are broadcast.
orders x customer is a shuffle join left to AQE (skew-split on hot customers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.silver import standardise
from tidepool.sources.tables import driver_table

# Region -> compass zone used as the delivery city zone.
ZONE_OF_REGION = {
    "AFRICA": "South",
    "AMERICA": "West",
    "ASIA": "East",
    "EUROPE": "North",
    "MIDDLE EAST": "East",
}

# Order status -> delivery status as it arrives in Bronze.
STATUS_OF_ORDER = {"F": "Completed", "P": "Preparing", "O": "Out for Delivery"}


def _case_map(col: str, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v))
    return expr


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = driver_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = driver_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey) \
        .select("n_nationkey", "n_name", _case_map("r_name", ZONE_OF_REGION).alias("zone"))
    customer = driver_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey) \
        .select("c_custkey", "n_name", "zone")


def bronze(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw (Bronze) deliveries, one per order; ``keep`` carries extra order columns."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = driver_table(spark, sf_dir, "orders", *cols, *[c for c in keep if c not in cols])
    return bronze_from(orders, customer_zones(spark, sf_dir), keep)


def bronze_from(orders: DataFrame, cz: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze rows from an order frame (batch or stream) and the customer zones (static)."""
    k = F.col("o_orderkey")
    status = _case_map("o_orderstatus", STATUS_OF_ORDER)
    return orders.join(cz, orders.o_custkey == cz.c_custkey).select(
        F.concat(F.lit("DEL"), k.cast("string")).alias("delivery_id"),
        F.concat(F.lit("CUS"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(k % 4 == 0, F.concat(F.lit("  "), F.col("n_name"), F.lit(" KITCHEN ")))
        .otherwise(F.concat(F.col("n_name"), F.lit(" KITCHEN"))).alias("restaurant_name"),
        F.col("o_totalprice").alias("order_amount"),
        (F.lit(5) + k % 176).cast("int").alias("delivery_minutes"),
        F.when(k % 3 == 0, F.col("zone"))
        .when(k % 3 == 1, F.concat(F.lit(" "), F.upper("zone"), F.lit(" ")))
        .otherwise(F.lower("zone")).alias("city_zone"),
        F.when(k % 5 == 0, F.concat(F.lit(" "), F.upper(status), F.lit(" ")))
        .when(k % 2 == 1, F.upper(status)).otherwise(status).alias("delivery_status"),
        *keep)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise(bronze(spark, sf_dir))


def update_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MERGE source (standardised like the base, C4).

    Updates: every order still out for delivery arrives completed, 7 minutes later.
    Inserts: every urgent order gets a follow-up delivery ``DEL<key>-R``.
    """
    return updates_from(bronze(spark, sf_dir, keep=("o_orderstatus", "o_orderpriority")))


def updates_from(b: DataFrame) -> DataFrame:
    """The MERGE source rows of a Bronze frame carrying order status and priority.

    One pass: each order yields 0, 1 or 2 rows (an update and/or an insert)
    through an ``explode`` of a compacted array, so the order/customer join
    runs once for both kinds.
    """
    upd = F.when(F.col("o_orderstatus") == "O", F.struct(
        F.col("delivery_id"), F.col("customer_id"), F.col("restaurant_name"), F.col("order_amount"),
        (F.col("delivery_minutes") + 7).cast("int").alias("delivery_minutes"), F.col("city_zone"),
        F.lit(" Completed").alias("delivery_status")))
    ins = F.when(F.col("o_orderpriority") == "1-URGENT", F.struct(
        F.concat("delivery_id", F.lit("-R")).alias("delivery_id"), F.col("customer_id"),
        F.col("restaurant_name"), F.col("order_amount"), F.col("delivery_minutes"), F.col("city_zone"),
        F.lit("PREPARING").alias("delivery_status")))
    rows = b.select(F.explode(F.array_compact(F.array(upd, ins))).alias("_r")).select("_r.*")
    return standardise(rows)


def line_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A MERGE source that breaks the cardinality rule: one update per order line."""
    li = driver_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    return li.select(F.concat(F.lit("DEL"), F.col("l_orderkey").cast("string")).alias("delivery_id"),
                     F.col("l_extendedprice").alias("order_amount"))


def bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that must fail the minimal gate: customers in debt booked as negative
    deliveries with a blank zone.  Only the restaurant name is trimmed (C5)."""
    c = driver_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    return c.where(F.col("c_acctbal") < 0).select(
        F.concat(F.lit("BAD"), F.col("c_custkey").cast("string")).alias("delivery_id"),
        F.concat(F.lit("CUS"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.trim(F.concat(F.lit(" "), F.col("c_name"), F.lit(" "))).alias("restaurant_name"),
        F.col("c_acctbal").alias("order_amount"),
        F.lit(20).cast("int").alias("delivery_minutes"),
        F.lit("").alias("city_zone"),
        F.lit("completed").alias("delivery_status"))


def rated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema-breaking append: Silver rows plus an undeclared ``driver_rating``."""
    return silver(spark, sf_dir).withColumn(
        "driver_rating", (F.col("delivery_minutes") % 50) / 10.0)


def late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append lacking the nullable ``restaurant_name``: follow-up deliveries of urgent orders."""
    return update_batch(spark, sf_dir).where(F.col("delivery_id").endswith("-R")) \
        .withColumn("delivery_id", F.regexp_replace("delivery_id", "-R$", "-L")) \
        .drop("restaurant_name")
