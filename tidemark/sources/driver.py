"""Adapters: the driver's TPC-H-like tables as the reference's domain tables (S20 + FIXTURES).

Every adapter is a projection (plus, where noted, a join to a small dimension) over a full
table, so Catalyst prunes columns and pushes filters of the caller down to the Parquet scan.
The same mapping is written in SQL beside the registered queries for the DuckDB check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import hour_start
from tidemark.functions.numeric import line_revenue

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# Fixed parameters of the mapping.
AS_OF = "2001-08-01"            # "today" for relative dates over the order table
ECONOMY = "ECONOMY"             # p_type playing the reference's 'Electronics'
INITIAL_STOCK = 100             # units per (warehouse, product) before requests
WAREHOUSES = 5                  # suppliers are spread over this many warehouses
CART_TTL_SECONDS = 21_600       # cart expiry used over the driver's events


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a whole table (schema from the Parquet footer, no inference pass)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ----------------------------------------------------------------------------------- shop

def clients(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_nationkey").alias("nation_key"),
    )


def products(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").alias("category"),
        F.split("p_name", " ").alias("tags"),
    )


def shop_orders(spark: SparkSession, d: str) -> DataFrame:
    o = load(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
    )


def order_items(spark: SparkSession, d: str) -> DataFrame:
    """Line items; ``revenue`` is exact (decimal) ``extendedprice * (1 - discount)``."""
    li = load(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        line_revenue(None, "l_extendedprice", "l_discount", discount_in_percent=False).alias("revenue"),
    )


# ------------------------------------------------------------------------------- activity

def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def activity_events(spark: SparkSession, d: str, with_country: bool = False) -> DataFrame:
    """The activity table of the reference over ``events``.

    user_id stays the driver's user; ``user_key = user_id * 100 + k`` is the finer user used by
    retention (the driver's users are all active in the first week).  ``session_id`` is a
    hash of (user, hour).  ``country`` needs a join to customer and nation, so it is only added
    on request.
    """
    e = load(spark, d, "events")
    k = _k()
    out = e.select(
        F.to_date("ts").alias("event_date"),
        F.col("ts"),
        F.col("event_id"),
        F.col("user_id"),
        (F.col("user_id") * 100 + k).alias("user_key"),
        F.col("event_type"),
        F.col("value").alias("event_value"),
        F.md5(F.concat_ws("-", F.col("user_id").cast("string"),
                          F.date_format(hour_start("ts"), "yyyyMMddHH"))).alias("session_id"),
        F.when(k < 55, "mobile").when(k < 85, "desktop").otherwise("tablet").alias("device_type"),
        (k + 1).alias("duration"),
    )
    if with_country:
        out = out.join(user_countries(spark, d), "user_id", "left")
    return out


def user_countries(spark: SparkSession, d: str) -> DataFrame:
    """user_id -> country (n_name of the user's customer).  ``nation`` has 25 rows by the
    TPC-H definition, so it is broadcast.  How the events meet the (user, country) map is the
    planner's choice (sort-merge, or AQE's run-time broadcast)."""
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    n = load(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return c.join(F.broadcast(n), "c_nationkey").select("user_id", "country")


# ---------------------------------------------------------------------------------- queue

def jobs(spark: SparkSession, d: str) -> DataFrame:
    """Jobs over orders: open orders are 'new', pending 'processing', filled 'completed'.

    priority = 5 - leading digit of o_orderpriority (URGENT = 4 .. LOW = 0).  A processing or
    completed job was started at its order date by the order's customer; a completed one ran
    for ``floor(o_totalprice)`` seconds.
    """
    o = load(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "new") \
        .when(F.col("o_orderstatus") == "P", "processing").otherwise("completed")
    started = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    completed = F.when(F.col("o_orderstatus") == "F",
                       F.timestamp_add("SECOND", F.floor("o_totalprice"), F.col("o_orderdate")))
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("Task "), F.col("o_orderkey").cast("string")).alias("title"),
        status.alias("status"),
        (F.lit(5) - F.substring("o_orderpriority", 1, 1).cast("int")).alias("priority"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("worker_id"),
        F.col("o_orderdate").alias("created_at"),
        started.alias("started_at"),
        completed.alias("completed_at"),
    )


# ------------------------------------------------------------------------------ inventory

def stock_requests(spark: SparkSession, d: str) -> DataFrame:
    """Every line item is a request to take ``l_quantity`` units of its part from the warehouse
    of its supplier.  Requests of one key are served in (ship date, then all columns) order."""
    li = load(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.pmod(F.col("l_suppkey"), F.lit(WAREHOUSES)).alias("warehouse_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
    )


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Orders as lines of text, as an outside system might send them: ten of forty orders, told by
    their number, have a field that is missing, of another type, not allowed, or one too many."""
    o = load(spark, d, "orders")
    k = F.pmod("o_orderkey", F.lit(40))
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "paid").otherwise("new")

    def text(c):
        return c.cast("string")

    fields = [
        F.when(k == 1, "").when(k == 8, "n17").otherwise(text(F.col("o_orderkey"))),
        F.when(k == 2, "abc").when(k == 9, "").otherwise(text(F.col("o_custkey"))),
        F.when(k == 10, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.when(k == 3, "lost").when(k == 4, "  ").otherwise(status),
        F.when(k.isin(5, 10), "-5").when(k == 6, "").otherwise(text(F.col("o_totalprice").cast("decimal(12,2)"))),
    ]
    return o.select(F.concat(F.concat_ws(",", *fields), F.when(k == 7, ",one,more").otherwise("")).alias("value"))


# order of requests within one (warehouse, product)
REQUEST_ORDER = ["ts", "order_id", "line_no", "supplier_id", "quantity", "price", "discount", "tax"]


def warehouse_stock(spark: SparkSession, d: str, quantity: int = INITIAL_STOCK) -> DataFrame:
    """Stock rows: every part in every warehouse holds ``quantity`` units (J04: part x series)."""
    p = load(spark, d, "part")
    return p.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(WAREHOUSES - 1).cast("long"))).alias("warehouse_id"),
        F.col("p_partkey").alias("product_id"),
        F.lit(quantity).cast("long").alias("quantity"),
    )


def step_flags() -> dict:
    """Saga step outcomes of a request row: the event write fails for returned lines ('R'), the
    reservation release fails for open lines ('O')."""
    return {"event_ok": F.col("return_flag") != "R", "release_ok": F.col("line_status") != "O"}


def _event_id():
    """md5 of the line's identifying columns (integers and the ship day, so every engine prints
    them the same way)."""
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    parts += [F.col("l_quantity").cast("long").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd")]
    return F.md5(F.concat_ws("|", *parts))


def inventory_events(spark: SparkSession, d: str) -> DataFrame:
    """Inventory event log over line items, as delivered (with redeliveries).

    Returned lines ('R') are STOCK_RECEIVED (+qty), the others STOCK_DECREASED (-qty).  The
    event id is an md5 of the line's identifying columns.  Open lines ('O') are delivered a second time, as a
    retrying producer would, so the log holds duplicate event ids.
    """
    li = load(spark, d, "lineitem")
    ev = li.select(
        _event_id().alias("event_id"),
        F.when(F.col("l_returnflag") == "R", "STOCK_RECEIVED").otherwise("STOCK_DECREASED").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        F.pmod(F.col("l_suppkey"), F.lit(WAREHOUSES)).alias("warehouse_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("long"))
        .otherwise(-F.col("l_quantity").cast("long")).alias("quantity"),
        F.col("l_shipdate").alias("timestamp"),
        F.create_map(F.lit("order_id"), F.col("l_orderkey").cast("string")).alias("metadata"),
        F.lit(0).alias("delivery"),
        F.col("l_linestatus"),
    )
    again = ev.filter(F.col("l_linestatus") == "O").withColumn("delivery", F.lit(1))
    return ev.unionByName(again).drop("l_linestatus")


def cart_log(spark: SparkSession, d: str, ttl: int = CART_TTL_SECONDS) -> DataFrame:
    """Cart actions over events: click/view reserve, error cancels, purchase confirms.

    product = k of the event, quantity = 1 + event_id % 5, warehouse = the one that serves the user
    (user_id % 5); signups are not cart actions.
    """
    e = load(spark, d, "events")
    action = F.when(F.col("event_type").isin("click", "view"), "reserve") \
        .when(F.col("event_type") == "error", "cancel") \
        .when(F.col("event_type") == "purchase", "confirm")
    return e.select(
        F.col("event_id"),
        F.col("user_id"),
        _k().cast("long").alias("product_id"),
        F.pmod(F.col("user_id"), F.lit(WAREHOUSES)).cast("long").alias("warehouse_id"),
        action.alias("action"),
        (F.lit(1) + F.pmod(F.col("event_id"), F.lit(5))).alias("quantity"),
        F.col("ts"),
        F.lit(ttl).alias("ttl"),
    ).filter(F.col("action").isNotNull())


def probe_log(spark: SparkSession, d: str) -> DataFrame:
    """Availability probes: per user, each event is a probe; an 'error' event is a failure."""
    e = load(spark, d, "events")
    return e.select(
        F.col("user_id").alias("target"),
        F.col("ts"),
        F.col("event_id").alias("probe_id"),
        (F.col("event_type") != "error").alias("ok"),
    )
