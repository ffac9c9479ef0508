"""Synthetic data generators (S03-S06), seeded and reproducible.

Rows come from ``spark.range`` (partitioned, no driver data); every random column is a
seeded md5-derived integer salted with the column's own name, so columns are independent (the
reference's seed drew one ``rand()`` per row for several columns).  The same integers come out
of any SQL engine with md5 and base-16 parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import seeded_int

# The reference's seed categories, by id % 5.
CATEGORY_BY_MOD5 = ["Electronics", "Books", "Clothing", "Home", "Sports"]
# Order status by id % 4.
STATUS_BY_MOD4 = ["new", "paid", "shipped", "done"]


def series(spark: SparkSession, lo: int, hi: int, num_partitions: int | None = None) -> DataFrame:
    """Integers lo..hi inclusive as column ``i``."""
    return spark.range(lo, hi + 1, numPartitions=num_partitions).withColumnRenamed("id", "i")


def rand01(seed, salt: str, *cols) -> Column:
    """Uniform [0, 1) from a seeded md5 integer."""
    return seeded_int(seed, F.lit(salt), *cols) / F.lit(float(2 ** 32))


def pg_int(x: Column) -> Column:
    """``::int`` of the reference (rounds half away from zero)."""
    return F.round(x).cast("int")


def gen_clients(spark: SparkSession, n: int, seed=1, created_at="2026-01-01 00:00:00") -> DataFrame:
    """Clients 1..n with unique e-mails and phone numbers."""
    i = F.col("i")
    return series(spark, 1, n).select(
        i.cast("long").alias("id"),
        F.concat(F.lit("Client "), i.cast("string")).alias("name"),
        F.concat(F.lit("client"), i.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+7"), F.lpad((F.lit(9000000000) + i).cast("string"), 10, "0")).alias("phone"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )


def gen_products(spark: SparkSession, n: int, seed=1) -> DataFrame:
    """Products with price in [100, 9100) and a category by id."""
    i = F.col("i")
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORY_BY_MOD5]), (i % 5 + 1).cast("int"))
    return series(spark, 1, n).select(
        i.cast("long").alias("id"),
        F.concat(F.lit("Product "), i.cast("string")).alias("name"),
        (rand01(seed, "price", i) * 9000 + 100).cast("decimal(10,2)").alias("price"),
        cat.alias("category"),
    )


def gen_orders(spark: SparkSession, n: int, n_clients: int, seed=1, as_of="2026-06-01") -> DataFrame:
    """Orders over the last two years before ``as_of``, random client, status by id."""
    i = F.col("i")
    day = F.to_date(F.lit(as_of))
    status = F.element_at(F.array(*[F.lit(s) for s in STATUS_BY_MOD4]), (i % 4 + 1).cast("int"))
    return series(spark, 1, n).select(
        i.cast("long").alias("id"),
        (pg_int(rand01(seed, "client", i) * (n_clients - 1) + 1)).cast("long").alias("client_id"),
        F.date_sub(day, pg_int(rand01(seed, "date", i) * 730)).cast("timestamp_ntz").alias("order_date"),
        status.alias("status"),
        F.lit(0).cast("decimal(12,2)").alias("total_amount"),
    )


def gen_order_items(orders: DataFrame, products: DataFrame, seed=1, per_order: int = 3) -> DataFrame:
    """``per_order`` items per order (J04: each order x a short series), each with a random
    product whose price it takes (J05: the random key is projected first, then equi-joined)."""
    n_products = products.agg(F.max("id")).scalar()
    o = orders.select(F.col("id").alias("order_id"),
                      F.explode(F.sequence(F.lit(1), F.lit(per_order))).alias("line_no"))
    key = F.struct("order_id", "line_no")
    items = o.select(
        "order_id", "line_no",
        pg_int(rand01(seed, "product", key) * (n_products - 1) + 1).cast("long").alias("product_id"),
        pg_int(rand01(seed, "qty", key) * 5 + 1).alias("quantity"),
        F.when(rand01(seed, "has_disc", key) < 0.2, (rand01(seed, "disc", key) * 20).cast("decimal(5,2)"))
        .otherwise(F.lit(0).cast("decimal(5,2)")).alias("discount"),
    )
    prices = products.select(F.col("id").alias("product_id"), F.col("price").alias("unit_price"))
    out = items.join(prices, "product_id")
    return out.select((F.col("order_id") * per_order + F.col("line_no") - per_order).alias("id"),
                      "order_id", "product_id", "quantity", "unit_price", "discount")


# Hour bands of the activity seed (cumulative percent, hour); the rest uniform.
HOUR_BANDS = [(15, 9), (25, 10), (35, 19), (45, 20), (55, 21), (65, 14), (75, 16)]
# Event type bands (cumulative percent, type id); the rest purchases (4).
TYPE_BANDS = [(40, 1), (60, 2), (70, 5), (80, 3), (90, 6), (95, 7)]
DEVICE_BANDS = [(55, "mobile"), (85, "desktop")]            # rest tablet
COUNTRY_BANDS = [(35, "Russia"), (55, "USA"), (70, "Germany"), (80, "UK"), (90, "France")]  # rest Other


def _bands(pct: Column, bands, rest) -> Column:
    expr = None
    for upper, value in bands:
        expr = F.when(pct < upper, F.lit(value)) if expr is None else expr.when(pct < upper, F.lit(value))
    return expr.otherwise(rest)


def gen_activity(spark: SparkSession, n: int, start="2026-06-20", days: int = 90, users: int = 100_000,
                 seed=1) -> DataFrame:
    """Activity events with morning/evening peaks, weighted types, devices and countries.

    Purchases carry a value of 10..999, other events 0..9; page views and searches last
    5..299 s, other events 1..30 s; a session is one user's hour.
    """
    i = F.col("i")
    r = lambda salt: seeded_int(seed, F.lit(salt), i)
    pct = lambda salt: r(salt) % 100
    hour = _bands(pct("hour"), HOUR_BANDS, r("hour_u") % 24)
    base = F.to_timestamp(F.lit(start)).cast("timestamp_ntz")
    ts = F.timestamp_add("SECOND", (i % days) * 86400 + hour * 3600 + (r("minute") % 60) * 60 + r("second") % 60, base)
    etype = _bands(pct("type"), TYPE_BANDS, F.lit(4))
    out = series(spark, 0, n - 1).select(
        ts.alias("ts"),
        (r("user") % users + 1).alias("user_id"),
        etype.cast("int").alias("event_type"),
        F.when(etype == 4, 10 + r("value") % 990).otherwise(r("value") % 10).cast("float").alias("event_value"),
        _bands(pct("device"), DEVICE_BANDS, F.lit("tablet")).alias("device_type"),
        _bands(pct("country"), COUNTRY_BANDS, F.lit("Other")).alias("country"),
        F.when(etype.isin(1, 5), 5 + r("dur") % 295).otherwise(1 + r("dur") % 30).cast("int").alias("duration"),
    )
    out = out.withColumn("session_id", F.md5(F.concat_ws("-", F.col("user_id").cast("string"),
                                                         F.date_format(F.date_trunc("hour", "ts"), "yyyyMMddHH"))))
    return out.withColumn("event_date", F.to_date("ts"))


def gen_jobs(spark: SparkSession, n: int, seed=1, now="2026-06-01 00:00:00") -> DataFrame:
    """N new jobs with priority 0..10, all created at ``now`` (as the reference's seed)."""
    i = F.col("i")
    return series(spark, 1, n).select(
        i.cast("long").alias("id"),
        F.concat(F.lit("Task "), i.cast("string")).alias("title"),
        F.concat(F.lit("Description for task "), i.cast("string"), F.lit(" - "),
                 F.md5(F.concat_ws("|", F.lit(str(seed)), i.cast("string")))).alias("description"),
        F.lit("new").alias("status"),
        pg_int(rand01(seed, "priority", i) * 10).alias("priority"),
        F.lit(None).cast("long").alias("worker_id"),
        F.lit(now).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )
