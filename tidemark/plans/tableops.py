"""Registered table operations and primitives (S10, S14, S15, S17, J08, J09, F05, F06, F08,
N01/N02, A05, A09, A11, X01, T01/T05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import tables as tb
from tidemark.plans.activity import ACT, R
from tidemark.plans.queue import JOBS
from tidemark.plans.registry import register
from tidemark.sources import driver as src

AS_OF = "2024-06-01 00:00:00"


@register("s10_reset_jobs", f"""WITH {JOBS}
SELECT id, 'new' AS status, CAST(NULL AS BIGINT) AS worker_id, CAST(NULL AS TIMESTAMP) AS started_at, priority FROM jobs
""")
def s10_reset_jobs(spark, d):
    j = tb.reset_columns(src.jobs(spark, d), {"status": "new", "worker_id": None, "started_at": None})
    return j.select("id", "status", "worker_id", "started_at", "priority")


def _product_docs(spark, d):
    p = src.products(spark, d)
    return p.select("id", "name", F.col("price").alias("price"), F.col("category"),
                    F.lit(None).cast("timestamp_ntz").alias("updated_at"))


@register("s14_patch_products", f"""
WITH patches AS (
  SELECT p_partkey AS id,
         CASE WHEN p_size >= 45 THEN round(p_retailprice * 1.1, 2) END AS price,
         CASE WHEN p_size >= 48 THEN upper(p_name) END AS name
  FROM part WHERE p_size >= 45 OR p_size <= 2),
good AS (SELECT * FROM patches WHERE price IS NOT NULL OR name IS NOT NULL)
SELECT p.p_partkey AS id, COALESCE(g.name, p.p_name) AS name, COALESCE(g.price, p.p_retailprice) AS price,
       p.p_type AS category, CASE WHEN g.id IS NOT NULL THEN TIMESTAMP '{AS_OF}' END AS updated_at
FROM part p LEFT JOIN good g ON g.id = p.p_partkey
""")
def s14_patch_products(spark, d):
    """Big parts get a 10% price patch, the biggest also a new name; the smallest get an empty
    patch (only the key), which is rejected."""
    part = src.load(spark, d, "part")
    patches = part.filter((F.col("p_size") >= 45) | (F.col("p_size") <= 2)).select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") >= 45, F.round(F.col("p_retailprice") * 1.1, 2)).alias("price"),
        F.when(F.col("p_size") >= 48, F.upper("p_name")).alias("name"))
    new, _rejected = tb.patch(_product_docs(spark, d), patches, "id", AS_OF)
    return new


@register("s14_rejected_patches", """
SELECT p_partkey AS id FROM part WHERE p_size <= 2 AND p_size < 45
""")
def s14_rejected_patches(spark, d):
    part = src.load(spark, d, "part")
    patches = part.filter((F.col("p_size") >= 45) | (F.col("p_size") <= 2)).select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") >= 45, F.round(F.col("p_retailprice") * 1.1, 2)).alias("price"),
        F.when(F.col("p_size") >= 48, F.upper("p_name")).alias("name"))
    _new, rejected = tb.patch(_product_docs(spark, d), patches, "id", AS_OF)
    return rejected.select("id")


DELETE_KEYS = """keys AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'
                        AND o_orderstatus = 'F')"""


@register("s15_delete_keys", f"""WITH {DELETE_KEYS}
SELECT p_partkey AS id, p_name AS name FROM part WHERE p_partkey NOT IN (SELECT id FROM keys)
""")
def s15_delete_keys(spark, d):
    """Delete the parts whose ids are listed by urgent filled orders' customer keys (a key list
    derived from the data; some keys exist as parts, some do not)."""
    new, _missing = tb.delete_keys(src.products(spark, d).select("id", "name"), _delete_keys(spark, d), "id")
    return new


def _delete_keys(spark, d):
    o = src.load(spark, d, "orders")
    return o.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")) \
        .select(F.col("o_custkey").alias("id"))


@register("s15_missing_keys", f"""WITH {DELETE_KEYS}
SELECT id FROM keys WHERE id NOT IN (SELECT p_partkey FROM part)
""")
def s15_missing_keys(spark, d):
    _new, missing = tb.delete_keys(src.products(spark, d).select("id", "name"), _delete_keys(spark, d), "id")
    return missing


@register("s17_create_products", f"""
SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, 0 AS quantity, array_to_string(string_split(p_name, ' '), '|') AS tags,
       TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at
FROM part
""")
def s17_create_products(spark, d):
    """Every part becomes a product document with defaults (quantity 0, created = updated = now)."""
    from tidemark.sources.contracts import CONTRACTS

    base = spark.createDataFrame([], CONTRACTS["product_documents"])
    new = src.products(spark, d).select(F.col("id").cast("string").alias("id"), "name", "price", "tags")
    out = tb.create_rows(base, new, {"quantity": 0, "created_at": F.lit(AS_OF), "updated_at": F.lit(AS_OF)})
    return out.withColumn("id", F.col("id").cast("long")).withColumn(
        "tags", F.array_join("tags", "|"))


@register("j08_keep_known", """
SELECT l_returnflag, count(*) AS lines FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
GROUP BY 1
""")
def j08_keep_known(spark, d):
    big = src.load(spark, d, "part").filter(F.col("p_size") > 25)
    li = tb.keep_known(src.load(spark, d, "lineitem"), big, "l_partkey", "p_partkey")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@register("j09_unknown_keys", """
SELECT l_returnflag, count(*) AS lines FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)
GROUP BY 1
""")
def j09_unknown_keys(spark, d):
    big = src.load(spark, d, "part").filter(F.col("p_size") > 25)
    li = tb.unknown_keys(src.load(spark, d, "lineitem"), big, "l_partkey", "p_partkey")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


@register("f08_lookup_many", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)
""")
def f08_lookup_many(spark, d):
    ids = src.load(spark, d, "lineitem").filter(F.col("l_quantity") == 50).select(F.col("l_orderkey").alias("o_orderkey"))
    return tb.get_by_id(src.load(spark, d, "orders"), ids, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@register("f05_f06_isin_isnull", """
SELECT o_orderpriority, count(*) AS n, count(*) FILTER (WHERE o_custkey IS NULL) AS null_customers FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1
""")
def f05_f06_isin_isnull(spark, d):
    o = src.load(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return o.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                            F.count_if(F.col("o_custkey").isNull()).alias("null_customers"))


@register("n01_n02_daily_counts", f"""WITH {ACT}
SELECT event_id, CAST(ts AS DATE) AS day,
       count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS rows_in_partition,
       count(DISTINCT user_id) OVER (PARTITION BY CAST(ts AS DATE)) AS distinct_in_partition
FROM act
""")
def n01_n02_daily_counts(spark, d):
    ev = src.activity_events(spark, d)
    out = tb.with_partition_counts(ev, F.to_date("ts"), "day", "user_id", bounded=True)
    return out.select("event_id", "day", "rows_in_partition", "distinct_in_partition")


@register("a05_a11_type_shares", f"""WITH {ACT}
SELECT device_type,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       CAST(COALESCE(sum(CAST(event_value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'error'), 0) AS DOUBLE) AS error_value,
       {R("100.0::DOUBLE * count(*) / (SELECT count(*) FROM act)", 2)} AS pct_of_total
FROM act GROUP BY 1
""")
def a05_a11_type_shares(spark, d):
    from tidemark.functions.numeric import pct

    ev = src.activity_events(spark, d)
    per = ev.groupBy("device_type").agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.coalesce(F.sum(F.when(F.col("event_type") == "error", F.col("event_value").cast("decimal(18,2)"))),
                   F.lit(0)).cast("double").alias("error_value"),
        F.count(F.lit(1)).alias("n"))
    from tidemark.operators.activity import share_total
    return per.select("device_type", "purchases", "error_value", pct(F.col("n"), share_total("n"), 2).alias("pct_of_total"))


@register("a09_ordered_array_agg", f"""WITH {JOBS},
ranked AS (SELECT id, row_number() OVER (ORDER BY priority DESC, created_at, id) AS claim_rank
           FROM jobs WHERE status = 'new')
SELECT CAST((claim_rank - 1) // 1000 + 1 AS BIGINT) AS worker_id,
       string_agg(CAST(id AS VARCHAR), ',' ORDER BY claim_rank) AS job_ids
FROM ranked GROUP BY 1
""")
def a09_ordered_array_agg(spark, d):
    """array_agg(job ORDER BY log id) per worker over the claim-all run: each list is bounded by
    the per-worker batch (1000), as in the reference's per-worker array_agg."""
    from tidemark.operators import workqueue as wq

    log = wq.claim_log(wq.claim_batch(src.jobs(spark, d), None, 1000), "2024-06-01 12:00:00")
    dist = wq.worker_distribution(log)
    return dist.select("worker_id",
                       F.array_join(F.transform("job_ids", lambda x: x.cast("string")), ",").alias("job_ids"))


@register("x01_metrics", """
SELECT 'orders' AS metric, CAST(count(*) AS VARCHAR) AS value FROM orders
UNION ALL SELECT 'open_orders', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'customers_with_orders', CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM orders
""")
def x01_metrics(spark, d):
    o = src.load(spark, d, "orders")
    return tb.metrics({
        "orders": o.agg(F.count(F.lit(1))),
        "open_orders": o.filter(F.col("o_orderstatus") == "O").agg(F.count(F.lit(1))),
        "customers_with_orders": o.agg(F.count_distinct("o_custkey")),
    })


@register("t01_top_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def t01_top_orders(spark, d):
    o = src.load(spark, d, "orders")
    return tb.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10).select("o_orderkey", "o_totalprice")
