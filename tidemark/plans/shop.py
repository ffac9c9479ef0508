"""Registered shop queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import months_before, since
from tidemark.functions.numeric import line_revenue
from tidemark.operators import commerce
from tidemark.plans.registry import register
from tidemark.session import scratch_path
from tidemark.sources import driver as src

CUTOFF = months_before(src.AS_OF, 6).strftime("%Y-%m-%d %H:%M:%S")

# exact line revenue in SQL, the same decimal arithmetic as functions.numeric.line_revenue
REVENUE_SQL = "CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2)))"


@register("j01_top_clients", f"""
WITH recent AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'),
lines AS (
  SELECT r.o_custkey AS client_id, l.l_orderkey AS order_id, {REVENUE_SQL} AS revenue
  FROM lineitem l JOIN recent r ON l.l_orderkey = r.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey
  WHERE p.p_type = '{src.ECONOMY}')
SELECT c.c_custkey AS client_id, c.c_name AS name, lower(c.c_name) || '@example.com' AS email,
       count(DISTINCT order_id) AS order_count, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM lines JOIN customer c ON c.c_custkey = lines.client_id
GROUP BY 1, 2, 3
ORDER BY total_revenue DESC, client_id
LIMIT 100
""")
def j01_top_clients(spark, d):
    return commerce.top_clients(src.clients(spark, d), src.shop_orders(spark, d), src.order_items(spark, d),
                                src.products(spark, d), src.ECONOMY, src.AS_OF, months=6, k=100)


@register("j02_top_clients_denorm", f"""
WITH recent AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'),
items AS (SELECT l.*, p.p_type AS category FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey),
lines AS (
  SELECT r.o_custkey AS client_id, i.l_orderkey AS order_id, {REVENUE_SQL} AS revenue
  FROM items i JOIN recent r ON i.l_orderkey = r.o_orderkey
  WHERE i.category = '{src.ECONOMY}')
SELECT c.c_custkey AS client_id, c.c_name AS name, lower(c.c_name) || '@example.com' AS email,
       count(DISTINCT order_id) AS order_count, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM lines JOIN customer c ON c.c_custkey = lines.client_id
GROUP BY 1, 2, 3
ORDER BY total_revenue DESC, client_id
LIMIT 100
""")
def j02_top_clients_denorm(spark, d):
    """The denormalised items are a written table, so the query itself reads no products."""
    items = commerce.denormalise(src.order_items(spark, d).select("order_id", "product_id", "revenue"),
                                 src.products(spark, d), "product_id", ("category",))
    path = scratch_path(spark, "items_with_category")
    items.write.parquet(path)
    items = spark.read.schema(items.schema).parquet(path)
    return commerce.top_clients_denorm(src.clients(spark, d), src.shop_orders(spark, d), items,
                                       src.ECONOMY, src.AS_OF, months=6, k=100)


@register("s11_denormalise", f"""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id,
       l.l_suppkey AS supplier_id, p.p_type AS category
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
""")
def s11_denormalise(spark, d):
    items = src.order_items(spark, d).select("order_id", "line_no", "product_id", "supplier_id")
    return commerce.denormalise(items, src.products(spark, d), "product_id", ("category",))


@register("s11_fill_missing", f"""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id, l.l_suppkey AS supplier_id,
       CASE WHEN l_returnflag = 'R' THEN 'KEPT' ELSE p.p_type END AS category
FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
""")
def s11_fill_missing(spark, d):
    """Items of returned lines carry a category already; only the others take the product's."""
    li = src.stock_requests(spark, d)
    items = li.select("order_id", "line_no", "product_id", "supplier_id",
                      F.when(F.col("return_flag") == "R", "KEPT").alias("category"))
    return commerce.denormalise(items, src.products(spark, d), "product_id", ("category",))


@register("s12_order_totals", f"""
SELECT o.o_orderkey AS id, o.o_custkey AS client_id, o.o_orderstatus AS status,
       CAST(COALESCE(t.total, 0) AS DOUBLE) AS total_amount
FROM orders o LEFT JOIN (
  SELECT l_orderkey, sum({REVENUE_SQL}) AS total FROM lineitem GROUP BY l_orderkey) t
  ON t.l_orderkey = o.o_orderkey
""")
def s12_order_totals(spark, d):
    o = src.shop_orders(spark, d).select("id", "client_id", "status")
    out = commerce.order_totals(o, src.order_items(spark, d), "revenue")
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@register("f03_recent_orders", f"""
SELECT o_orderstatus AS status, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS amount
FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF}'
GROUP BY o_orderstatus
""")
def f03_recent_orders(spark, d):
    o = since(src.shop_orders(spark, d), "order_date", src.AS_OF, 6)
    return o.groupBy("status").agg(F.count(F.lit(1)).alias("orders"),
                                   F.sum(F.col("total_amount").cast("decimal(15,2)")).cast("double").alias("amount"))


@register("f04_search_catalog", """
SELECT p_partkey AS id, p_name AS name, p_type AS category
FROM part
WHERE p_type = 'ECONOMY' AND list_contains(string_split(p_name, ' '), 'red')
""")
def f04_search_catalog(spark, d):
    return commerce.search_catalog(src.products(spark, d), src.ECONOMY, "red").select("id", "name", "category")


@register("t04_page_products", """
SELECT p_partkey AS id, p_name AS name, p_retailprice AS price
FROM part WHERE list_contains(string_split(p_name, ' '), 'widget')
ORDER BY p_retailprice DESC, p_partkey
LIMIT 20 OFFSET 40
""")
def t04_page_products(spark, d):
    items, _total = commerce.page(src.products(spark, d), skip=40, limit=20, tag="widget",
                                  order_col="price", key_col="id")
    return items.select("id", "name", "price")


@register("t04_next_page", """
WITH hits AS (SELECT p_partkey AS id, p_name AS name, p_retailprice AS price FROM part
              WHERE list_contains(string_split(p_name, ' '), 'widget'))
SELECT id, name, price FROM hits WHERE price < 949.3 OR (price = 949.3 AND id > 493)
ORDER BY price DESC, id LIMIT 20
""")
def t04_next_page(spark, d):
    items, _total = commerce.page(src.products(spark, d), limit=20, tag="widget", order_col="price", key_col="id",
                                  after=(949.3, 493))
    return items.select("id", "name", "price")


@register("t04_page_total", """
SELECT count(*) AS total FROM part WHERE list_contains(string_split(p_name, ' '), 'widget')
""")
def t04_page_total(spark, d):
    _items, total = commerce.page(src.products(spark, d), skip=40, limit=20, tag="widget",
                                  order_col="price", key_col="id")
    return total


@register("a16_table_counts", """
SELECT 'clients' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'products', count(*) FROM part
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'order_items', count(*) FROM lineitem
""")
def a16_table_counts(spark, d):
    return commerce.table_counts({
        "clients": src.clients(spark, d), "products": src.products(spark, d),
        "orders": src.shop_orders(spark, d), "order_items": src.order_items(spark, d)})


@register("p02_revenue_by_flag", f"""
SELECT l_returnflag AS return_flag, l_linestatus AS line_status,
       count(*) AS lines, CAST(sum({REVENUE_SQL}) AS DOUBLE) AS revenue
FROM lineitem GROUP BY 1, 2
""")
def p02_revenue_by_flag(spark, d):
    items = src.load(spark, d, "lineitem")
    return items.groupBy(F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status")) \
        .agg(F.count(F.lit(1)).alias("lines"),
             F.sum(line_revenue(None, "l_extendedprice", "l_discount", discount_in_percent=False))
             .cast("double").alias("revenue"))
