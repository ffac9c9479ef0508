"""Registered quality checks (Q01-Q05), availability (O01) and scalar-function primitives."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import availability, quality
from tidemark.plans.registry import register
from tidemark.sources import driver as src


@register("q01_not_null", """
SELECT 'not_null' AS "check", 'orders.' || c AS target, v AS violations FROM (
  SELECT 'o_custkey' AS c, count(*) FILTER (WHERE o_custkey IS NULL) AS v FROM orders
  UNION ALL SELECT 'o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
  UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
  UNION ALL SELECT 'o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders)
""")
def q01_not_null(spark, d):
    o = src.load(spark, d, "orders")
    return quality.check_not_null(o, ["o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"], "orders")


@register("q02_unique_order_lines", """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def q02_unique_order_lines(spark, d):
    return quality.check_unique(src.load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("q02_unique_emails", """
SELECT lower(c_name) || '@example.com' AS email, count(*) AS rows FROM customer GROUP BY 1 HAVING count(*) > 1
""")
def q02_unique_emails(spark, d):
    return quality.check_unique(src.clients(spark, d), "email")


@register("q03_foreign_keys", """
SELECT 'foreign_key' AS "check", 'lineitem.l_partkey' AS target, count(*) AS violations
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL SELECT 'foreign_key', 'lineitem.l_orderkey', count(*) FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'foreign_key', 'orders.o_custkey', count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'foreign_key', 'events.user_id', count(*) FROM events
  WHERE user_id NOT IN (SELECT c_custkey FROM customer)
""")
def q03_foreign_keys(spark, d):
    L = lambda n: src.load(spark, d, n)
    return quality.violations(
        quality.fk_summary(L("lineitem"), L("part"), "l_partkey", "p_partkey", "lineitem.l_partkey"),
        quality.fk_summary(L("lineitem"), L("orders"), "l_orderkey", "o_orderkey", "lineitem.l_orderkey"),
        quality.fk_summary(L("orders"), L("customer"), "o_custkey", "c_custkey", "orders.o_custkey"),
        quality.fk_summary(L("events"), L("customer"), "user_id", "c_custkey", "events.user_id"),
    )


RULES_SQL = """
  SELECT 'rule' AS "check", 'lineitem.' || r AS target, v AS violations FROM (
    SELECT 'quantity_1_50' AS r, count(*) FILTER (WHERE NOT COALESCE(l_quantity BETWEEN 1 AND 50, false)) AS v FROM lineitem
    UNION ALL SELECT 'discount_0_10pct', count(*) FILTER (WHERE NOT COALESCE(l_discount BETWEEN 0 AND 0.1, false)) FROM lineitem
    UNION ALL SELECT 'flag_accepted', count(*) FILTER (WHERE NOT COALESCE(l_returnflag IN ('A', 'N', 'R'), false)) FROM lineitem
    UNION ALL SELECT 'ship_after_order_1995', count(*) FILTER (WHERE NOT COALESCE(l_shipdate >= TIMESTAMP '1995-01-01', false)) FROM lineitem)
"""


def _rules():
    return {
        "quantity_1_50": F.col("l_quantity").between(1, 50),
        "discount_0_10pct": F.col("l_discount").between(0, 0.1),
        "flag_accepted": F.col("l_returnflag").isin("A", "N", "R"),
        "ship_after_order_1995": F.col("l_shipdate") >= F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"),
    }


@register("q04_rules", RULES_SQL)
def q04_rules(spark, d):
    counts, _bad = quality.check_rules(src.load(spark, d, "lineitem"), _rules(), "lineitem")
    return counts


@register("q04_rule_breakers", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE NOT COALESCE(l_quantity BETWEEN 1 AND 50, false) OR NOT COALESCE(l_discount BETWEEN 0 AND 0.1, false)
   OR NOT COALESCE(l_returnflag IN ('A', 'N', 'R'), false) OR NOT COALESCE(l_shipdate >= TIMESTAMP '1995-01-01', false)
""")
def q04_rule_breakers(spark, d):
    _counts, bad = quality.check_rules(src.load(spark, d, "lineitem"), _rules(), "lineitem")
    return bad.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register("q05_violations", """
SELECT 'unique' AS "check", 'lineitem.(l_orderkey,l_linenumber)' AS target, count(*) AS violations FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'orders.o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'not_null', 'orders.o_orderdate', count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL
""" + RULES_SQL)
def q05_violations(spark, d):
    L = lambda n: src.load(spark, d, n)
    counts, _ = quality.check_rules(L("lineitem"), _rules(), "lineitem")
    return quality.violations(
        quality.unique_summary(L("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem.(l_orderkey,l_linenumber)"),
        quality.fk_summary(L("orders"), L("customer"), "o_custkey", "c_custkey", "orders.o_custkey"),
        quality.check_not_null(L("orders"), ["o_orderdate"], "orders"),
        counts,
    )


@register("o01_outages", """
WITH p AS (SELECT user_id AS target, ts, event_id AS probe_id, event_type <> 'error' AS ok FROM events),
f AS (SELECT *, CASE WHEN lag(ok) OVER w IS NULL OR ok <> lag(ok) OVER w THEN 1 ELSE 0 END AS flag
      FROM p WINDOW w AS (PARTITION BY target ORDER BY ts, probe_id)),
r AS (SELECT *, sum(flag) OVER (PARTITION BY target ORDER BY ts, probe_id ROWS UNBOUNDED PRECEDING) AS run_no FROM f),
runs AS (SELECT target, run_no, bool_and(ok) AS ok, min(ts) AS started, count(*) AS probes FROM r GROUP BY 1, 2)
SELECT a.target, a.run_no, a.started AS failed_at, a.probes AS failed_probes, b.started AS recovered_at,
       (epoch_us(b.started) - epoch_us(a.started)) / 1000000.0::DOUBLE AS recovery_seconds
FROM runs a LEFT JOIN runs b ON b.target = a.target AND b.run_no = a.run_no + 1
WHERE NOT a.ok
""")
def o01_outages(spark, d):
    return availability.outages(src.probe_log(spark, d))


@register("o01_recovery_summary", """
WITH p AS (SELECT user_id AS target, ts, event_id AS probe_id, event_type <> 'error' AS ok FROM events),
f AS (SELECT *, CASE WHEN lag(ok) OVER w IS NULL OR ok <> lag(ok) OVER w THEN 1 ELSE 0 END AS flag
      FROM p WINDOW w AS (PARTITION BY target ORDER BY ts, probe_id)),
r AS (SELECT *, sum(flag) OVER (PARTITION BY target ORDER BY ts, probe_id ROWS UNBOUNDED PRECEDING) AS run_no FROM f),
runs AS (SELECT target, run_no, bool_and(ok) AS ok, min(ts) AS started, count(*) AS probes FROM r GROUP BY 1, 2),
o AS (SELECT a.target, (epoch_us(b.started) - epoch_us(a.started)) / 1000000.0::DOUBLE AS s
      FROM runs a LEFT JOIN runs b ON b.target = a.target AND b.run_no = a.run_no + 1 WHERE NOT a.ok)
SELECT count(*) AS outages, count(s) AS recovered, max(s) AS longest_recovery_seconds FROM o
""")
def o01_recovery_summary(spark, d):
    o = availability.outages(src.probe_log(spark, d))
    return o.agg(F.count(F.lit(1)).alias("outages"), F.count("recovery_seconds").alias("recovered"),
                 F.max("recovery_seconds").alias("longest_recovery_seconds"))
