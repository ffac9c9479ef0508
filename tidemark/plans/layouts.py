"""Registered layout queries: the same lookups over the four layouts (U01-U03 x S08), layout and
partition reports (S18), retention (S16), append (S07), replace (S09), CSV export (S19).

The layouts are written from the activity events into a fresh folder under the shared
checkpoint folder, once per Spark application and table folder, then read back.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import activity as act
from tidemark.plans.activity import (ACT, HOUR_HI, HOUR_LO, PROFILE_HI, PROFILE_LO, PROFILE_USER,
                                     RANGE_HI, RANGE_LO, R)
from tidemark.plans.registry import register
from tidemark.session import scratch_path, table_state
from tidemark.sources import contracts
from tidemark.sources import driver as src
from tidemark.sources import layout as lay

_WRITTEN: dict[tuple, dict] = {}


def four_layouts(spark, d) -> dict[str, str]:
    """Paths of the four layouts of ``d``'s activity events (written on first use, and again when the
    tables have changed)."""
    key = (spark.sparkContext.applicationId, d, *(table_state(spark, os.path.join(d, f"{t}.parquet")) for t in ("events", "customer", "nation")))
    if key not in _WRITTEN:
        base = scratch_path(spark, "layouts")
        _WRITTEN[key] = lay.write_four_layouts(src.activity_events(spark, d), base)
    return _WRITTEN[key]


def _over_layouts(spark, d, fn):
    out = None
    for name, path in four_layouts(spark, d).items():
        grain, _sort = lay.LAYOUTS[name]
        df = spark.read.parquet(path)
        one = fn(df, lay.GRAIN_COLUMN[grain], grain).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _four(sql_body: str) -> str:
    rows = [f"SELECT '{n}' AS table_name, * FROM ({sql_body})" for n in lay.LAYOUTS]
    return f"WITH {ACT}\n" + "\nUNION ALL\n".join(rows)


@register("u01_user_profile_layouts", _four(f"""
SELECT count(*) AS events, min(ts) AS first_event, max(ts) AS last_event,
       CAST(sum(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       count(DISTINCT session_id) AS sessions
FROM act WHERE user_id = {PROFILE_USER} AND ts >= TIMESTAMP '{PROFILE_LO}' AND ts < TIMESTAMP '{PROFILE_HI}'"""))
def u01_user_profile_layouts(spark, d):
    return _over_layouts(spark, d, lambda df, c, g: act.user_profile(df, PROFILE_USER, PROFILE_LO, PROFILE_HI,
                                                                      date_col=c, grain=g))


@register("u02_hour_activity_layouts", _four(f"""
SELECT count(*) AS events, count(DISTINCT user_id) AS unique_users FROM act
WHERE ts >= TIMESTAMP '{HOUR_LO}' AND ts < TIMESTAMP '{HOUR_HI}'"""))
def u02_hour_activity_layouts(spark, d):
    return _over_layouts(spark, d, lambda df, c, g: act.hour_activity(df, HOUR_LO, HOUR_HI, date_col=c, grain=g))


@register("u03_range_activity_layouts", _four(f"""
SELECT count(*) AS events, count(DISTINCT user_id) AS unique_users FROM act
WHERE ts >= TIMESTAMP '{RANGE_LO}' AND ts < TIMESTAMP '{RANGE_HI}'"""))
def u03_range_activity_layouts(spark, d):
    return _over_layouts(spark, d, lambda df, c, g: act.range_activity(df, RANGE_LO, RANGE_HI, date_col=c, grain=g))


@register("s18_layout_report", f"""WITH {ACT}
SELECT 'events_daily_userid' AS table_name, count(*) AS total_rows, count(DISTINCT CAST(ts AS DATE)) AS partition_count FROM act
UNION ALL SELECT 'events_daily_ts', count(*), count(DISTINCT CAST(ts AS DATE)) FROM act
UNION ALL SELECT 'events_monthly_userid', count(*), count(DISTINCT date_trunc('month', ts)) FROM act
UNION ALL SELECT 'events_monthly_ts', count(*), count(DISTINCT date_trunc('month', ts)) FROM act
""")
def s18_layout_report(spark, d):
    """Byte sizes depend on the writer, so the comparable columns are rows and partitions."""
    rep = lay.layout_report(spark, four_layouts(spark, d))
    return rep.select("table_name", "total_rows", "partition_count")


@register("s18_layout_sizes", "WITH t(table_name) AS (VALUES " + ", ".join(f"('{n}')" for n in lay.LAYOUTS) + """)
SELECT table_name, true AS parts_add_up, true AS per_row_matches, true AS readable FROM t
""")
def s18_layout_sizes(spark, d):
    """Bytes depend on the writer, so they are checked by what must hold: the partitions' bytes add
    up to the table's, bytes per row times rows too, and the readable size has a number and a unit."""
    paths = four_layouts(spark, d)
    parts = None
    for name, (grain, _) in lay.LAYOUTS.items():
        one = lay.partition_report(spark, paths[name], lay.GRAIN_COLUMN[grain]).agg(
            F.sum("bytes").alias("part_bytes"), F.sum("rows").alias("part_rows")).select(F.lit(name).alias("table_name"), "*")
        parts = one if parts is None else parts.unionByName(one)
    rep = lay.layout_report(spark, paths).join(parts, "table_name")
    return rep.select(
        "table_name",
        ((F.col("part_bytes") == F.col("total_bytes")) & (F.col("part_rows") == F.col("total_rows"))).alias("parts_add_up"),
        (F.abs(F.col("avg_bytes_per_row") * F.col("total_rows") - F.col("total_bytes")) < 1).alias("per_row_matches"),
        F.col("total_size").rlike("^[0-9.]+ ?[A-Za-z]+$").alias("readable"))


@register("s18_partition_rows", f"""WITH {ACT}
SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows FROM act GROUP BY 1
""")
def s18_partition_rows(spark, d):
    rep = lay.partition_report(spark, four_layouts(spark, d)["events_daily_userid"], "event_date")
    return rep.select("event_date", "rows")


RETAIN_AS_OF = "2024-01-25 00:00:00"


@register("s16_retain", f"""WITH {ACT}
SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows FROM act
WHERE ts > TIMESTAMP '{RETAIN_AS_OF}' - INTERVAL 10 DAY GROUP BY 1
""")
def s16_retain(spark, d):
    daily = spark.read.parquet(four_layouts(spark, d)["events_daily_userid"])
    kept = lay.retain(daily, RETAIN_AS_OF, keep="INTERVAL 10 DAYS", date_col="event_date")
    return kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@register("s07_append_batches", f"""WITH {ACT}
SELECT event_type, count(*) AS rows FROM act GROUP BY 1
""")
def s07_append_batches(spark, d):
    """Two inserts (page events, then the rest) into one day-partitioned table, read back."""
    ev = src.activity_events(spark, d)
    path = scratch_path(spark, "append")
    first = F.col("event_type").isin("click", "view")
    lay.append(ev.filter(first), path, "day")
    lay.append(ev.filter(~first), path, "day")
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


REPLACE_DAY = "2024-01-15"


@register("s09_replace_partition", f"""WITH {ACT}
SELECT CAST(ts AS DATE) AS event_date, count(*) AS rows FROM act
WHERE CAST(ts AS DATE) <> DATE '{REPLACE_DAY}' OR event_type = 'purchase' GROUP BY 1
""")
def s09_replace_partition(spark, d):
    """Reload one day with only its purchases (dynamic partition overwrite); other days stay."""
    ev = src.activity_events(spark, d)
    path = scratch_path(spark, "replace")
    lay.write_layout(ev, path, "day")
    day = ev.filter((F.col("event_date") == F.lit(REPLACE_DAY).cast("date")) & (F.col("event_type") == "purchase"))
    lay.replace(day, path, "event_date")
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("rows"))


@register("s19_export_csv", f"""WITH {ACT}
SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS unique_users,
       {R("100.0::DOUBLE * count(*) / (SELECT count(*) FROM act)", 2)} AS pct_of_total
FROM act GROUP BY event_type
""")
def s19_export_csv(spark, d):
    """The event-mix report written as CSV and read back with its schema."""
    report = act.event_mix(src.activity_events(spark, d))
    path = lay.export_csv(report, scratch_path(spark, "csv"))
    schema = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("events", T.LongType()),
                           T.StructField("unique_users", T.LongType()), T.StructField("pct_of_total", T.DoubleType())])
    return spark.read.schema(schema).option("header", True).csv(path)


@register("s01_read_orders", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 40 <> 9 THEN o_custkey END AS client_id, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date,
       CASE WHEN o_orderkey % 40 = 4 THEN 'new' WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'P' THEN 'paid' ELSE 'new' END AS status,
       CASE WHEN o_orderkey % 40 <> 6 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS total_amount
FROM orders WHERE o_orderkey % 40 NOT IN (1, 2, 3, 5, 7, 8, 10)
""")
def s01_read_orders(spark, d):
    """Orders sent as text, read by their contract: the rows that keep it."""
    return _read_orders(spark, d).rows.withColumn("total_amount", F.col("total_amount").cast("double"))


@register("s01_order_rejects", """
WITH f(k, fault) AS (VALUES (1, 'id: missing'), (8, 'id: not a bigint'), (2, 'client_id: not a bigint'), (3, 'status: not allowed'),
                            (5, 'total_amount: not allowed'), (10, 'total_amount: not allowed'), (10, 'order_date: not a timestamp_ntz'),
                            (7, 'line: malformed'))
SELECT fault, count(*) AS orders, max(n) AS most_faults FROM f JOIN orders ON o_orderkey % 40 = k
JOIN (SELECT k AS kk, count(*) AS n FROM f GROUP BY k) ON kk = k GROUP BY fault
""")
def s01_order_rejects(spark, d):
    """The others, by what is wrong with them."""
    rejects = _read_orders(spark, d).rejects
    return rejects.withColumn("n", F.size("faults").cast("long")).select(F.explode("faults").alias("fault"), "n").groupBy("fault").agg(
        F.count(F.lit(1)).alias("orders"), F.max("n").alias("most_faults"))


def _read_orders(spark, d):
    path = scratch_path(spark, "order-lines")
    src.order_lines(spark, d).write.text(path)
    return contracts.read_text(spark, path, "orders")
