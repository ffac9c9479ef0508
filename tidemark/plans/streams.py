"""Registered streaming queries.

Each writes its input (derived from the driver's tables) as a file source under the shared
checkpoint folder, in time order and in several arrivals, runs the stream with ``availableNow`` after each of them
into a sink with its own checkpoint, and returns the sink read back.  Sessions, carts and requests
still open at the end of the log are closed by an end marker that arrives last, so the results
are those of the whole log.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidemark.operators import activity as act
from tidemark.operators import workqueue as wq
from tidemark.plans.activity import ACT, ACT_COUNTRY
from tidemark.plans.queue import JOBS, NOW, RANKED
from tidemark.plans.registry import register
from tidemark.plans.stock import CANCELS, CART, EVENTS, FOLD_ALL, REQ
from tidemark.session import saved, scratch_path
from tidemark.sources import driver as src
from tidemark.streaming import jobs
from tidemark.streaming import streams as st
from tidemark.streaming.microbatch import run_event_time


ARRIVALS = 3


def _source(spark, df, name, ts_col, after=None):
    """The stream of a source in the shared folder, and the functions that let the rest of it arrive.

    ``df`` arrives in ``ARRIVALS`` parts by time, each in one trigger (files written by one job carry no usable
    order among themselves).  With ``after``, an end marker that much later arrives last.
    """
    path = os.path.join(scratch_path(spark, name), "source")
    at = F.unix_micros(F.col(ts_col).cast("timestamp")) if df.schema[ts_col].dataType.typeName().startswith("timestamp") else F.col(ts_col)
    shares = [i / ARRIVALS for i in range(1, ARRIVALS)]
    cuts = df.agg(F.percentile_approx(at, shares, 1000).alias("c")).first()["c"] or []
    if len(cuts) < ARRIVALS - 1 or len(set(cuts)) < len(cuts):
        parts = [df]
    else:
        bounds = [None, *cuts, None]
        parts = [df.filter((F.lit(True) if lo is None else at > lo) & (F.lit(True) if hi is None else at <= hi))
                 for lo, hi in zip(bounds[:-1], bounds[1:])]
        parts[-1] = df.filter(at.isNull() | (at > cuts[-1]))
    st.write_source(parts[0], path, ts_col)
    later = [lambda p=p: st.write_source(p, path, ts_col) for p in parts[1:]]
    if after is not None:
        later.append(lambda: st.write_source(st.closing_row(df, ts_col, after), path, ts_col, 1))
    return st.read_source(spark, path, df.schema, files_per_trigger=None), later


@register("z01_ingest_events", f"""WITH {EVENTS}
SELECT event_id, event_type, product_id, warehouse_id, quantity, timestamp FROM uniq
""")
def z01_ingest_events(spark, d):
    ev = src.inventory_events(spark, d).drop("metadata", "delivery")
    stream, later = _source(spark, ev, "z01", "timestamp")
    out = st.run_append(spark, st.ingest_events(stream), "z01", *later)
    return out.select("event_id", "event_type", "product_id", "warehouse_id", "quantity", "timestamp")


@register("z01_ingest_keyed", f"""WITH {EVENTS}
SELECT event_id, event_type, product_id, warehouse_id, quantity, timestamp FROM uniq
""")
def z01_ingest_keyed(spark, d):
    """First deliveries, then the redeliveries as a later arrival: no id is taken twice."""
    ev = src.inventory_events(spark, d).drop("metadata")
    path = os.path.join(scratch_path(spark, "z01k"), "source")
    st.write_source(ev.filter("delivery = 0"), path, "timestamp")
    stream = st.read_source(spark, path, ev.schema, files_per_trigger=None)
    out = st.run_ingest(spark, stream, "z01k", lambda: st.write_source(ev.filter("delivery > 0"), path, "timestamp"), folder="quarter")
    return out.select("event_id", "event_type", "product_id", "warehouse_id", "quantity", "timestamp")


@register("z02_stream_rollup", f"""WITH {ACT_COUNTRY}
SELECT CAST(ts AS DATE) AS day, country, device_type, count(*) AS event_count,
       CAST(sum(duration) AS BIGINT) AS total_duration,
       CAST(sum(CAST(event_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value, true AS users_within_5pct
FROM actc GROUP BY 1, 2, 3
""")
def z02_stream_rollup(spark, d):
    ev = src.activity_events(spark, d, with_country=True)
    stream, later = _source(spark, ev, "z02", "ts")
    out = act.rollup_estimates(st.run_rollup(spark, stream, "z02", *later))
    exact = act.daily_rollup(ev).select(F.col("day").alias("_d"), F.col("country").alias("_c"),
                                        F.col("device_type").alias("_t"), "unique_users")
    met = out.join(exact, (out["day"] == exact["_d"]) & out["country"].eqNullSafe(exact["_c"])
                   & (out["device_type"] == exact["_t"]), "left")
    near = F.abs(F.col("unique_users_est") - F.col("unique_users")) <= F.greatest(F.lit(1.0), F.col("unique_users") * 0.05)
    return met.select("day", "country", "device_type", "event_count", "total_duration",
                      F.col("total_value").cast("double").alias("total_value"), near.alias("users_within_5pct"))


@register("z04_stream_reserved", f"""WITH {CART}
SELECT warehouse_id, product_id, sum(CASE WHEN action = 'reserve' THEN quantity ELSE -quantity END) AS reserved
FROM log GROUP BY 1, 2
""")
def z04_stream_reserved(spark, d):
    stream, later = _source(spark, src.cart_log(spark, d), "z04", "ts")
    return st.run_update(spark, st.stream_reserved(stream), "z04", ["warehouse_id", "product_id"], *later)


@register("z06_stream_worker_counts", f"""WITH {JOBS}, {RANKED}
SELECT CAST((claim_rank - 1) // 1000 + 1 AS BIGINT) AS worker_id, count(*) AS tasks FROM ranked GROUP BY 1
""")
def z06_stream_worker_counts(spark, d):
    log = wq.claim_log(wq.claim_batch(src.jobs(spark, d), None, 1000), NOW)
    stream, later = _source(spark, log, "z06", "id")
    return st.run_update(spark, st.stream_worker_counts(stream), "z06", ["worker_id"], *later)


@register("z07_stream_sessions", f"""WITH {ACT},
s AS (SELECT user_id, ts,
             CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s
      FROM act WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s),
ses AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
        FROM n GROUP BY user_id, sid)
SELECT * FROM ses
""")
def z07_stream_sessions(spark, d):
    ev = src.activity_events(spark, d).select("user_id", "ts")
    stream, later = _source(spark, ev, "z07", "ts", "3 HOURS")
    return run_event_time(spark, stream, jobs.sessions_job(), "z07", *later).output


@register("z05_stream_settle", f"""WITH RECURSIVE {REQ}, {FOLD_ALL}
SELECT warehouse_id, product_id, order_id, line_no, supplier_id, quantity, ts, accepted, balance_after FROM fold
""")
def z05_stream_settle(spark, d):
    reqs = src.stock_requests(spark, d).select("order_id", "line_no", "product_id", "warehouse_id",
                                                "supplier_id", "quantity", "ts")
    stream, later = _source(spark, reqs, "z05", "ts", "3 DAYS")
    job = jobs.settle_job(src.warehouse_stock(spark, d), reqs.schema, ["ts", "order_id", "line_no", "supplier_id", "quantity"])
    out = run_event_time(spark, stream, job, "z05", *later, delay="1 day", span_seconds=90 * 86_400).output
    return out.select("warehouse_id", "product_id", "order_id", "line_no", "supplier_id", "quantity", "ts", "accepted", "balance_after")


@register("z03_stream_carts", f"""WITH RECURSIVE {CANCELS}
SELECT user_id, cart_no, warehouse_id, product_id, units, expires_at FROM lines
""")
def z03_stream_carts(spark, d):
    log = saved(src.cart_log(spark, d), "z03-log")  # the arrivals read it several times
    stream, later = _source(spark, log, "z03", "ts", f"{src.CART_TTL_SECONDS + 7200} SECONDS")
    return run_event_time(spark, stream, jobs.carts_job(), "z03", *later).output
