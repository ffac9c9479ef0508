"""Registered work-queue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import workqueue as wq
from tidemark.plans.registry import register
from tidemark.sources import driver as src

NOW = "2024-06-01 12:00:00"
WORKERS, PER_WORKER = 2, 50          # the reference's batch run
ALL_PER_WORKER = 1000                # every new job, 1000 per worker

JOBS = """
jobs AS (
  SELECT o_orderkey AS id, 'Task ' || CAST(o_orderkey AS VARCHAR) AS title,
         CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'processing' ELSE 'completed' END AS status,
         5 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
         CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS worker_id,
         o_orderdate AS created_at,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate END AS started_at,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) END AS completed_at
  FROM orders)
"""

RANKED = """
ranked AS (SELECT id, title, row_number() OVER (ORDER BY priority DESC, created_at, id) AS claim_rank
           FROM jobs WHERE status = 'new')
"""

CLAIMS = f"""{JOBS}, {RANKED},
claims AS (SELECT id AS job_id, title, CAST((claim_rank - 1) // {PER_WORKER} + 1 AS BIGINT) AS worker_id, claim_rank
           FROM ranked WHERE claim_rank <= {WORKERS * PER_WORKER})
"""

APPLIED = f"""{CLAIMS},
applied AS (
  SELECT j.id, j.title, j.priority, j.created_at,
         CASE WHEN c.job_id IS NOT NULL THEN 'completed' ELSE j.status END AS status,
         CASE WHEN c.job_id IS NOT NULL THEN c.worker_id ELSE j.worker_id END AS worker_id,
         CASE WHEN c.job_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE j.started_at END AS started_at,
         CASE WHEN c.job_id IS NOT NULL THEN TIMESTAMP '{NOW}' ELSE j.completed_at END AS completed_at
  FROM jobs j LEFT JOIN claims c ON c.job_id = j.id),
log AS (
  SELECT (claim_rank - 1) * 2 + 1 AS id, job_id, worker_id, 'started' AS action, TIMESTAMP '{NOW}' AS action_time FROM claims
  UNION ALL
  SELECT (claim_rank - 1) * 2 + 2, job_id, worker_id, 'completed', TIMESTAMP '{NOW}' FROM claims)
"""


def _claims(spark, d):
    return wq.claim_batch(src.jobs(spark, d), WORKERS, PER_WORKER)


def _applied(spark, d):
    return wq.apply_claims(src.jobs(spark, d), _claims(spark, d), NOW)


def _log(spark, d):
    return wq.claim_log(_claims(spark, d), NOW)


@register("w01_claim_calls", f"""WITH {JOBS}, {RANKED},
calls AS (SELECT o_orderkey AS call_seq, o_custkey AS worker_id,
                 row_number() OVER (ORDER BY o_orderkey) AS claim_rank FROM orders WHERE o_orderstatus = 'P')
SELECT c.call_seq, c.worker_id, r.id AS job_id, r.title AS job_title, c.claim_rank
FROM calls c JOIN ranked r ON r.claim_rank = c.claim_rank
""")
def w01_claim_calls(spark, d):
    """Every pending order is a worker call (its customer is the worker), in order-key order."""
    o = src.load(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
    calls = o.select(F.col("o_orderkey").alias("call_seq"), F.col("o_custkey").alias("worker_id"))
    return wq.claim(src.jobs(spark, d), calls)


@register("w02_claim_batch", f"""WITH {CLAIMS}
SELECT job_id, title, worker_id, claim_rank FROM claims
""")
def w02_claim_batch(spark, d):
    return _claims(spark, d)


@register("w02_claim_all", f"""WITH {JOBS}, {RANKED}
SELECT id AS job_id, title, CAST((claim_rank - 1) // {ALL_PER_WORKER} + 1 AS BIGINT) AS worker_id, claim_rank
FROM ranked
""")
def w02_claim_all(spark, d):
    return wq.claim_batch(src.jobs(spark, d), None, ALL_PER_WORKER)


@register("w03_apply_claims", f"""WITH {APPLIED}
SELECT id, title, priority, created_at, status, worker_id, started_at, completed_at FROM applied
""")
def w03_apply_claims(spark, d):
    return _applied(spark, d).select("id", "title", "priority", "created_at", "status", "worker_id",
                                     "started_at", "completed_at")


@register("w04_claim_log", f"""WITH {APPLIED}
SELECT id, job_id, worker_id, action, action_time FROM log
""")
def w04_claim_log(spark, d):
    return _log(spark, d)


@register("w05_worker_distribution", f"""WITH {APPLIED}
SELECT worker_id, count(*) AS tasks_processed,
       string_agg(CAST(job_id AS VARCHAR), ',' ORDER BY id) AS job_ids
FROM log WHERE action = 'started' GROUP BY worker_id
""")
def w05_worker_distribution(spark, d):
    dist = wq.worker_distribution(_log(spark, d))
    return dist.select("worker_id", "tasks_processed",
                       F.array_join(F.transform("job_ids", lambda x: x.cast("string")), ",").alias("job_ids"))


@register("w06_double_claims", f"""WITH {APPLIED}
SELECT job_id, count(*) AS process_count FROM log WHERE action = 'started'
GROUP BY job_id HAVING count(*) > 1
""")
def w06_double_claims(spark, d):
    return wq.double_claims(_log(spark, d))


@register("w07_status_stats", f"""WITH {APPLIED}
SELECT status, count(*) AS count,
       COALESCE(avg(epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0::DOUBLE, 0.0) AS avg_processing_time_sec
FROM applied GROUP BY status
""")
def w07_status_stats(spark, d):
    return wq.status_stats(_applied(spark, d))


@register("w08_queue_summary", f"""WITH {APPLIED}
SELECT 'jobs_total' AS metric, CAST(count(*) AS VARCHAR) AS value FROM applied
UNION ALL SELECT 'jobs_completed', CAST(count(*) AS VARCHAR) FROM applied WHERE status = 'completed'
UNION ALL SELECT 'log_rows', CAST(count(*) AS VARCHAR) FROM log
UNION ALL SELECT 'distinct_workers', CAST(count(DISTINCT worker_id) AS VARCHAR) FROM log
""")
def w08_queue_summary(spark, d):
    return wq.queue_summary(_applied(spark, d), _log(spark, d))


@register("w09_new_jobs", f"""WITH {JOBS}
SELECT count(*) AS new_jobs FROM jobs WHERE status = 'new'
""")
def w09_new_jobs(spark, d):
    return wq.new_jobs(src.jobs(spark, d))


@register("t03_next_job", f"""WITH {JOBS}
SELECT id, title, priority, created_at FROM jobs WHERE status = 'new'
ORDER BY priority DESC, created_at, id LIMIT 1
""")
def t03_next_job(spark, d):
    return wq.next_job(src.jobs(spark, d)).select("id", "title", "priority", "created_at")


@register("a07_customers_with_many_open_orders", """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(*) >= 8
""")
def a07_many_open_orders(spark, d):
    o = src.load(spark, d, "orders").filter(F.col("o_orderstatus") == "O")
    return wq.duplicates(o, "o_custkey", 8, "n")
