"""Work queue (W01-W09), re-aimed from row locks to ranked assignment.

The reference claims jobs one at a time with ``SELECT .. FOR UPDATE SKIP LOCKED LIMIT 1`` in
``priority DESC, created_at ASC`` order.  Run sequentially, the n-th call gets the n-th job of
that order, so a batch of calls is an equi-join of call rank to job rank (J11).  ``id`` ends
the order because seeded jobs share one creation time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import avg_seconds
from tidemark.plans.ranking import first_k_ranked, global_rank


def queue_order():
    """Priority DESC, created_at ASC, id ASC."""
    return [F.col("priority").desc(), F.col("created_at").asc(), F.col("id").asc()]


def next_job(jobs: DataFrame) -> DataFrame:
    """The job the next call would take (0 or 1 row)."""
    return jobs.filter(F.col("status") == "new").orderBy(*queue_order()).limit(1)


def claim(jobs: DataFrame, calls: DataFrame, call_order: str = "call_seq") -> DataFrame:
    """Calls (call_seq, worker_id) claim new jobs in queue order, each job at most once.

    Output: call_seq, worker_id, job_id, job_title, claim_rank.  A call beyond the last new job
    gets nothing (the reference's function returns no row).
    """
    # both sides are ranked without a single-task sort; the inner join keeps one job per call
    ranked_calls = global_rank(calls, [F.col(call_order).asc()], "claim_rank")
    new = jobs.filter(F.col("status") == "new").select("id", "title", "priority", "created_at")
    ranked_jobs = global_rank(new, queue_order(), "claim_rank")
    j = ranked_calls.join(ranked_jobs, "claim_rank")
    return j.select(call_order, "worker_id", F.col("id").alias("job_id"), F.col("title").alias("job_title"),
                    "claim_rank")


def claim_batch(jobs: DataFrame, workers: int | None, per_worker: int) -> DataFrame:
    """Worker 1 takes ``per_worker`` jobs, then worker 2, ...: rank r goes to worker
    ceil(r / per_worker).  ``workers=None`` keeps going until every new job is claimed.

    Output: job_id, title, worker_id, claim_rank.
    """
    k = None if workers is None else workers * per_worker
    new = jobs.filter(F.col("status") == "new").select("id", "title", "priority", "created_at")
    ranked = first_k_ranked(new, queue_order(), k, "claim_rank")
    return ranked.select(
        F.col("id").alias("job_id"), "title",
        (F.floor((F.col("claim_rank") - 1) / F.lit(per_worker)) + 1).cast("long").alias("worker_id"),
        "claim_rank")


def apply_claims(jobs: DataFrame, claims: DataFrame, now, finish: bool = True) -> DataFrame:
    """Claimed jobs become 'processing' (or 'completed' when ``finish``), with the worker
    and the times; other jobs are unchanged.  A new table version, never an in-place update."""
    c = claims.select(F.col("job_id").alias("id"), F.col("worker_id").alias("_w"))
    j = jobs.join(c, "id", "left")
    hit = F.col("_w").isNotNull()
    now_ts = F.lit(now).cast("timestamp_ntz")
    return j.select(
        *[c_ for c_ in jobs.columns if c_ not in ("status", "worker_id", "started_at", "completed_at")],
        F.when(hit, F.lit("completed" if finish else "processing")).otherwise(F.col("status")).alias("status"),
        F.when(hit, F.col("_w")).otherwise(F.col("worker_id")).alias("worker_id"),
        F.when(hit, now_ts).otherwise(F.col("started_at")).alias("started_at"),
        (F.when(hit, now_ts).otherwise(F.col("completed_at")) if finish else F.col("completed_at")).alias("completed_at"),
    )


def claim_log(claims: DataFrame, now, finish: bool = True) -> DataFrame:
    """One 'started' (and one 'completed') log row per claim; ids follow the claim rank."""
    actions = F.array(F.lit("started"), F.lit("completed")) if finish else F.array(F.lit("started"))
    per = 2 if finish else 1
    x = claims.select("job_id", "worker_id", "claim_rank", F.posexplode(actions).alias("_i", "action"))
    return x.select(
        ((F.col("claim_rank") - 1) * per + F.col("_i") + 1).cast("long").alias("id"),
        "job_id", "worker_id", "action",
        F.lit(now).cast("timestamp_ntz").alias("action_time"),
    )


def worker_distribution(log: DataFrame, action: str = "started") -> DataFrame:
    """Per worker: jobs taken and the job ids in log order (array_agg .. ORDER BY id).

    The list per worker holds that worker's claims, bounded by the per-worker batch size.
    """
    s = log.filter(F.col("action") == action)
    return s.groupBy("worker_id").agg(
        F.count(F.lit(1)).alias("tasks_processed"),
        F.transform(F.sort_array(F.collect_list(F.struct("id", "job_id"))), lambda e: e["job_id"]).alias("job_ids"),
    )


def duplicates(df: DataFrame, keys, min_count: int = 2, count_col: str = "n") -> DataFrame:
    """Key groups seen at least ``min_count`` times (HAVING count(*) > 1)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) >= min_count)


def double_claims(log: DataFrame) -> DataFrame:
    """Jobs started more than once (expected empty)."""
    return duplicates(log.filter(F.col("action") == "started"), "job_id", 2, "process_count")


def status_stats(jobs: DataFrame) -> DataFrame:
    """Per status: count and mean processing seconds (0 when no job has both times)."""
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("count"),
                                      avg_seconds("started_at", "completed_at").alias("avg_processing_time_sec"))


def new_jobs(jobs: DataFrame) -> DataFrame:
    """Number of jobs waiting."""
    return jobs.filter(F.col("status") == "new").agg(F.count(F.lit(1)).alias("new_jobs"))


def queue_summary(jobs: DataFrame, log: DataFrame) -> DataFrame:
    """Summary metric rows, values as text (UNION ALL of labelled counts)."""
    parts = [
        jobs.agg(F.count(F.lit(1)).alias("v")).select(F.lit("jobs_total").alias("metric"), "v"),
        jobs.filter(F.col("status") == "completed").agg(F.count(F.lit(1)).alias("v"))
        .select(F.lit("jobs_completed").alias("metric"), "v"),
        log.agg(F.count(F.lit(1)).alias("v")).select(F.lit("log_rows").alias("metric"), "v"),
        log.agg(F.count_distinct("worker_id").alias("v")).select(F.lit("distinct_workers").alias("metric"), "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("metric", F.col("v").cast("string").alias("value"))
