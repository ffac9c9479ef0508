"""Availability from a probe log (O01), re-aimed from the reference's failover timing.

An outage is a maximal run of failed probes of one target; its recovery time is the first
successful probe after the run minus the first failed one (the reference measures the time from
killing the primary until the first successful insert).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import seconds_between
from tidemark.plans.chunked import run_numbers


def outages(probes: DataFrame, key: str = "target", order=("ts", "probe_id"), ok_col: str = "ok") -> DataFrame:
    """One row per outage: target, run number, first failure, failed probes, recovery
    time (NULL while still down) and the recovery in seconds."""
    runs = run_numbers(probes, [key], list(order), ok_col)
    per = runs.groupBy(key, "run_no").agg(
        F.first(ok_col).alias("ok"), F.min(order[0]).alias("started"), F.count(F.lit(1)).alias("probes"))
    down = per.filter(~F.col("ok"))
    nxt = per.select(key, (F.col("run_no") - 1).alias("run_no"), F.col("started").alias("recovered_at"))
    j = down.join(nxt, [key, "run_no"], "left")
    return j.select(
        key, "run_no", F.col("started").alias("failed_at"), F.col("probes").alias("failed_probes"), "recovered_at",
        seconds_between("started", "recovered_at").alias("recovery_seconds"))
