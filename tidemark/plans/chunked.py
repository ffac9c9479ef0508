"""Ordered per-key windows that stay parallel when one key holds a large share of the rows.

Running balances, runs of failed probes and sessions are windows partitioned by a key; Spark puts a whole key
in one task, so a key holding a third of the table becomes one task holding a third of the table.

Keys are split instead: ``repartitionByRange`` on (key, order) cuts the table into sorted partitions of
similar size, a hot key simply spans several; the result is checkpointed to ``spark.checkpoint.dir`` (the
range sampler is seeded per RDD, so the cut must be fixed once).  Windows run over (partition, key), and what
a key's earlier partitions add comes from one summary row per (partition, key), joined back.

Guarded balances, which no window expresses, are in ``tidemark.plans.guarded``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, range_partitions

PID = "_pid"
KEY = "_key"


def _cut(df: DataFrame, keys: list[str], order: list, num_partitions: int | None) -> tuple[DataFrame, list]:
    """``df`` cut by (keys, order) and checkpointed, with its partition number; the sort columns."""
    n = range_partitions(df, num_partitions)
    by = [F.col(k) for k in keys] + _columns(order)
    ensure_checkpoint_dir(df.sparkSession)
    out = df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(PID, F.spark_partition_id())
    return out.checkpoint(eager=True), by


def _columns(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


# --------------------------------------------------- running sums, runs and sessions (JVM only)

def _windowed(df: DataFrame, keys: list[str], order: list, num_partitions: int | None):
    """The cut rows with their key as one struct (null keys equal each other), the window over a
    chunk and the window over a key's chunks before the current one."""
    ranged, _ = _cut(df, keys, order, num_partitions)
    ranged = ranged.withColumn(KEY, F.struct(*keys))
    chunk = Window.partitionBy(PID, KEY).orderBy(*_columns(order))
    return ranged, chunk, Window.partitionBy(KEY).orderBy(PID)


def running_sum(df: DataFrame, keys: list[str], order: list, value_col: str, out_col: str = "running",
                num_partitions: int | None = None) -> DataFrame:
    """Per key, the cumulative sum of ``value_col`` in ``order`` (hot keys split).  Null values
    add nothing; the sum is null before the first value, as in a plain window."""
    ranged, chunk, chunks = _windowed(df, keys, order, num_partitions)
    kind = df.schema[value_col].dataType
    local = ranged.withColumn("_local", F.sum(value_col).over(chunk.rowsBetween(Window.unboundedPreceding, 0)))
    totals = ranged.groupBy(PID, KEY).agg(F.sum(value_col).alias("_total"))
    carry = totals.select(PID, KEY, F.sum("_total").over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    run = F.coalesce(F.col("_local") + F.col("_carry"), "_local", "_carry").cast(kind)
    return local.join(carry, [PID, KEY]).select(*df.columns, run.alias(out_col))


def _numbered(df: DataFrame, keys: list[str], order: list, value_col: str, breaks: Callable[[Column, Column], Column],
              out_col: str, num_partitions: int | None) -> DataFrame:
    """Per key, 1 + the number of rows so far that ``breaks(value before, value)`` tells from
    their predecessor."""
    ranged, chunk, chunks = _windowed(df, keys, order, num_partitions)
    v, at = F.col(value_col), F.row_number().over(chunk)
    rows = ranged.withColumn("_at", at).withColumn(
        "_break", F.when(F.col("_at") > 1, breaks(F.lag(value_col).over(chunk), v)).otherwise(F.lit(False)).cast("long"))
    rows = rows.withColumn("_local", F.sum("_break").over(chunk.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy(PID, KEY).agg(F.min_by(value_col, "_at").alias("_first"), F.max_by(value_col, "_at").alias("_last"),
                                      F.sum("_break").alias("_inside"))
    ends = ends.withColumn("_starts", F.when(F.row_number().over(chunks) == 1, F.lit(True))
                           .otherwise(breaks(F.lag("_last").over(chunks), F.col("_first"))).cast("long"))
    before = F.coalesce(F.sum(F.col("_starts") + F.col("_inside")).over(chunks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = ends.select(PID, KEY, (before + F.col("_starts")).alias("_carry"))
    return rows.join(carry, [PID, KEY]).select(*df.columns, (F.col("_carry") + F.col("_local")).alias(out_col))


def run_numbers(df: DataFrame, keys: list[str], order: list, value_col: str, out_col: str = "run_no",
                num_partitions: int | None = None) -> DataFrame:
    """Per key, number the maximal runs of equal ``value_col`` in ``order`` (1, 2, ...): the
    gaps-and-islands labelling, with hot keys split.  Nulls equal each other."""
    return _numbered(df, keys, order, value_col, lambda a, b: ~a.eqNullSafe(b), out_col, num_partitions)


def gap_sessions(df: DataFrame, keys: list[str], order: list, ts_col: str, gap_us: int,
                 out_col: str = "session_no", num_partitions: int | None = None) -> DataFrame:
    """Per key, number sessions in ``order``: a row more than ``gap_us`` microseconds after the
    previous row starts a new session (a row exactly at the gap stays, as Spark's session
    window).  A null time never starts one.  Hot keys are split like the other scans."""
    def breaks(before, now):
        return F.coalesce(now > F.timestamp_add("MICROSECOND", F.lit(gap_us), before), F.lit(False))

    return _numbered(df, keys, order, ts_col, breaks, out_col, num_partitions)
