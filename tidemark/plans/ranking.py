"""Global ranking without a single-task sort.

To rank rows without sorting them in one task, ``global_rank`` range-partitions by the order, numbers rows inside each sorted partition
(``monotonically_increasing_id`` carries the partition index in its upper bits and the position
in the lower 33), counts rows per partition (one row per partition), turns the counts into
offsets and joins them back by partition.

The range partitioner samples its boundaries with a seed taken from the RDD id, so two
evaluations of the same plan may cut differently.  The numbered rows are therefore checkpointed
(reliably, to ``spark.checkpoint.dir``) once, and both the counts and the rows are read from that
copy.  The order must be total (end it with a unique key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir, range_partitions


def global_rank(df: DataFrame, order, rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row in the total order ``order``."""
    n = range_partitions(df, num_partitions)
    numbered = df.repartitionByRange(n, *order).sortWithinPartitions(*order) \
        .withColumn("_mid", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_pid", F.shiftright("_mid", 33)) \
        .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    ensure_checkpoint_dir(df.sparkSession)
    numbered = numbered.checkpoint(eager=True)
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window below sees at most `n` rows
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = numbered.join(offsets, "_pid")
    return out.withColumn(rank_col, F.col("_off") + F.col("_pos") + 1).drop("_mid", "_pid", "_pos", "_off")


TOP_ROWS = 10_000  # rows that are merged and numbered in one task, at most


def ranked_between(df: DataFrame, order, first: int, last: int | None, rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``first``..``last`` (to the end when ``last`` is None) in ``order``.

    Up to ``TOP_ROWS`` rows from the top are a top-k, numbered where they were merged.  Further down the
    partition counts of the sorted order say which ranks a partition holds (``global_rank``): no task sees
    the rows before the first."""
    if last is not None and last <= TOP_ROWS:
        top = df.orderBy(*order).limit(last)
        ranked = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("long"))
    else:
        ranked = global_rank(df, order, rank_col)
    rank = F.col(rank_col)
    if first > 1:
        ranked = ranked.filter(rank >= first)
    return ranked if last is None else ranked.filter(rank <= last)


def first_k_ranked(df: DataFrame, order, k: int | None, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k in ``order`` (all rows when ``k`` is None)."""
    return ranked_between(df, order, 1, k, rank_col)
