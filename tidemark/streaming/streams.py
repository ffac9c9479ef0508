"""Structured Streaming forms of the event-shaped jobs (Z01, Z02, Z04, Z06); those that wait for the
order of their rows (Z03, Z05, Z07) are in ``jobs`` and ``microbatch``.

Sources are Parquet folders read with ``readStream`` (one file per trigger when asked), sinks
are Parquet folders with a checkpoint under the shared checkpoint folder, so a restarted query
resumes exactly where it stopped.  Watermarks need TIMESTAMP (an instant): the NTZ wall clock is
read as a UTC instant on the way in and turned back into the same wall clock on the way out, so
no session time zone (and no daylight-saving gap) changes a value or a window boundary.

Update-mode aggregates (running totals) cannot append to files; they go through
``foreachBatch``, which appends every batch's changed rows tagged with the batch id; the
current value of a key is its row from the highest batch (``current_totals``).  A batch retried
after a failure writes the same rows under the same id, so the answer does not change.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import wall_clock, wall_instant
from tidemark.operators.activity import daily_rollup, merge_rollups
from tidemark.operators.inventory import append_events
from tidemark.session import list_folders, range_partitions, remove_folder, scratch_path
from tidemark.streaming.microbatch import struct

MERGE_EVERY = 16   # batches of a rollup between merges
INGEST_FILES = 8   # files of a folder and batch of ingested events, at most
ROLLUP = struct(day=T.DateType(), country=T.StringType(), device_type=T.StringType(), event_count=T.LongType(),
                total_duration=T.LongType(), total_value=T.DecimalType(28, 2), users_sketch=T.BinaryType())


def write_source(df: DataFrame, path: str, ts_col: str, files: int | None = None) -> str:
    """Add ``df`` to a stream source: Parquet files, each a contiguous range of event time; their
    number follows the bytes of ``df`` (``range_partitions``) unless it is given."""
    n = range_partitions(df, files)
    df.repartitionByRange(n, ts_col).sortWithinPartitions(ts_col).write.mode("append").option("compression", "zstd").parquet(path)
    return path


def closing_row(df: DataFrame, ts_col: str, after: str) -> DataFrame:
    """The end marker of a finished log: its latest row, moved ``after`` (an interval) later.  It
    lifts the watermark past everything that is still open and stays open itself, so it never comes
    out.  An empty log has none."""
    last = df.agg(F.max_by(F.struct(*df.columns), F.col(ts_col)).alias("_r")).filter("_r IS NOT NULL").select("_r.*")
    return last.withColumn(ts_col, (F.col(ts_col) + F.expr(f"INTERVAL {after}")).cast(df.schema[ts_col].dataType))


def read_source(spark: SparkSession, path: str, schema, files_per_trigger: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(path)


def _with_event_time(df: DataFrame, ts_col: str, delay: str) -> DataFrame:
    """Event time for watermarks: the NTZ wall clock read as UTC (``wall_instant``), so day
    windows follow wall-clock days whatever the session time zone."""
    return df.withColumn(ts_col, wall_instant(ts_col)).withWatermark(ts_col, delay)


def run_to_files(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> str:
    """Run a streaming DataFrame over everything available now, into a Parquet sink."""
    q: StreamingQuery = (stream.writeStream.format("parquet").outputMode(mode)
                         .option("checkpointLocation", checkpoint)
                         .trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return sink


def run_upserts(stream: DataFrame, table: str, checkpoint: str) -> str:
    """Run an update-mode aggregate; each batch's changed rows are appended with its batch id."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("append").parquet(table)

    q = (stream.writeStream.outputMode("update").foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return table


def current_totals(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Latest value per key of an upsert table (the row of the highest batch id)."""
    t = spark.read.parquet(table)
    cols = [c for c in t.columns if c not in keys and c != "_batch"]
    last = t.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("_batch")).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, name)
    return os.path.join(base, "sink"), os.path.join(base, "checkpoint")


# ------------------------------------------------------------------------------- jobs

def ingest_events(stream: DataFrame, key: str = "event_id", ts_col: str = "timestamp",
                  delay: str = "1 hour") -> DataFrame:
    """Idempotent ingest.  A repeated id within the watermark delay is dropped; state for an
    id is released once the watermark passes its event time plus the delay."""
    return _with_event_time(stream, ts_col, delay).dropDuplicatesWithinWatermark([key]) \
        .withColumn(ts_col, wall_clock(ts_col))


def stream_reserved(stream: DataFrame) -> DataFrame:
    """The running reservation counter per (warehouse, product): reserves add, cancels and
    confirms take.  It trusts its log, as the reference's counter does; the totals that refuse
    unknown units and drop expired carts are I10 (batch) and Z03 (stream)."""
    delta = F.when(F.col("action") == "reserve", F.col("quantity")) \
        .when(F.col("action").isin("cancel", "confirm"), -F.col("quantity")).otherwise(F.lit(0))
    return stream.groupBy("warehouse_id", "product_id").agg(F.sum(delta.cast("long")).alias("reserved"))


def stream_worker_counts(stream: DataFrame, action: str = "started") -> DataFrame:
    """Jobs per worker from the job log, updated as the log grows."""
    return stream.filter(F.col("action") == action).groupBy("worker_id").agg(F.count(F.lit(1)).alias("tasks"))


def run_append(spark: SparkSession, stream: DataFrame, name: str, *arrivals) -> DataFrame:
    """Run the stream over its source; then, after each of ``arrivals`` (functions that add files to
    the source), resume it from its checkpoint."""
    sink, ckpt = _paths(spark, name)
    run_to_files(stream, sink, ckpt)
    for arrive in arrivals:
        arrive()
        run_to_files(stream, sink, ckpt)
    return spark.read.parquet(sink)


def _each_batch(stream: DataFrame, write_batch, checkpoint: str, arrivals) -> None:
    for arrive in (lambda: None, *arrivals):
        arrive()
        (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())


def run_ingest(spark: SparkSession, stream: DataFrame, name: str, *arrivals, order_col: str = "delivery",
               ts_col: str = "timestamp", folder: str = "day") -> DataFrame:
    """Z01 without a time limit: every batch appends the first delivery of the ids that no earlier
    batch holds (an anti join), however late they are.

    An event is immutable, so its copies carry its time: the table is in folders by time of the event (one
    a day, or whatever ``folder`` holds enough rows), and a batch reads the ids of its own folders only, not
    the whole table.  A batch owns the folders of its number and rewrites them, so a retried batch
    changes nothing.
    """
    table, ckpt = _paths(spark, name)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.withColumn("_from", F.to_date(F.date_trunc(folder, ts_col)))
        base = stored_ids(own.sparkSession, table, [r["_from"] for r in own.select("_from").distinct().collect()], batch_id)
        (append_events(base, own, order_col).withColumn("_batch", F.lit(batch_id).cast("long"))
         .repartition("_from", F.pmod(F.xxhash64("event_id"), F.lit(INGEST_FILES)))
         .write.partitionBy("_from", "_batch").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").mode("overwrite").parquet(table))

    _each_batch(stream, write_batch, ckpt, arrivals)
    return spark.read.schema(stream.schema).parquet(table).drop("_from", "_batch")


def stored_ids(spark: SparkSession, table: str, starts: list, below: int) -> DataFrame | None:
    """The event ids of the folders that begin at these dates, stored by batches before ``below``."""
    there = set(list_folders(spark, table))
    folders = [f"_from={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in starts]
    folders = [os.path.join(table, f) for f in folders if f in there]
    if not folders:
        return None
    rows = spark.read.schema("event_id string, _batch long").option("basePath", table).parquet(*folders)
    return rows.filter(F.col("_batch") < below).select("event_id")


def run_rollup(spark: SparkSession, stream: DataFrame, name: str, *arrivals, user_col: str = "user_id") -> DataFrame:
    """The daily rollup (A15, with user sketches), kept up to date batch by batch.

    A batch adds the rollup of its own rows; a late row adds to its day like any other, nothing is
    dropped and nothing waits.  Rows of one (day, country, device) merge: the counts add, the sketches
    unite, here and with any other rollup of other rows (``merge_rollups``).  Every ``MERGE_EVERY`` batches what
    there is becomes one copy, and what went into it is removed when the next batch begins.
    """
    table, ckpt = _paths(spark, name)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        whole = [int(f.split("=")[1]) for f in list_folders(own, os.path.join(table, "whole"))]
        done = max((w for w in whole if w < batch_id), default=-1)
        for kind, keep in (("parts", done + 1), ("whole", done)):
            for f in list_folders(own, os.path.join(table, kind)):
                if int(f.split("=")[1]) < keep:
                    remove_folder(own, os.path.join(table, kind, f))
        daily_rollup(batch, sketch=True, user_col=user_col).write.mode("overwrite").parquet(os.path.join(table, "parts", f"_batch={batch_id}"))
        if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
            stored_rollup(own, table, batch_id + 1).select([F.col(f.name).cast(f.dataType) for f in ROLLUP]).write.mode("overwrite").parquet(os.path.join(table, "whole", f"_batch={batch_id}"))

    _each_batch(stream, write_batch, ckpt, arrivals)
    return stored_rollup(spark, table, 1 << 62)


def stored_rollup(spark: SparkSession, table: str, below: int) -> DataFrame:
    """The rollup that the batches before ``below`` add up to."""
    def numbers(kind: str) -> list[int]:
        return sorted(n for n in (int(f.split("=")[1]) for f in list_folders(spark, os.path.join(table, kind))) if n < below)

    whole = numbers("whole")[-1:]
    parts = [n for n in numbers("parts") if not whole or n > whole[0]]
    paths = [os.path.join(table, k, f"_batch={n}") for k, own in (("whole", whole), ("parts", parts)) for n in own]
    return merge_rollups(spark.read.schema(ROLLUP).parquet(*paths) if paths else spark.createDataFrame([], ROLLUP))


def run_update(spark: SparkSession, stream: DataFrame, name: str, keys: list[str], *arrivals) -> DataFrame:
    sink, ckpt = _paths(spark, name)
    for arrive in (lambda: None, *arrivals):
        arrive()
        run_upserts(stream, sink, ckpt)
    return current_totals(spark, sink, keys)
