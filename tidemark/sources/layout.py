"""Table layouts and writes: append (S07), partitioned + sorted layouts (S08), replace (S09),
retention (S16), layout and partition reports (S18), text export (S19).

A layout is Parquet partitioned by a date grain (``day`` or ``month``) and sorted inside each
file by a sort key, so partition pruning skips whole folders and row-group min/max statistics
skip row groups inside the files.  Writing goes through ``repartitionByRange`` on
(partition column, sort key): a day holding a third of all rows is cut into several tasks and
files instead of landing in one task, and every file comes out sorted.  A task sorts all its rows, which take
many times their bytes in a file, so a layout is cut finer than other range cuts, lest tasks spill.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import readable_size
from tidemark.session import input_bytes, range_partitions

GRAIN_COLUMN = {"day": "event_date", "month": "event_month"}


SORT_BYTES = 8 * 1024 * 1024  # on-disk bytes that a task sorts


def with_partition_column(df: DataFrame, grain: str, ts_col: str = "ts") -> DataFrame:
    """The derived (materialised) partition column: the event date, or the first day of its month."""
    if grain == "day":
        return df.withColumn("event_date", F.to_date(ts_col))
    if grain == "month":
        return df.withColumn("event_month", F.trunc(F.to_date(ts_col), "month"))
    raise ValueError(grain)


def write_layout(df: DataFrame, path: str, grain: str = "day", sort_cols=("user_id", "ts"),
                 ts_col: str = "ts", mode: str = "overwrite", num_partitions: int | None = None,
                 max_records_per_file: int = 5_000_000) -> str:
    """Write ``df`` partitioned by ``grain`` and sorted by ``sort_cols`` inside each file.  The
    number of tasks follows the bytes of ``df`` (``range_partitions``, and ``SORT_BYTES`` at most each) unless
    it is given."""
    part = GRAIN_COLUMN[grain]
    out = with_partition_column(df, grain, ts_col) if part not in df.columns else df
    n = num_partitions or max(range_partitions(out), -(-input_bytes(out) // SORT_BYTES))
    keys = [part, *sort_cols]
    out = out.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    (out.write.mode(mode).partitionBy(part)
     .option("maxRecordsPerFile", max_records_per_file)
     .option("compression", "zstd")
     .parquet(path))
    return path


def append(df: DataFrame, path: str, grain: str | None = None, sort_cols=("user_id", "ts")) -> str:
    """``INSERT .. SELECT``: add rows to a table (in its layout when ``grain`` is given)."""
    if grain is None:
        df.write.mode("append").parquet(path)
        return path
    return write_layout(df, path, grain, sort_cols, mode="append")


def replace(df: DataFrame, path: str, partition_col: str | None = None) -> str:
    """Truncate and reload.  With ``partition_col`` only the partitions present in ``df``
    are replaced (dynamic partition overwrite); others stay."""
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_col)
    w.parquet(path)
    return path


def retain(df: DataFrame, as_of, ts_col: str = "ts", keep: str = "INTERVAL 1 YEAR",
           date_col: str | None = None) -> DataFrame:
    """Rows with ``ts + keep > as_of`` (the reference's TTL).  With a date partition column
    the same bound is also put on it, so whole expired partitions are never read."""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(keep)
    out = df.filter(F.col(ts_col) > limit)
    if date_col:
        out = out.filter(F.col(date_col) >= F.to_date(limit))
    return out


_FOOTERS: dict[str, SparkSession] = {}


def _counting(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet counts come from the file footers (Spark's
    aggregate push-down): tasks open the files, no row is read."""
    app = spark.sparkContext.applicationId
    if app not in _FOOTERS:
        own = spark.newSession()
        sources = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
        own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in sources if x != "parquet"))
        own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        _FOOTERS[app] = own
    return _FOOTERS[app]


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of a table's data files; their contents are not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", F.col("length").alias("bytes"))


def _folder(part_col: str) -> Column:
    """The partition value in a file's path, as text; null for the default partition."""
    text = F.regexp_extract("path", f"/{part_col}=([^/]+)/", 1)
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))))


def layout_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per table: rows, bytes on disk, bytes per row, partitions, readable size.

    Rows come from the Parquet footers, bytes from the file listing: no row is read.
    """
    own = _counting(spark)
    out = None
    for name, path in paths.items():
        df = own.read.parquet(path)
        part_cols = [c for c in df.columns if c in GRAIN_COLUMN.values()]
        parts = F.count_distinct(F.coalesce(_folder(part_cols[0]), F.lit(""))) if part_cols else F.lit(1).cast("long")
        sizes = _files(own, path).agg(F.sum("bytes").alias("total_bytes"), parts.alias("partition_count"))
        one = df.agg(F.count(F.lit(1)).alias("total_rows")).join(sizes, how="cross") \
            .select(F.lit(name).alias("table_name"), "total_rows", "total_bytes",
                    (F.col("total_bytes") / F.col("total_rows")).alias("avg_bytes_per_row"),
                    "partition_count", readable_size("total_bytes").alias("total_size"))
        out = one if out is None else out.unionByName(one)
    return out


def partition_report(spark: SparkSession, path: str, part_col: str = "event_date") -> DataFrame:
    """Per partition: rows, files, bytes and readable size; no row is read."""
    own = _counting(spark)
    rows = own.read.parquet(path).groupBy(part_col).agg(F.count(F.lit(1)).alias("rows"))
    files = _files(own, path).groupBy(_folder(part_col).alias("_part")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    per = rows.join(files, F.col(part_col).cast("string").eqNullSafe(F.col("_part")))
    return per.select(part_col, "rows", "files", "bytes", readable_size("bytes").alias("size"))


def export_csv(df: DataFrame, path: str) -> str:
    """A report as CSV text with a header line (one file per task)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def layout_paths(base: str) -> dict[str, str]:
    """The reference's four layouts: day or month partitions x (user, ts) or (ts, user) sort key."""
    return {
        "events_daily_userid": os.path.join(base, "events_daily_userid"),
        "events_daily_ts": os.path.join(base, "events_daily_ts"),
        "events_monthly_userid": os.path.join(base, "events_monthly_userid"),
        "events_monthly_ts": os.path.join(base, "events_monthly_ts"),
    }


LAYOUTS = {
    "events_daily_userid": ("day", ("user_id", "ts")),
    "events_daily_ts": ("day", ("ts", "user_id")),
    "events_monthly_userid": ("month", ("user_id", "ts")),
    "events_monthly_ts": ("month", ("ts", "user_id")),
}


def write_four_layouts(df: DataFrame, base: str) -> dict[str, str]:
    """Write the same rows in the four layouts (the reference's ``INSERT .. SELECT`` copies)."""
    paths = layout_paths(base)
    for name, (grain, sort_cols) in LAYOUTS.items():
        write_layout(df, paths[name], grain, sort_cols)
    return paths
