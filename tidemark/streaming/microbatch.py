"""Event-time streams that lose no row: every trigger is a batch job over tables.

A stream that waits for the order of its rows keeps them somewhere until the watermark passes.  Here that is a
table in folders by time, and what a key has come to (a balance, an open cart, an open session) is another
table; a trigger is ``foreachBatch``:

1. Rows at or before the horizon (latest time seen so far, less ``delay``) are *late*: what they belong to is
   decided.  They go to the reject output, as do rows without a time.  The others join the waiting rows,
   in folders by span of event time.
2. The horizon moves.  Only the folders between the old and the new horizon are read, whatever else
   waits; the rows between are due.
3. ``step`` folds the due rows, with the state of the keys they touch, as any batch job does, so a hot key is
   split over tasks and a long wait costs nothing.  Its output and the changed states are appended.

Every table is written under the number of its batch and read below it, the latest time seen comes last: a
batch that is retried, or resumed after a loss, overwrites its own folders and changes nothing else.
Folders of time that are done, and states overtaken by a full copy, are removed when the next batch begins.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import EPOCH_NTZ, ntz_micros
from tidemark.session import list_folders, range_partitions, remove_folder, scratch_path

SPAN_SECONDS = 86_400  # of a folder of waiting rows: as long as a trigger's step of time, or longer
COPY_EVERY = 16       # batches between full copies of the state


def struct(**fields: T.DataType) -> T.StructType:
    """A schema of nullable fields (without a session, which a DDL string would need)."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


class Results(NamedTuple):
    output: DataFrame
    late: DataFrame


class EventTimeJob(NamedTuple):
    """What a stream does with its due rows.

    ``step(due, state, horizon)`` returns (output, new state).  ``due`` has the input's columns; ``state`` the
    rows of every key (``keys`` may have several rows); ``horizon`` is a TIMESTAMP_NTZ column.  The new state
    holds all rows of each key it mentions; a row that is null beside its keys stands for none.  It may be a function
    of the written output, which then is not worked out twice.
    """
    keys: list[str]
    state: T.StructType
    output: T.StructType
    step: Callable[[DataFrame, DataFrame, object], tuple[DataFrame, DataFrame | Callable[[DataFrame], DataFrame]]]
    ts_col: str = "ts"


class _Tables:
    """The tables of one stream under ``base``."""

    def __init__(self, spark: SparkSession, base: str, job: EventTimeJob, schema: T.StructType, delay: str, span: int):
        self.spark, self.base, self.job, self.schema = spark, base, job, schema
        self.delay = int(pd.Timedelta(delay) / pd.Timedelta(microseconds=1))
        self.span = span * 1_000_000

    def at(self, *parts: str) -> str:
        return os.path.join(self.base, *parts)

    def read(self, name: str, schema: T.StructType, batches: list[int]) -> DataFrame:
        """The folders of ``name`` of these batches, with ``_batch``."""
        out = [self.spark.read.schema(schema).parquet(self.at(name, f"_batch={b}")).withColumn("_batch", F.lit(b).cast("long")) for b in batches]
        empty = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_batch", T.LongType())]))
        for df in out:
            empty = empty.unionByName(df)
        return empty

    def batches(self, name: str, below: int) -> list[int]:
        found = (int(f.split("=")[1]) for f in list_folders(self.spark, self.at(name)) if f.startswith("_batch="))
        return sorted(b for b in found if b < below)

    def write(self, df: DataFrame, name: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self.at(name, f"_batch={batch}"))

    # -- the latest time seen

    def newest(self, below: int) -> int | None:
        """Of the last finished batch (its marks are written last)."""
        marks = self.batches("marks", below)
        if not marks:
            return None
        return self.spark.read.schema("newest long").parquet(self.at("marks", f"_batch={marks[-1]}")).first()["newest"]

    # -- the state

    def latest(self, below: int) -> DataFrame:
        names = [f.name for f in self.job.state]
        copies = self.batches("copies", below)
        since = copies[-1] if copies else -1
        rows = self.read("state", self.job.state, [b for b in self.batches("state", below) if b > since])
        if copies:
            rows = rows.unionByName(self.read("copies", self.job.state, [since]))
        every = Window.partitionBy(F.struct(*self.job.keys))
        rows = rows.withColumn("_last", F.max("_batch").over(every)).filter("_batch = _last")
        some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in names if c not in self.job.keys])
        return rows.filter(some).select(names)

    # -- the waiting rows

    def spans(self) -> dict[int, str]:
        return {int(f.split("=")[1]): f for f in list_folders(self.spark, self.at("waiting")) if f.startswith("_span=")}

    def due(self, after: int | None, upto: int, batch: int) -> DataFrame:
        """Waiting rows of times in (after, upto]."""
        low = after // self.span if after is not None else None
        folders = [f for s, f in self.spans().items() if (low is None or s >= low) and s <= upto // self.span]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        kept = T.StructType([*self.schema.fields, T.StructField("_us", T.LongType()), T.StructField("_batch", T.LongType())])
        rows = self.spark.read.schema(kept).option("basePath", self.at("waiting")).parquet(*[self.at("waiting", f) for f in folders])
        rows = rows.filter((F.col("_batch") <= batch) & (F.col("_us") <= upto))
        return (rows if after is None else rows.filter(F.col("_us") > after)).select([f.name for f in self.schema])

    # -- one trigger

    def run(self, batch: DataFrame, number: int) -> None:
        before = self.newest(number)
        after = None if before is None else before - self.delay
        self.clean(after, number)
        rows = batch.withColumn("_us", ntz_micros(self.job.ts_col))
        on_time = F.col("_us").isNotNull() if after is None else F.coalesce(F.col("_us") > after, F.lit(False))
        self.write(rows.filter(~on_time).drop("_us"), "late", number)
        kept = rows.filter(on_time).withColumn("_span", F.floor(F.col("_us") / self.span)).withColumn("_batch", F.lit(number).cast("long"))
        (kept.repartitionByRange(range_partitions(batch), "_us").write.partitionBy("_span", "_batch")
         .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.at("waiting")))
        seen = [x for x in (rows.filter(on_time).agg(F.max("_us")).first()[0], before) if x is not None]
        newest = max(seen, default=None)
        if newest is None or newest == before:  # nothing has become due
            out, new = self.spark.createDataFrame([], self.job.output), self.spark.createDataFrame([], self.job.state)
        else:
            upto = newest - self.delay
            horizon = F.timestamp_add("MICROSECOND", F.lit(upto), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
            out, new = self.job.step(self.due(after, upto, number), self.latest(number), horizon)
        self.write(out.select([f.name for f in self.job.output]), "output", number)
        if callable(new):
            new = new(self.read("output", self.job.output, [number]).drop("_batch"))
        self.write(new.select([f.name for f in self.job.state]), "state", number)
        if number % COPY_EVERY == COPY_EVERY - 1:
            self.write(self.latest(number + 1), "copies", number)
        self.write(self.spark.createDataFrame([(newest,)], "newest long"), "marks", number)

    def clean(self, after: int | None, number: int) -> None:
        """Remove what no batch from this one on reads: it begins after the last one has finished."""
        for span, folder in self.spans().items():
            if after is not None and span < after // self.span:
                remove_folder(self.spark, self.at("waiting", folder))
        copies = self.batches("copies", number)
        if copies:
            for name, keep in (("state", copies[-1] + 1), ("copies", copies[-1]), ("marks", number - 1)):
                for b in self.batches(name, keep):
                    remove_folder(self.spark, self.at(name, f"_batch={b}"))


def run_event_time(spark: SparkSession, stream: DataFrame, job: EventTimeJob, name: str, *arrivals, delay: str = "1 hour",
                   span_seconds: int = SPAN_SECONDS) -> Results:
    """Run ``job`` over the stream's source; then, after each of ``arrivals`` (functions that add files to
    the source), resume it from its checkpoint.  Every input row is in the result, still waiting, or late."""
    base = scratch_path(spark, name)
    tables = _Tables(spark, base, job, stream.schema, delay, span_seconds)
    for arrive in (lambda: None, *arrivals):
        arrive()
        (stream.writeStream.foreachBatch(tables.run).option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start().awaitTermination())

    def whole(folder: str, schema: T.StructType) -> DataFrame:
        if not tables.batches(folder, 1 << 62):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(os.path.join(base, folder)).select([f.name for f in schema])

    return Results(whole("output", job.output), whole("late", stream.schema))
