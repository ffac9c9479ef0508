"""Helpers shared by the operators: scratch tables, components, tiled buckets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a cluster."""
    ship_package(spark)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the lineage, and
    what several consumers read is computed once and survives the loss of an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_in(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Column lists (Python values) of each non-empty Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            yield tuple(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names)


def groups_in(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """Groups of a stream sorted by its first ``keys`` columns, one group in memory at a time;
    yields (key, rows)."""
    key, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def in_batches(rows: Iterator[tuple], names: list[str], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows of nullable longs as Arrow batches of ``size`` rows (a batch a group would cost more
    than the group)."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): one row (node, component) per node that
    is not the smallest of its component, ``component`` being that smallest node.

    Large-star / small-star rounds.  Every round is a minimum per node (combined before its
    shuffle, so a hub node does not gather its edges in one task) and a join back; each round is
    checkpointed, and rounds end when the edge set stops changing.
    """
    def oriented(df, u, v):
        return df.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct()

    def signature(df):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    prepare(edges.sparkSession)
    e = oriented(edges, F.col("a"), F.col("b")).checkpoint()
    before = signature(e)
    while before[0]:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v")
        e = small.filter("u <> v").distinct().checkpoint()
        now = signature(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def colliding(rows: DataFrame, keys: list[str], member: str, cap: int) -> DataFrame:
    """Cut the buckets of ``rows`` (equal ``keys``) with two or more members into tiles.

    Buckets of one row are dropped (they hold no pair).  A bucket of n rows is dealt into
    g = ceil(n / cap) parts by a hash of ``member``; each unordered pair of parts is a tile, so
    every pair of members meets in exactly one tile, or in (p, p) for two of one part.  Adds
    ``ta``, ``tb`` (the tile) and ``part``.  Bucket sizes are combined before their shuffle.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    g = F.ceil(F.col("_n") / F.lit(cap)).cast("int")
    hit = rows.join(sizes, keys).withColumn("_g", g).drop("_n")
    hit = hit.withColumn("part", F.pmod(F.xxhash64(member), F.col("_g")).cast("int"))
    tiles = hit.withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
    return (tiles.withColumn("ta", F.least("part", "_t").cast("int"))
            .withColumn("tb", F.greatest("part", "_t").cast("int")).drop("_g", "_t"))


def pairs_of_tile(ta: int, tb: int, parts: list[int]) -> tuple[list[int], list[int]]:
    """Index lists (left, right) of one tile; equal lists mean "all pairs within"."""
    if ta == tb:
        own = list(range(len(parts)))
        return own, own
    return ([i for i, p in enumerate(parts) if p == ta], [i for i, p in enumerate(parts) if p == tb])


class Forest:
    """Union-find over a tile's members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def same(a: Column, b: Column) -> Column:
    """Null-safe equality."""
    return a.eqNullSafe(b)


def text_key(text: Column) -> Column:
    """A 64-bit hash that, beside an id, tells rows by their text."""
    return F.xxhash64(text.cast("string").cast("binary"))


def without(docs: DataFrame, lost: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose id (null-safe) and text are listed in ``lost(id, key)``,
    ``key`` being the ``text_key``."""
    lost = lost.select(F.col("id").alias("_lost"), F.col("key").alias("_of")).distinct()
    on = same(docs[id_col], lost["_lost"]) & (text_key(docs[text_col]) == lost["_of"])
    return docs.join(lost, on, "left_anti")
