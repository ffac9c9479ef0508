"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are scaled to unit length, where a cosine of 0.93 is a distance of 0.374.  A table's key
is ``HASHES`` quantised Gaussian projections floor((a.v + b) / WIDTH); ``TABLES`` tables put a
pair at the threshold into one bucket with probability 0.97 (closer pairs more often).  Equal
vectors of a label collapse to one representative first, so a very common vector is one row in
every later step.  Buckets of the same label are cut into tiles of at most ``TILE`` + ``TILE``
members; a tile's task computes exact cosines in double precision by matrix products and returns
link counts per member and a spanning forest, not the pairs.  A pair that meets in several tables
counts in the first of them only, told by the members' keys.

Defined results: a null, empty or zero vector, one with null or non-finite components, and one
with a null label link with nothing (not even with their equals); vectors of different lengths
are never compared; repeated vec_ids are rows of their own that link as equal vectors do; a null
id keeps null; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Forest, colliding, components, groups_in, in_batches, pairs_of_tile, prepare, rows_in, same, saved

TABLES, HASHES, WIDTH = 32, 14, 2.0
TILE = 512
SEED = 20_240


def projections(dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dims])
    mix = rng.integers(1, 1 << 62, (TABLES, HASHES), dtype=np.int64) | 1
    return rng.standard_normal((dims, TABLES * HASHES)), rng.uniform(0, WIDTH, TABLES * HASHES), mix


def bucket_keys(vectors: np.ndarray, made: dict) -> np.ndarray:
    """32-bit keys (rows x tables) of unit vectors."""
    dims = vectors.shape[1]
    if dims not in made:
        made[dims] = projections(dims)
    a, b, mix = made[dims]
    q = np.floor((vectors @ a + b) / WIDTH).astype(np.int64).reshape(len(vectors), TABLES, HASHES)
    with np.errstate(over="ignore"):
        return ((q * mix).sum(2) >> 32).astype(np.int32)


def usable(vector) -> bytes | None:
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, np.float64) + 0.0  # no negative zeros
    return v.tobytes() if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(-1, keepdims=True)  # squares of very large or small components stay finite
    return v / np.sqrt((v * v).sum(-1, keepdims=True))


def vector_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = 0.93) -> DataFrame:
    """One row per row of ``df``: (id, n_links, component)."""
    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, vectors in rows_in(batches, "id", "label", "vector"):
            out = [usable(v) if label is not None else None for v, label in zip(vectors, labels)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(out, pa.binary())],
                                             ["id", "label", "v"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        for reps, labels, vs, counts, firsts in rows_in(batches, "rep", "label", "v", "count", "first"):
            keys: list = [None] * len(reps)
            for size in {len(v) for v in vs}:
                own = [i for i, v in enumerate(vs) if len(v) == size]
                x = unit(np.frombuffer(b"".join(vs[i] for i in own)).reshape(len(own), -1))
                for i, k in zip(own, bucket_keys(x, made)):
                    keys[i] = k
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(labels, pa.string()), pa.array(vs, pa.binary()), pa.array(counts),
                                              pa.array(firsts, pa.int64()), pa.array([len(v) for v in vs], pa.int32()),
                                              pa.array(keys, pa.list_(pa.int32()))],
                                             ["rep", "label", "v", "count", "first", "size", "keys"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(linked(batches), ["a", "b", "n"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (label, size, t, _, ta, tb), rows in groups_in(batches, 6):
            parts, reps, counts, vs, keys = zip(*rows)
            left, right = pairs_of_tile(ta, tb, list(parts))
            if not left or not right or len(rows) < 2:
                continue
            x = unit(np.frombuffer(b"".join(vs)).reshape(len(rows), -1))
            keys = np.array(keys, np.int32)
            reps, counts = np.array(reps, np.int64), np.array(counts, np.int64)
            near = (x[left] @ x[right].T) >= least
            i, j = np.nonzero(near)
            i, j = np.array(left)[i], np.array(right)[j]
            once = reps[i] < reps[j] if ta == tb else np.ones(len(i), bool)
            i, j = i[once], j[once]
            links, forest, edges = np.zeros(len(rows), np.int64), Forest(len(rows)), []
            for a in range(0, len(i), 1 << 14):
                p, q = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
                first = (keys[p] == keys[q]).argmax(1) == t
                p, q = p[first], q[first]
                np.add.at(links, p, counts[q])
                np.add.at(links, q, counts[p])
                edges += [(int(reps[m]), int(reps[n])) for m, n in zip(p.tolist(), q.tolist()) if forest.join(m, n)]
            for i in np.flatnonzero(links).tolist():
                yield int(reps[i]), None, int(links[i])
            for a, b in edges:
                yield a, b, 0

    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vector_col).cast("array<double>").alias("vector"))
    rows = saved(rows.mapInArrow(normal, "id long, label string, v binary"), "vectors")
    # a class is a label and a vector, told by a number: ids may repeat or be null
    classes = (rows.filter("v is not null").groupBy("label", "v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("count"))
               .withColumn("rep", F.monotonically_increasing_id()))
    reps = saved(classes.mapInArrow(keyed, "rep long, label string, v binary, count long, first long, size int, keys array<int>"), "classes")
    narrow = (reps.select("rep", "label", "size", F.posexplode("keys").alias("t", "key")))
    tiles = colliding(narrow, ["label", "size", "t", "key"], "rep", TILE)
    met = (tiles.join(reps.select("rep", "label", "v", "count", "keys"), ["label", "rep"])
           .select("label", "size", "t", "key", "ta", "tb", "part", "rep", "count", "v", "keys")
           .repartition("label", "size", "t", "key", "ta", "tb").sortWithinPartitions("label", "size", "t", "key", "ta", "tb"))
    found = saved(met.mapInArrow(compare, "a long, b long, n long"), "links")
    links = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "_a")
    roots = components(found.filter("b is not null").select("a", "b"))
    rooted = (reps.join(links, reps["rep"] == links["_a"], "left").join(roots, reps["rep"] == roots["node"], "left")
              .select(F.col("label").alias("_label"), F.col("v").alias("_v"), "first",
                      (F.col("count") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("root")))
    least_id = rooted.groupBy("root").agg(F.min("first").alias("component"))
    of = rooted.join(least_id, "root").drop("first", "root")
    out = rows.join(of, (rows["label"] == of["_label"]) & (rows["v"] == of["_v"]), "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component", "id").alias("component_id"),
                      same(F.col("id"), F.coalesce("component", "id")).alias("kept"))
