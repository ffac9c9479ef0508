"""SimHash near-dedup by pigeonhole blocks.

Fingerprints are computed per document in Arrow batches and saved (16 bytes a document).  From
there everything is joins: equal fingerprints collapse to one representative, the 64 bits are
cut into four blocks of 16, and two fingerprints at distance <= 2 agree on at least two of them,
so representatives are joined on each of the six pairs of blocks (32 equal bits) and verified by
``bit_count`` of the XOR.  A bucket with more than ``HOT`` distinct fingerprints is cut once more
by the same argument: its other 32 bits fall into three sub-blocks, one of which must agree.
Links join distinct fingerprints only, each of which has at most 2,080 neighbours within two
bits, so their number grows with the fingerprints and not with the square of a group.

Defined results: a null text counts as empty; a text without words has fingerprint zero, linked
like any other; a null id gets its fingerprint and the component of its fingerprint's group;
repeated rows share a component, and different texts of one id are linked and dropped each by its
own fingerprint (rows that have their component's smallest id all stay, as do the null ids of a
fingerprint without any id); empty input gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, prepare, rows_in, same, saved, text_key, without

SEED = 42
HOT = 2_000


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Signed 64-bit SimHash of the shingles of ``text``."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    k = words_per_shingle
    if len(words) <= k:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-k])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    hashed = np.array(hashes, dtype=">u8")
    for i in range(0, len(hashed), 1 << 16):
        ones += np.unpackbits(hashed[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashed)).astype(np.uint8)
    return int(np.packbits(bits).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int = 3) -> DataFrame:
    """(id, key, fp) per row of ``docs``; ``key`` is ``text_key`` of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, texts in rows_in(batches, "id", "key", "text"):
            fps = [fingerprint(t, words_per_shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, keys, fps)], ["id", "key", "fp"])

    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"),
                        F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "id long, key long, fp long")


def close_pairs(reps: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of ``reps(fp, rep)`` whose fingerprints differ in one or two bits; reps are
    distinct by ``fp``.  A pair may come out of several tables."""
    def block(i: int, width: int = 16):
        return F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit((1 << width) - 1))

    tables = list(itertools.combinations(range(4), 2))
    keyed = []
    for t, (i, j) in enumerate(tables):
        k, l = (x for x in range(4) if x not in (i, j))
        keyed.append(F.struct(F.lit(t).alias("t"), (F.shiftleft(block(i), 16) + block(j)).alias("key"),
                              (F.shiftleft(block(k), 16) + block(l)).alias("rest")))
    rows = reps.select("fp", "rep", F.explode(F.array(*keyed)).alias("x")).select("fp", "rep", "x.*")
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rest = F.col("rest")
    subs = F.array(*[F.struct(F.lit(s).alias("s"), F.shiftrightunsigned(rest, at).bitwiseAND(F.lit((1 << w) - 1)).alias("sub"))
                     for s, (at, w) in enumerate(((0, 11), (11, 11), (22, 10)))])
    whole = F.array(F.struct(F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sub")))
    cut = (rows.join(sizes, ["t", "key"])
           .withColumn("y", F.explode(F.when(F.col("n") > hot, subs).otherwise(whole)))
           .select("t", "key", "y.s", "y.sub", "fp", "rep"))
    a, b = cut.alias("a"), cut.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("t", "key", "s", "sub")]
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= 2
    return (a.join(b, on + [F.col("a.fp") < F.col("b.fp"), near])
            .select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")))


def grouped(docs: DataFrame, id_col: str, text_col: str, words_per_shingle: int = 3) -> DataFrame:
    """(id, key, fp, component) per row.  Links join fingerprints, so an id with several texts
    does not tie their components together."""
    fps = saved(fingerprints(docs, id_col, text_col, words_per_shingle), "simhash")
    reps = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    roots = components(close_pairs(reps.select("fp", F.col("fp").alias("rep"))))
    rooted = (reps.join(roots, reps["fp"] == roots["node"], "left")
              .select("fp", "rep", F.coalesce("component", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    found = rooted.join(least, "root").select("fp", "component")
    return fps.join(found, "fp").select("id", "key", "fp", "component")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(id, fp, component) per row: component is the smallest id reachable by links."""
    return grouped(docs, id_col, text_col, words_per_shingle).select(F.col("id").alias(id_col), "fp", "component")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays: that with the component's smallest id.  Rows go by
    id and text."""
    lost = grouped(docs, id_col, text_col).filter(~same(F.col("id"), F.col("component")))
    return without(docs, lost, id_col, text_col)
