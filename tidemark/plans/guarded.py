"""The guarded balance fold (I01, F07): per key, in order, a row adds units, takes units if the balance
covers them (else it is rejected and the balance stays), or only checks that it would.

A rejected take leaves the balance, so this is no running sum, and a key holding a third of all rows must
not be one task.  The rows are cut by (key, order) into partitions of similar size; a hot key
spans many.  Of a partition only the first and the last key can continue in a neighbour, so only
those *chunks* have to learn their start balance:

1. Every chunk is summarised in one stream over its rows, whatever it demands:
   - a table of its result for every start balance, if it has ``PIECES`` ranges or fewer;
   - the least start balance that lets everything pass, and what is left then;
   - bounds of the result otherwise: after a rejection less is left than the rejected row asked for, plus
     what is added later.
2. The chunks of a key are chained in order.  A table or a start that lets everything pass turns an
   exact balance into an exact balance; otherwise an interval is carried on.
3. Chunks whose start is an interval are summarised again, over that interval only: few start balances
   stay apart for long once stock is scarce, as the interval is then no wider than the largest request.  An exact
   start needs no table at all.  At most ``ROUNDS`` times.
4. Keys that are still open (large requests and large additions in turn) are folded once in order, as a
   stream of (kind, amount); nothing is held.
5. Every partition is scanned once more from its chunks' start balances, as a stream of Arrow batches.

The number of passes is fixed, memory does not depend on demands or on the rows of a chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import ensure_checkpoint_dir, ordered_partitions, saved, ship_package

ADD, TAKE, PROBE, INVALID = 0, 1, 2, 3

PIECES = 512        # ranges of a chunk's table
WIDTH = 4096        # start balances that are followed one by one
WORK = 20_000_000   # range updates of one table
ROUNDS = 4
BROADCAST_ROWS = 100_000  # chunks (two a partition) whose start balances are sent to every task

FAR = 1 << 62


# ------------------------------------------------------------------ tables of a chunk's result

class Exact:
    """One start balance."""

    def __init__(self, start: int):
        self.start = self.b = start

    def feed(self, ops: list[int], amounts: list[int]) -> bool:
        b = self.b
        for op, d in zip(ops, amounts):
            if op == TAKE:
                if b >= d:
                    b -= d
            elif op == ADD:
                b += d
        self.b = b
        return True

    def table(self) -> tuple[list[int], list[int]]:
        return [self.start], [self.b - self.start]


class Each:
    """Every start balance from ``lo`` to ``hi``; those that meet go on as one."""

    def __init__(self, lo: int, hi: int):
        self.starts = np.arange(lo, hi + 1)
        self.b = self.starts.copy()
        self.of = np.arange(len(self.b))  # start -> its place in b
        self.added = 0                    # added to every balance
        self.fed = 0

    def merge(self) -> None:
        self.b, place = np.unique(self.b, return_inverse=True)
        self.of = place[self.of]

    def feed(self, ops: list[int], amounts: list[int]) -> bool:
        b, added = self.b, self.added
        top, one = int(b.max()), len(b) == 1
        for op, d in zip(ops, amounts):
            if op == ADD:
                added += d
            elif op == TAKE and top + added >= d:
                if one:
                    top -= d
                    continue
                covered = b >= d - added
                b = np.where(covered, b - d, b)
                top = int(b.max())
                self.fed += 1
                if self.fed % 64 == 0:
                    self.b = b
                    self.merge()
                    b, one = self.b, len(self.b) == 1
                    top = int(b.max())
        self.b, self.added = (np.array([top]) if one else b), added
        return True

    def table(self) -> tuple[list[int], list[int]]:
        off = self.b[self.of] + self.added - self.starts
        new = np.append(True, off[1:] != off[:-1])
        return self.starts[new].tolist(), off[new].tolist()


class Ranges:
    """Ranges of start balances from ``lo`` to ``hi`` with the offset that each has got so far; a
    take splits a range where its balances begin to cover it.  Given up beyond ``most`` ranges."""

    def __init__(self, lo: int = -FAR, hi: int = FAR, most: int = PIECES):
        self.low, self.off, self.hi, self.most, self.work = np.array([lo]), np.array([0]), hi, most, 0

    def feed(self, ops: list[int], amounts: list[int]) -> bool:
        low, off = self.low, self.off
        for op, d in zip(ops, amounts):
            if op == ADD:
                off = off + d
            elif op == TAKE:
                covered = low + off >= d
                high = np.append(low[1:], self.hi + 1) + off  # the first balance beyond the range
                split = np.flatnonzero(~covered & (high > d))
                off = np.where(covered, off - d, off)
                if len(split):
                    low = np.insert(low, split + 1, d - off[split])
                    off = np.insert(off, split + 1, off[split] - d)
                    same = off[1:] == off[:-1]
                    if same.any():
                        keep = np.append(True, ~same)
                        low, off = low[keep], off[keep]
                self.work += len(low)
                if len(low) > self.most or self.work > WORK:
                    return False
        self.low, self.off = low, off
        return True

    def table(self) -> tuple[list[int], list[int]]:
        return self.low.tolist(), self.off.tolist()


def solver(lo: int, hi: int):
    """What follows the start balances from ``lo`` to ``hi`` through a chunk."""
    if lo == hi:
        return Exact(lo)
    return Each(lo, hi) if hi - lo < WIDTH else Ranges(lo, hi)


class Sketch:
    """Summary of a chunk for any start balance, from arrays of its rows in order."""

    def __init__(self):
        self.need, self.net, self.adds = -FAR, 0, 0
        self.left = -FAR          # most that is left if some row is rejected
        self.tail: int | None = None  # added after the last take

    def feed(self, ops: np.ndarray, amounts: np.ndarray) -> None:
        add = np.where(ops == ADD, amounts, 0)
        take = np.where(ops == TAKE, amounts, 0)
        before = self.net + np.cumsum(add - take) - (add - take)
        takes = np.flatnonzero(ops == TAKE)
        total, later = int(add.sum()), add.sum() - np.cumsum(add)
        self.left += total
        if len(takes):
            self.need = max(self.need, int((amounts - before)[takes].max()))
            self.left = max(self.left, int((amounts - 1 + later)[takes].max()))
            self.tail = int(later[takes[-1]])
        elif self.tail is not None:
            self.tail += total
        self.net += int((add - take).sum())
        self.adds += total


def through(r: dict, lo: int, hi: int) -> tuple[int, int]:
    """Interval of the balance after a chunk (its summary ``r``) entered with lo..hi."""
    if r["low"] is not None and r["t_lo"] <= lo and hi <= r["t_hi"]:
        low, off = np.asarray(r["low"]), np.asarray(r["off"])
        a, b = (int(np.searchsorted(low, x, side="right")) - 1 for x in (lo, hi))
        first = np.maximum(low[a:b + 1], lo)
        last = np.minimum(np.append(low[a + 1:b + 1] - 1, hi), hi)
        return int((first + off[a:b + 1]).min()), int((last + off[a:b + 1]).max())
    if lo >= r["need"]:
        return lo + r["net"], hi + r["net"]
    top = max(hi + r["net"], r["rest"]) if hi >= r["need"] else r["rest"]
    low_end = lo + r["adds"] if r["tail"] is None else min(lo + r["adds"], r["tail"])
    return low_end, max(low_end, min(hi + r["adds"], top))


# --------------------------------------------------------------------------------- Spark jobs

_OPS = ["__op", "__amount"]
_SUMMARY = T.StructType([
    T.StructField("__pid", T.LongType()), T.StructField("_edge", T.IntegerType()), T.StructField("_key", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("low", T.ArrayType(T.LongType())),
    T.StructField("off", T.ArrayType(T.LongType())), T.StructField("t_lo", T.LongType()), T.StructField("t_hi", T.LongType()),
    T.StructField("need", T.LongType()), T.StructField("net", T.LongType()), T.StructField("adds", T.LongType()),
    T.StructField("rest", T.LongType()), T.StructField("tail", T.LongType())])
_CHAINED = T.StructType([*_SUMMARY.fields, T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
                         T.StructField("settled", T.BooleanType())])

_EXACT = T.StructType([T.StructField("__pid", T.LongType()), T.StructField("_edge", T.IntegerType()), T.StructField("exact", T.LongType())])


def _same_key(keys: list[str], a: str, b: str) -> Column:
    """Null-safe equality of the key columns of ``a`` and the struct ``b``."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _chunk_rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, dict]]:
    """((pid, edge, key), columns) of stretches of rows of one chunk, in order; a chunk may come as several."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pid, edge = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("__pid", "_edge"))
        cuts = np.flatnonzero((pid[1:] != pid[:-1]) | (edge[1:] != edge[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            yield (int(pid[a]), int(edge[a]), part.column("_key")[0].as_py()), {c: part.column(c) for c in columns}


def _summaries(rows: DataFrame) -> DataFrame:
    """One ``_SUMMARY`` row per chunk of ``rows`` (sorted; with ``lo``, ``hi``: the interval of the
    chunk's start balance, null if nothing is known)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, stretches in groupby(_chunk_rows(batches, ["__start", "lo", "hi", *_OPS]), key=lambda x: x[0]):
            sketch, table = Sketch(), None
            start = domain = None
            for _, part in stretches:
                if domain is None:
                    start, lo, hi = (part[c][0].as_py() for c in ("__start", "lo", "hi"))
                    domain = (-FAR, FAR) if lo is None else (lo, hi)
                    table = solver(*domain)
                ops, amounts = (part[c].to_numpy(zero_copy_only=False) for c in _OPS)
                sketch.feed(ops, amounts)
                if table is not None and not table.feed(ops.tolist(), amounts.tolist()):
                    table = None
            low, off = table.table() if table is not None else (None, None)
            yield pa.RecordBatch.from_pylist([dict(zip(_SUMMARY.names, (
                *chunk, start, low, off, *domain, sketch.need, sketch.net, sketch.adds, sketch.left, sketch.tail)))],
                schema=to_arrow_schema(_SUMMARY))

    return rows.mapInArrow(run, _SUMMARY)


def _chained(summaries: DataFrame) -> DataFrame:
    """The summaries with the interval of every chunk's start balance (null: the key has no start)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["_key"] != key:
                    key, state = r["_key"], None if r["start"] is None else (r["start"], r["start"])
                lo, hi = state or (None, None)
                out.append({**r, "lo": lo, "hi": hi, "settled": lo == hi})
                state = state and through(r, *state)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=to_arrow_schema(_CHAINED))

    ordered = summaries.select(_SUMMARY.names).repartition("_key").sortWithinPartitions("_key", "__pid")
    return saved(ordered.mapInArrow(run, _CHAINED), "fold-chunks")


def _in_order(rows: DataFrame) -> DataFrame:
    """Exact start balances of the chunks of ``rows``, one key after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, state = None, None, None
        for chunk, part in _chunk_rows(batches, ["__start", *_OPS]):
            if chunk[2] != key:
                key, state = chunk[2], Exact(part["__start"][0].as_py())
            if chunk != at:
                at = chunk
                yield pa.RecordBatch.from_pylist([{"__pid": chunk[0], "_edge": chunk[1], "exact": state.b}],
                                                 schema=to_arrow_schema(_EXACT))
            state.feed(*(part[c].to_pylist() for c in _OPS))

    return rows.mapInArrow(run, _EXACT)


def _start_balances(cut: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """(__pid, _k, carry) of every chunk of a key that spans partitions, and their number."""
    key = F.struct(*keys)
    ends = cut.groupBy("__pid").agg(F.min(key).alias("_a"), F.max(key).alias("_b"))
    both = F.when(F.col("_a").eqNullSafe(F.col("_b")), F.array("_a")).otherwise(F.array("_a", "_b"))
    edges = ends.select("__pid", F.posexplode(both).alias("_edge", "_k")).withColumn(
        "_key", F.to_json("_k", {"ignoreNullFields": "false"}))
    spread = F.count(F.lit(1)).over(Window.partitionBy("_key")) > 1
    edges = saved(edges.withColumn("_more", spread).filter("_more").drop("_more"), "fold-edges")
    rows = cut.alias("c").join(edges.alias("e"), (F.col("c.__pid") == F.col("e.__pid")) & _same_key(keys, "c", "e._k")).select(
        "c.__pid", "c.__at", "e._edge", "e._key", "c.__start", "c.__op", "c.__amount")

    def in_chunks(df: DataFrame) -> DataFrame:
        return df.repartition("__pid").sortWithinPartitions("__pid", "_edge", "__at")

    def sizes(chunks: DataFrame) -> tuple[int, int]:
        return tuple(chunks.agg(F.count(F.lit(1)), F.count_if(~F.col("settled"))).first())

    nothing = F.lit(None).cast("long")
    chunks = _chained(_summaries(in_chunks(rows.withColumns({"lo": nothing, "hi": nothing}))))
    n, still_open = sizes(chunks)
    for _ in range(ROUNDS):
        if not still_open:
            break
        # chunks of open keys that have no table over the interval of their start
        still = chunks.filter("NOT settled").select("_key").distinct()
        again = chunks.join(still, "_key", "left_semi").filter("lo IS NOT NULL AND (low IS NULL OR lo < t_lo OR hi > t_hi)")
        again = rows.join(again.select("__pid", "_edge", "lo", "hi"), ["__pid", "_edge"])
        new = saved(_summaries(in_chunks(again)), "fold-summaries")
        chunks = _chained(chunks.join(new, ["__pid", "_edge"], "left_anti").select(_SUMMARY.names).unionByName(new))
        n, still_open = sizes(chunks)
    exact = F.col("lo")
    if still_open:
        still = chunks.filter("NOT settled").select("_key").distinct()
        open_rows = rows.join(still, "_key", "left_semi").repartition("_key").sortWithinPartitions("_key", "__pid", "__at")
        chunks = chunks.join(saved(_in_order(open_rows), "fold-in-order"), ["__pid", "_edge"], "left")
        exact = F.coalesce("exact", "lo")
    return chunks.select("__pid", "_edge", exact.alias("carry")).join(edges, ["__pid", "_edge"]).select("__pid", "_k", "carry"), n


def guarded_fold(df: DataFrame, keys: list[str], order: list, delta_col: str, start_col: str,
                 consume_col: str | None = None, num_partitions: int | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Per key, in ``order``: apply each row's ``delta`` to a balance that starts at ``start_col`` of the
    key's first row.  Adds ``accepted`` and ``balance_after``.

    A positive or zero delta adds; a negative one takes if the balance covers it; with ``consume_col`` not true
    it only checks.  A null delta is rejected and changes nothing.  A key whose first row has no
    start rejects everything, with balance 0.  ``keep`` limits the output to these columns (all by
    default); nothing else is written to the cut.
    """
    spark = df.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    out_cols = list(df.columns) if keep is None else list(dict.fromkeys([*keys, *keep]))
    delta = F.col(delta_col).cast("long")
    consumes = F.coalesce(F.col(consume_col), F.lit(False)) if consume_col else F.lit(True)
    op = F.when(delta.isNull(), INVALID).when(delta >= 0, ADD).when(consumes, TAKE).otherwise(PROBE)
    by = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    own = df.withColumns({"__op": op.cast("byte"), "__amount": F.abs(F.coalesce(delta, F.lit(0))), "__start": F.col(start_col).cast("long")})
    n = ordered_partitions(df, num_partitions)
    cols = list(dict.fromkeys([*out_cols, *keys, "__op", "__amount", "__start"]))
    alone = {"__pid": F.lit(0).cast("long"), "__carried": F.lit(False), "__carry": F.lit(None).cast("long")}
    if n == 1:
        rows = own.repartition(1).sortWithinPartitions(*by).select(*cols).withColumns(alone)
    else:
        cut = own.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*cols).withColumn("__at", F.monotonically_increasing_id())
        # a range cut differs from run to run, so it is fixed once
        cut = cut.withColumn("__pid", F.shiftright("__at", 33)).checkpoint(eager=True)
        carries, chunks = _start_balances(cut, keys)
        k = (F.broadcast(carries) if chunks <= BROADCAST_ROWS else carries).alias("k")
        rows = cut.alias("c").join(k, (F.col("c.__pid") == F.col("k.__pid")) & _same_key(keys, "c", "k._k"), "left").select(
            "c.*", F.col("k.__pid").isNotNull().alias("__carried"), F.col("k.carry").alias("__carry"))
        if chunks > BROADCAST_ROWS:
            rows = rows.repartition("__pid").sortWithinPartitions("__at")
    rows = rows.select(*dict.fromkeys([*out_cols, *keys]), "__pid", "__carried", "__carry", "__start", "__op", "__amount")
    schema = T.StructType([*[df.schema[c] for c in out_cols], T.StructField("accepted", T.BooleanType(), False),
                           T.StructField("balance_after", T.LongType(), False)])
    return rows.mapInArrow(_scan(keys, to_arrow_schema(schema)), schema)


def _scan(keys: list[str], arrow: pa.Schema):
    """Fold a sorted partition from its start balances, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = b = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            now = tuple(batch.column(c)[0].as_py() for c in ("__pid", *keys))
            new[0] = now != last
            last = tuple(batch.column(c)[n - 1].as_py() for c in ("__pid", *keys))
            for c in ("__pid", *keys):
                col = batch.column(c)
                x, y = col.slice(1), col.slice(0, n - 1)
                differ = pc.or_kleene(pc.fill_null(pc.not_equal(x, y), False), pc.xor(pc.is_null(x), pc.is_null(y)))
                new[1:] |= differ.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            first = batch.select(["__carried", "__carry", "__start"]).take(pa.array(starts)).to_pylist()
            ops, amounts = (batch.column(c).to_pylist() for c in _OPS)
            accepted, balance = [False] * n, [0] * n
            bounds = [*starts.tolist(), n]
            if not new[0]:
                bounds, first = [0, *bounds], [None, *first]
            for head, i, j in zip(first, bounds[:-1], bounds[1:]):
                if head is not None:
                    b = head["__carry"] if head["__carried"] else head["__start"]
                if b is None:
                    continue
                for k in range(i, j):
                    op, d = ops[k], amounts[k]
                    if op == ADD:
                        b += d
                        accepted[k] = True
                    elif op != INVALID and b >= d:
                        if op == TAKE:
                            b -= d
                        accepted[k] = True
                    balance[k] = b
            columns = [batch.column(name) for name in arrow.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(accepted), pa.array(balance, pa.int64())], arrow.names)

    return run
