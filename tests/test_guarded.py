"""The guarded fold: tables and bounds of a chunk against the row-by-row fold, and whole folds of one hot
key cut into many partitions, whatever its requests look like."""

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fold_helpers import coded, fold_rows
from tidemark.operators import inventory as inv
from tidemark.plans import guarded

rows_of = st.lists(st.integers(min_value=-25, max_value=12), min_size=1, max_size=60)


def summary(ops, amounts, lo=None, hi=None, table=True):
    sketch = guarded.Sketch()
    half = len(ops) // 2
    for part in (slice(0, half), slice(half, None)):  # as two batches
        sketch.feed(ops[part], amounts[part])
    r = {"need": sketch.need, "net": sketch.net, "adds": sketch.adds, "rest": sketch.left, "tail": sketch.tail, "low": None, "off": None}
    if table:
        r["t_lo"], r["t_hi"] = (-guarded.FAR, guarded.FAR) if lo is None else (lo, hi)
        t = guarded.solver(r["t_lo"], r["t_hi"])
        if t.feed(ops[:half].tolist(), amounts[:half].tolist()) and t.feed(ops[half:].tolist(), amounts[half:].tolist()):
            r["low"], r["off"] = t.table()
    return r


@settings(max_examples=300, deadline=None)
@given(rows_of, st.lists(st.booleans(), min_size=60, max_size=60), st.integers(0, 70), st.integers(0, 40))
def test_bounds_and_tables_hold_every_start(ds, cs, lo, width):
    ops, amounts = coded(ds, cs[:len(ds)])
    ends = [fold_rows(ds, cs, b)[1][-1] for b in range(lo, lo + width + 1)]
    a, b = guarded.through(summary(ops, amounts, table=False), lo, lo + width)
    assert a <= min(ends) and max(ends) <= b
    for r in (summary(ops, amounts), summary(ops, amounts, lo, lo + width)):
        assert r["low"] is not None
        assert guarded.through(r, lo, lo + width) == (min(ends), max(ends))
        for start, end in zip(range(lo, lo + width + 1), ends):
            assert guarded.through(r, start, start) == (end, end)


@settings(max_examples=100, deadline=None)
@given(rows_of, st.integers(0, 70))
def test_a_wide_interval_is_cut_into_ranges(ds, lo):
    ops, amounts = coded(ds, [True] * len(ds))
    hi = lo + guarded.WIDTH + 5
    t = guarded.solver(lo, hi)
    assert isinstance(t, guarded.Ranges) and t.feed(ops.tolist(), amounts.tolist())
    low, off = t.table()
    r = {"low": low, "off": off, "t_lo": lo, "t_hi": hi}
    for b in (lo, lo + 1, lo + 17, lo + 300, hi - 1, hi):
        assert guarded.through(r, b, b)[0] == fold_rows(ds, [True] * len(ds), b)[1][-1]


def test_tables_do_not_grow_with_the_demand():
    """10,000 takes of 1..50 and 120 takes of 1..10**9 once made 250,000 and 9 million ranges."""
    rng = random.Random(3)
    for takes in ([rng.randrange(1, 51) for _ in range(10_000)], [int(10 ** (9 * rng.random())) for _ in range(5000)]):
        begin = time.time()
        t = guarded.Ranges()
        assert not t.feed([guarded.TAKE] * len(takes), takes)
        assert time.time() - begin < 2
    begin = time.time()
    t = guarded.solver(0, 49)
    takes = [rng.randrange(1, 51) for _ in range(300_000)]
    assert t.feed([guarded.TAKE] * len(takes), takes) and len(t.table()[0]) <= 50 and time.time() - begin < 5


def folded(spark, deltas, start, parts, **kw):
    """(accepted, balance) of one key's rows in order, from the distributed fold; a few other keys beside it."""
    n = len(deltas)
    seq = spark.createDataFrame(__import__("pandas").DataFrame({"k": np.where(np.arange(n + 40) < n, 7, np.arange(n + 40) % 9 + 100),
                                                               "seq": np.arange(n + 40), "d": np.append(deltas, [-1] * 40)}))
    df = seq.withColumn("s", F.lit(start).cast("long"))
    out = guarded.guarded_fold(df, ["k"], ["seq"], "d", "s", num_partitions=parts, keep=["seq"], **kw).filter("k = 7").orderBy("seq").toPandas()
    assert out.seq.tolist() == list(range(n))
    return out.accepted.tolist(), out.balance_after.tolist()


@pytest.mark.parametrize("kind", ["small", "log_uniform", "walk", "plenty", "large_walk"])
def test_a_hot_key_whatever_its_requests(spark, kind):
    rng = np.random.default_rng(11)
    n, start = 40_000, 5000
    if kind == "small":
        deltas = -rng.integers(1, 51, n)
    elif kind == "log_uniform":
        deltas, start = -(10 ** (9 * rng.random(n))).astype(np.int64), 3 * 10**9
    elif kind == "walk":
        deltas = rng.integers(-50, 51, n)
    elif kind == "plenty":
        deltas, start = -rng.integers(1, 51, n), 10**7
    else:
        deltas = rng.integers(-10**9, 10**9, n)
    assert folded(spark, deltas, start, 9) == fold_rows(deltas.tolist(), [True] * n, start)


def test_keys_that_stay_open_are_folded_in_order(spark, monkeypatch):
    monkeypatch.setattr(guarded, "ROUNDS", 0)
    monkeypatch.setattr(guarded, "BROADCAST_ROWS", 0)  # the start balances meet the rows in a shuffle
    deltas = np.random.default_rng(5).integers(-10**9, 10**9, 5000)
    assert folded(spark, deltas, 100, 6) == fold_rows(deltas.tolist(), [True] * 5000, 100)


def test_a_million_takes_of_one_key(spark, monkeypatch):
    """In a fixed number of passes; the balance runs out after a few chunks."""
    df = spark.range(1_000_000).select(F.lit(1).alias("warehouse_id"), F.lit(1).alias("product_id"), F.col("id").alias("seq"),
                                       (1 + F.pmod(F.xxhash64("id"), F.lit(50))).alias("quantity"))
    stock = spark.createDataFrame([(1, 1, 9_000_000)], "warehouse_id int, product_id int, quantity long")
    cut = guarded.ordered_partitions
    monkeypatch.setattr(guarded, "ordered_partitions", lambda df, n=None: cut(df, 12))
    out = inv.settle(stock, df, ["seq"]).select("seq", "quantity", "accepted", "balance_after").toPandas().sort_values("seq")
    b, ok, bal = 9_000_000, [], []
    for q in out.quantity.tolist():
        ok.append(b >= q)
        b -= q if b >= q else 0
        bal.append(b)
    assert out.accepted.tolist() == ok and out.balance_after.tolist() == bal and 0 < sum(ok) < 1_000_000


def test_null_and_negative_quantities_are_rejected(spark):
    stock = spark.createDataFrame([(1, 1, 5)], "warehouse_id long, product_id long, quantity long")
    req = spark.createDataFrame([(1, 1, 1, -20), (2, 1, 1, None), (3, 1, 1, 4), (4, 1, 1, 0), (5, 1, 1, 2), (6, 9, 9, -1), (7, 9, 9, None)],
                                "seq int, warehouse_id long, product_id long, quantity long")
    out = {r.seq: (r.accepted, r.balance_after) for r in inv.settle(stock, req, ["seq"]).collect()}
    assert out == {1: (False, 5), 2: (False, 5), 3: (True, 1), 4: (True, 1), 5: (False, 1), 6: (False, 0), 7: (False, 0)}
    assert inv.settle(stock, req.filter("seq < 0"), ["seq"]).count() == 0
    assert [r.accepted for r in inv.settle(stock.limit(0), req, ["seq"]).collect()] == [False] * 7


def test_requests_are_not_joined_to_the_stock_before_the_cut(spark, monkeypatch):
    """The plan that is cut holds the rows of both, and no join."""
    seen = []
    cut = guarded.ordered_partitions
    monkeypatch.setattr(guarded, "ordered_partitions", lambda df, n=None: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df, n))
    stock = spark.range(5).select(F.lit(1).alias("warehouse_id"), F.col("id").alias("product_id"), F.lit(3).alias("quantity"))
    req = spark.range(50).select(F.lit(1).alias("warehouse_id"), (F.col("id") % 6).alias("product_id"), F.col("id").alias("seq"), F.lit(1).alias("quantity"))
    assert inv.settle(stock, req, ["seq"]).filter("accepted").count() == 15
    assert len(seen) == 1 and "Join" not in seen[0] and "Union" in seen[0]


def test_invalid_quantities_in_carts(spark):
    import datetime as dt
    at = dt.datetime(2026, 6, 20)
    log = spark.createDataFrame([(1, 1, "reserve", 3), (2, 1, "reserve", -5), (3, 1, "cancel", None), (4, 1, "cancel", -1), (5, 1, "confirm", 3)],
                                "event_id long, user_id long, action string, quantity long").select(
        "*", F.lit(0).alias("warehouse_id"), F.lit(1).alias("product_id"), F.lit(at).cast("timestamp_ntz").alias("ts"), F.lit(60).alias("ttl"))
    out = inv.apply_cancels(inv.assign_carts(log)).orderBy("event_id").collect()
    assert [(r.outcome, r.line_after) for r in out] == [("reserved", 3), ("refused_invalid", 3), ("refused_invalid", 3),
                                                        ("refused_invalid", 3), ("confirmed", 0)]
