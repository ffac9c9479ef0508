"""The chunked ordered scans: exact against a plain sequential fold, also when one key holds a
third of the rows and spans several range partitions."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF001, SF01
from tidemark.operators import inventory as inv
from tidemark.plans.chunked import running_sum
from tidemark.plans.guarded import guarded_fold
from tidemark.sources import driver as src


def brute_fold(pdf, keys, order, delta, start, consume=None):
    pdf = pdf.sort_values(keys + order, kind="stable")
    acc, bal = [], []
    for _, g in pdf.groupby(keys, sort=False):
        b = int(g[start].iloc[0])
        for _, r in g.iterrows():
            d = int(r[delta])
            c = True if consume is None else bool(r[consume])
            if d >= 0:
                b += d
                acc.append(True)
            elif b >= -d:
                if c:
                    b += d
                acc.append(True)
            else:
                acc.append(False)
            bal.append(b)
    out = pdf.copy()
    out["accepted"] = acc
    out["balance_after"] = bal
    return out


def _hot_requests(spark):
    r = src.stock_requests(spark, SF001).select("order_id", "line_no", "supplier_id", "product_id",
                                                 "warehouse_id", "quantity", "ts")
    # a third of the rows go to one (warehouse, product)
    hot = F.col("order_id") % 3 == 0
    r = r.withColumn("part", F.col("product_id")).withColumn("product_id", F.when(hot, F.lit(0)).otherwise(F.col("product_id"))) \
        .withColumn("warehouse_id", F.when(hot, F.lit(0)).otherwise(F.col("warehouse_id")))
    return r.withColumn("_delta", -F.col("quantity")).withColumn(
        "_start", F.when(hot, F.lit(5000)).otherwise(F.lit(60)).cast("long"))


def test_guarded_fold_hot_key_matches_sequential(spark):
    r = _hot_requests(spark)
    keys = ["warehouse_id", "product_id"]
    order = ["ts", "order_id", "line_no", "supplier_id"]
    got = guarded_fold(r, keys, order, "_delta", "_start", num_partitions=8).toPandas()
    exp = brute_fold(r.toPandas(), keys, order, "_delta", "_start")
    ids = ["order_id", "line_no", "supplier_id", "part", "quantity", "ts"]
    m = got.merge(exp, on=ids, suffixes=("", "_e"))
    assert len(m) == len(exp) == len(got)
    assert (m.accepted == m.accepted_e).all()
    assert (m.balance_after == m.balance_after_e).all()
    # the hot key really was split over partitions and both outcomes occur on it
    hot = m[(m.warehouse_id == 0) & (m.product_id == 0)]
    assert len(hot) > len(m) / 4
    assert hot.accepted.any() and (~hot.accepted).any()


def test_guarded_fold_with_adds_and_probes(spark):
    rows = []
    for i in range(400):
        d = [5, -3, -4, 2, -7, -1][i % 6]
        rows.append((1 if i % 5 else 2, i, d, i % 7 != 0, 3))
    df = spark.createDataFrame(rows, "k int, seq int, d long, c boolean, s long")
    got = guarded_fold(df, ["k"], ["seq"], "d", "s", consume_col="c", num_partitions=6).toPandas()
    exp = brute_fold(df.toPandas(), ["k"], ["seq"], "d", "s", "c")
    m = got.merge(exp, on=["k", "seq"], suffixes=("", "_e"))
    assert len(m) == 400
    assert (m.accepted == m.accepted_e).all() and (m.balance_after == m.balance_after_e).all()


def test_fixture_guarded_decrement(spark):
    stock = spark.createDataFrame([(1, 1, 10)], "warehouse_id long, product_id long, quantity long")
    req = spark.createDataFrame([(1, 1, 1, 6), (2, 1, 1, 7), (3, 1, 1, 4)],
                                "seq int, warehouse_id long, product_id long, quantity long")
    out = inv.settle(stock, req, ["seq"]).orderBy("seq").collect()
    assert [r.accepted for r in out] == [True, False, True]
    assert [r.balance_after for r in out] == [4, 4, 0]


def test_running_sum_hot_key(spark):
    rows = [(0 if i % 3 else i % 11, i, (i * 7) % 13 - 6) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, seq int, v long")
    got = running_sum(df, ["k"], ["seq"], "v", "run", num_partitions=8).toPandas()
    p = df.toPandas().sort_values(["k", "seq"])
    p["run_e"] = p.groupby("k")["v"].cumsum()
    m = got.merge(p, on=["k", "seq"])
    assert len(m) == 3000 and (m.run == m.run_e).all()


def _log(spark, rows):
    return spark.createDataFrame(
        [(i, u, p, a, q, dt.datetime(2026, 6, 20) + dt.timedelta(minutes=m), ttl, 0)
         for i, (u, p, a, q, m, ttl) in enumerate(rows)],
        "event_id long, user_id long, product_id long, action string, quantity long, ts timestamp_ntz, ttl int, warehouse_id long")


def test_cart_ttl_boundary_is_new_cart(spark):
    log = _log(spark, [(1, 1, "reserve", 1, 0, 900), (1, 1, "reserve", 1, 15, 900)])
    out = inv.assign_carts(log).orderBy("event_id").collect()
    assert [r.cart_no for r in out] == [1, 2]


def test_cart_shorter_ttl_replaces_expiry(spark):
    log = _log(spark, [(1, 1, "reserve", 1, 0, 3600), (1, 1, "reserve", 1, 10, 300), (1, 1, "reserve", 1, 30, 300)])
    out = inv.assign_carts(log).orderBy("event_id").collect()
    assert [r.cart_no for r in out] == [1, 1, 2]


def test_cancels_refused_and_lines(spark):
    log = _log(spark, [(1, 1, "reserve", 3, 0, 3600), (1, 1, "cancel", 5, 1, 0), (1, 1, "cancel", 2, 2, 0),
                       (1, 1, "cancel", 1, 120, 0)])
    a = inv.assign_carts(log)
    c = inv.apply_cancels(a).orderBy("event_id").collect()
    assert [r.outcome for r in c] == ["reserved", "refused_exceeds", "cancelled", "refused_no_cart"]
    assert [r.line_after for r in c][:3] == [3, 3, 1]


def test_confirm_clears_the_reservation(spark):
    log = _log(spark, [(1, 1, "reserve", 3, 0, 3600), (1, 1, "confirm", 3, 1, 0), (1, 1, "confirm", 1, 2, 0),
                       (2, 1, "reserve", 4, 0, 3600), (2, 1, "cancel", 1, 1, 0), (2, 1, "confirm", 1, 2, 0),
                       (3, 1, "confirm", 1, 0, 0)])
    a = inv.assign_carts(log)
    c = inv.apply_cancels(a)
    assert [r.outcome for r in c.orderBy("event_id").collect()] == [
        "reserved", "confirmed", "confirmed_unreserved", "reserved", "cancelled", "confirmed", "confirmed_unreserved"]
    lines = inv.cart_lines(c, inv.carts(a, "2026-06-20 00:30:00"))
    assert [(r.user_id, r.units) for r in lines.collect()] == [(2, 2)]
    assert [tuple(r) for r in inv.reserved_totals(lines).collect()] == [(0, 1, 2)]
    back = inv.returned_stock(c, inv.cart_lines(c, inv.carts(a, "2026-06-20 02:00:00"))).collect()
    assert [tuple(r) for r in back] == [(0, 1, 1, 2)]


def test_carts_hot_user_matches_window_form(spark):
    """All users' cart actions folded into few users; the chunked form equals lag + running sum."""
    log = src.cart_log(spark, SF001).withColumn("user_id", F.col("user_id") % 2)
    got = inv.assign_carts(log).filter("action = 'reserve'").select("event_id", "cart_no").toPandas()
    p = log.filter("action = 'reserve'").toPandas().sort_values(["user_id", "ts", "event_id"])
    p["exp"] = p.ts + pd.to_timedelta(p.ttl, unit="s")
    prev = p.groupby("user_id")["exp"].shift(1)
    p["flag"] = (prev.isna() | (p.ts >= prev)).astype(int)
    p["cart_e"] = p.groupby("user_id")["flag"].cumsum()
    m = got.merge(p[["event_id", "cart_e"]], on="event_id")
    assert len(m) == len(p) and (m.cart_no == m.cart_e).all()


def test_run_numbers_hot_key(spark):
    from tidemark.plans.chunked import run_numbers

    rows = [(0 if i % 4 else 1, i, (i // 7) % 2 == 0 or i % 13 == 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, seq int, ok boolean")
    got = run_numbers(df, ["k"], ["seq"], "ok", num_partitions=8).toPandas()
    p = df.toPandas().sort_values(["k", "seq"])
    prev = p.groupby("k")["ok"].shift(1)
    p["flag"] = (prev.isna() | (p.ok != prev)).astype(int)
    p["run_e"] = p.groupby("k")["flag"].cumsum()
    m = got.merge(p, on=["k", "seq"])
    assert len(m) == 4000 and (m.run_no == m.run_e).all()


def test_gap_sessions_hot_user_matches_lag_form(spark):
    from tidemark.plans.chunked import gap_sessions

    ev = src.activity_events(spark, SF001).select(
        (F.col("user_id") % 2).alias("user_id"), "ts", "event_id")  # two users hold everything
    got = gap_sessions(ev, ["user_id"], ["ts", "event_id"], "ts", 30 * 60 * 1_000_000, num_partitions=8) \
        .select("event_id", "session_no").toPandas()
    p = ev.toPandas().sort_values(["user_id", "ts", "event_id"])
    prev = p.groupby("user_id")["ts"].shift(1)
    p["flag"] = (prev.isna() | (p.ts - prev > pd.Timedelta(minutes=30))).astype(int)
    p["s_e"] = p.groupby("user_id")["flag"].cumsum()
    m = got.merge(p[["event_id", "s_e"]], on="event_id")
    assert len(m) == len(p) and (m.session_no == m.s_e).all()


def test_range_cut_follows_scanned_bytes_not_join_estimate(spark):
    """The settle input joins line items with stock rows built from an exploded series; the
    optimizer's estimate for it is thousands of times the input.  The cut must follow the
    scanned bytes, so a 1 MB input stays at the configured shuffle width."""
    from tidemark.session import range_partitions

    stock = src.warehouse_stock(spark, SF01)
    s = stock.select("warehouse_id", "product_id", F.col("quantity").alias("q0"))
    r = src.stock_requests(spark, SF01).join(s, ["warehouse_id", "product_id"])
    floor_n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(r) == floor_n


def test_guarded_fold_combine_streams_many_batches_of_one_key(spark):
    """The hot key spans 16 partitions and its edge summaries reach the combine two rows per
    Arrow batch: the streamed combine must carry the balance across batches, in partition order."""
    r = _hot_requests(spark)
    keys = ["warehouse_id", "product_id"]
    order = ["ts", "order_id", "line_no", "supplier_id"]
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "2")
    try:
        got = guarded_fold(r, keys, order, "_delta", "_start", num_partitions=16).toPandas()
    finally:
        spark.conf.set(conf, before)
    exp = brute_fold(r.toPandas(), keys, order, "_delta", "_start")
    ids = ["order_id", "line_no", "supplier_id", "part", "quantity", "ts"]
    m = got.merge(exp, on=ids, suffixes=("", "_e"))
    assert len(m) == len(exp) == len(got)
    assert (m.accepted == m.accepted_e).all()
    assert (m.balance_after == m.balance_after_e).all()


def test_null_and_large_keys_stay_apart(spark):
    """NULL keys form one group; keys and carried values above 2**53 stay exact next to NULLs."""
    from tidemark.plans.chunked import gap_sessions, run_numbers

    big = 9007199254740993
    rows = [([None, big, big - 1][i % 3], i, None if i % 5 == 0 else big + i, i % 4, dt.datetime(2026, 1, 1) + dt.timedelta(minutes=7 * i))
            for i in range(900)]
    df = spark.createDataFrame(rows, "k long, seq int, other long, v long, ts timestamp_ntz")
    p = df.toPandas()
    by = {k: [r for r in rows if r[0] == k] for k in (None, big, big - 1)}
    want_sum, want_run, want_session = {}, {}, {}
    for own in by.values():
        total, run, session, before = 0, 0, 0, None
        for r in own:
            total += r[3]
            run += before is None or before[3] != r[3]
            session += before is None or r[4] - before[4] > dt.timedelta(minutes=20)
            want_sum[r[1]], want_run[r[1]], want_session[r[1]], before = total, run, session, r
    for out, col, want in ((running_sum(df, ["k"], ["seq"], "v", "x", 7), "x", want_sum), (run_numbers(df, ["k"], ["seq"], "v", "x", 7), "x", want_run),
                           (gap_sessions(df, ["k"], ["seq"], "ts", 20 * 60 * 1_000_000, "x", 7), "x", want_session)):
        got = out.collect()
        assert {r["seq"]: r[col] for r in got} == want
        assert {(r["k"], r["seq"], r["other"]) for r in got} == {r[:3] for r in rows}
        assert "ArrowEvalPython" not in out._jdf.queryExecution().toString() and "MapIn" not in out._jdf.queryExecution().toString()
    folded = guarded_fold(df.withColumn("d", -F.col("v")).withColumn("s", F.lit(100).cast("long")), ["k"], ["seq"], "d", "s", num_partitions=7).collect()
    assert {(r["k"], r["seq"], r["other"]) for r in folded} == {r[:3] for r in rows}
    for own in by.values():
        b = 100
        for r in own:
            b -= r[3] if b >= r[3] else 0
            assert next(f["balance_after"] for f in folded if f["seq"] == r[1]) == b
    assert len(p) == len(folded)


def test_fold_pieces_equal_the_sequential_fold():
    import random
    import time

    import numpy as np

    from fold_helpers import apply_pieces, fold_pieces, fold_rows

    rng = random.Random(1)
    for _ in range(200):
        deltas = [rng.choice([-20, -5, -3, -2, -1, 0, 2, 7]) for _ in range(rng.randrange(1, 30))]
        consume = [rng.random() < 0.8 for _ in deltas]
        low, off = fold_pieces(np.array(deltas), np.array(consume))
        for b in range(-3, 60):
            assert apply_pieces(low, off, b) == fold_rows(deltas, consume, b)[1][-1]
    deltas = np.array([-rng.randrange(1, 30) for _ in range(2000)])
    start = time.time()
    low, off = fold_pieces(deltas, np.ones(2000, bool))
    assert len(low) <= 2 - deltas.sum() and time.time() - start < 20  # bounded by the demand, not by the stock
    for b in (10**9, 1234):
        assert apply_pieces(low, off, b) == fold_rows(deltas.tolist(), [True] * 2000, b)[1][-1]


def test_requests_without_stock_are_rejected(spark):
    stock = spark.createDataFrame([(1, 1, 10)], "warehouse_id long, product_id long, quantity long")
    req = spark.createDataFrame([(1, 1, 1, 4), (2, 1, 2, 1), (3, 2, 1, 0)], "seq int, warehouse_id long, product_id long, quantity long")
    out = {r["seq"]: (r["accepted"], r["balance_after"]) for r in inv.settle(stock, req, ["seq"]).collect()}
    assert out == {1: (True, 6), 2: (False, 0), 3: (False, 0)}


def test_range_cut_of_rows_without_files(spark):
    from tidemark.session import range_partitions

    floor_n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert range_partitions(spark.createDataFrame([(1,), (2,)], "a long")) == floor_n
    assert range_partitions(spark.sparkContext.parallelize([(1,), (2,)]).toDF("a long")) == floor_n


def test_patches_of_one_id_and_unknown_ids(spark):
    from tidemark.operators import tables as tb

    base = spark.createDataFrame([(1, "a", 1.0, None)], "id long, name string, price double, updated_at timestamp_ntz")
    patches = spark.createDataFrame([(1, "b", None, 1), (1, "c", None, 2), (1, None, 5.0, 1), (7, "x", None, 1), (1, None, None, 3)],
                                    "id long, name string, price double, patch_order int")
    new, rejected = tb.patch(base, patches, "id", "2026-01-01")
    assert [(r["id"], r["name"], r["price"]) for r in new.collect()] == [(1, "c", 5.0)]
    assert sorted((r["id"], r["reason"]) for r in rejected.collect()) == [(1, "empty"), (7, "unknown")]
