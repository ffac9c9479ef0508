"""Streams equal their batch forms when data arrives over several triggers, in time order."""

import datetime as dt
import os
import time
import uuid

from pyspark.sql import functions as F

from conftest import SF001
from tidemark.operators import activity as act
from tidemark.operators import inventory as inv
from tidemark.session import scratch_path
from tidemark.sources import driver as src
from tidemark.streaming import jobs, microbatch
from tidemark.streaming import streams as st
from tidemark.streaming.microbatch import run_event_time


_arrived: list[str] = []  # folders of the sources, the last one last


def _arrive_in_order(spark, df, ts_col, cuts):
    """Write the source as separate files, one per time slice, oldest first."""
    path = os.path.join(scratch_path(spark, "arrive"), "source")
    _arrived.append(path)
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = df
        if lo is not None:
            part = part.filter(F.col(ts_col) >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            part = part.filter(F.col(ts_col) < F.lit(hi).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # distinct modification times order the file source
    return st.read_source(spark, path, df.schema, files_per_trigger=1)


def test_ingest_dedupes_across_triggers(spark):
    ev = src.inventory_events(spark, SF001).drop("metadata", "delivery")
    stream = _arrive_in_order(spark, ev, "timestamp", ["1997-01-01", "1999-01-01"])
    out = st.run_append(spark, st.ingest_events(stream), f"t-{uuid.uuid4().hex[:6]}")
    assert out.count() == ev.select("event_id").distinct().count()
    assert out.groupBy("event_id").count().filter("count > 1").count() == 0


def _split(df, cut, late_every):
    """``df`` without some of its rows before ``cut``, and those rows (they come too late)."""
    late = (F.col("ts") < F.lit(cut).cast("timestamp_ntz")) & (F.pmod(F.xxhash64(*df.columns), F.lit(late_every)) == 0)
    return df.filter(~late), df.filter(late)


def _rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def _run(spark, df, job, cuts, delay, late=None, span_seconds=86_400):
    """Results of ``df`` arriving in order; then ``late``, after everything else."""
    stream = _arrive_in_order(spark, df, "ts", cuts)
    path = _arrived[-1]
    name = f"t-{uuid.uuid4().hex[:6]}"
    later = [lambda: late.coalesce(1).write.mode("append").parquet(path)] if late is not None else []
    return run_event_time(spark, stream, job, name, *later, delay=delay, span_seconds=span_seconds)


def test_sessions_late_rows_and_waiting_rows(spark):
    """Over four triggers: sessions equal the batch form of the rows in time, late rows come out as such, and
    rows in sessions + late rows + rows after the horizon are all rows."""
    ev = src.activity_events(spark, SF001).select("user_id", "ts", "event_id")
    in_time, late = _split(ev, "2024-01-12", 20)
    got = _run(spark, in_time, jobs.sessions_job(), ["2024-01-10", "2024-01-20"], "1 hour", late)
    closed = in_time.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    cols = ["user_id", "session_start", "session_end", "events"]
    whole = act.sessions(in_time, "30 minutes")
    exp = whole.filter(F.col("session_end") <= F.lit(closed))
    assert _rows(got.output, cols) == _rows(exp, cols) and exp.count() > 0
    assert _rows(got.late, ev.columns) == _rows(late, ev.columns) and late.count() > 0
    still = whole.filter(F.col("session_end") > F.lit(closed)).agg(F.sum("events")).first()[0] or 0
    assert got.output.agg(F.sum("events")).first()[0] + got.late.count() + still == ev.count()


def test_carts_over_triggers_with_late_rows(spark):
    log = src.cart_log(spark, SF001)
    in_time, late = _split(log, "2024-01-12", 20)
    got = _run(spark, in_time, jobs.carts_job(), ["2024-01-10", "2024-01-20"], "1 hour", late)
    assigned = inv.assign_carts(in_time)
    lines = inv.cart_lines(inv.apply_cancels(assigned), inv.carts(assigned, "2024-01-31"))
    exp = lines.filter(F.col("expires_at") <= F.lit(in_time.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)))
    cols = ["user_id", "cart_no", "warehouse_id", "product_id", "units", "expires_at"]
    assert _rows(got.output, cols) == _rows(exp, cols) and exp.count() > 0
    assert _rows(got.late, log.columns) == _rows(late, log.columns) and late.count() > 0


def test_settle_over_triggers_with_late_rows_and_rows_without_a_time(spark):
    order = ["ts", "order_id", "line_no", "supplier_id", "quantity"]
    reqs = src.stock_requests(spark, SF001).select("product_id", "warehouse_id", *order)
    stock = src.warehouse_stock(spark, SF001).filter("product_id % 10 <> 0")  # some keys have no stock row
    in_time, late = _split(reqs, "1996-01-01", 20)
    late = late.unionByName(reqs.limit(3).withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    got = _run(spark, in_time, jobs.settle_job(stock, reqs.schema, order), ["1995-01-01", "1998-01-01"], "1 day", late, 90 * 86_400)
    closed = in_time.agg(F.max("ts")).first()[0] - dt.timedelta(days=1)
    exp = inv.settle(stock, in_time, order).filter(F.col("ts") <= F.lit(closed))
    cols = ["warehouse_id", "product_id", *order, "accepted", "balance_after"]
    a = _rows(got.output, cols)
    assert a == _rows(exp, cols) and any(not r[-2] and r[-1] == 0 for r in a)
    assert _rows(got.late, reqs.columns) == _rows(late, reqs.columns)
    waiting = in_time.filter(F.col("ts") > F.lit(closed)).count()
    assert len(a) + got.late.count() + waiting == reqs.count() + 3


def _tables(spark, job, schema, delay="1 day", span=86_400):
    return microbatch._Tables(spark, scratch_path(spark, "tables"), job, schema, delay, span)


def test_a_retried_batch_changes_nothing_and_done_folders_go(spark, monkeypatch):
    """Batch 1 runs twice; old waiting folders, states and marks are removed, and the result is that of the
    batch form."""
    monkeypatch.setattr(microbatch, "COPY_EVERY", 2)
    order = ["ts", "order_id"]
    stock = spark.createDataFrame([(0, 1, 20)], "warehouse_id long, product_id long, quantity long")
    day = dt.datetime(2026, 6, 1)
    rows = [(0, 1 + i % 2, day + dt.timedelta(hours=6 * i), i, 1 + i % 4) for i in range(48)]
    reqs = spark.createDataFrame(rows, "warehouse_id long, product_id long, ts timestamp_ntz, order_id long, quantity long")
    t = _tables(spark, jobs.settle_job(stock, reqs.schema, order), reqs.schema)
    parts = [reqs.filter(F.col("order_id").between(8 * k, 8 * k + 7)) for k in range(6)]
    for k, part in enumerate(parts):
        t.run(part, k)
        if k == 1:
            t.run(part, k)
    out = spark.read.parquet(t.at("output")).drop("_batch")
    exp = inv.settle(stock, reqs, order).filter(F.col("ts") <= F.lit(day + dt.timedelta(hours=6 * 47 - 24)))
    assert _rows(out, exp.columns) == _rows(exp, exp.columns)
    assert spark.read.parquet(t.at("late")).count() == 0
    assert len(t.spans()) <= 5 and len(t.batches("state", 99)) <= 3 and len(t.batches("copies", 99)) <= 2


def test_a_trigger_reads_only_the_folders_that_are_due(spark):
    """However many rows wait for later days."""
    stock = spark.createDataFrame([(0, 1, 20)], "warehouse_id long, product_id long, quantity long")
    schema = "warehouse_id long, product_id long, ts timestamp_ntz, order_id long, quantity long"
    day = dt.datetime(2026, 6, 1)
    reqs = spark.createDataFrame([(0, 1, day + dt.timedelta(days=i), i, 1) for i in range(40)], schema)
    t = _tables(spark, jobs.settle_job(stock, reqs.schema, ["ts", "order_id"]), reqs.schema, delay="35 days")
    t.run(reqs, 0)
    assert len(t.spans()) == 40
    after = t.newest(1) - t.delay
    due = t.due(after, after + 2 * 86_400_000_000, 1)
    assert len({f.split("_span=")[1].split("/")[0] for f in due.inputFiles()}) == 3 and due.count() == 2


def test_rollup_stream_merges_with_a_batch_rollup_and_keeps_late_rows(spark, monkeypatch):
    """The first events as a stream whose arrivals are out of order, the others as a batch rollup: merged they
    are the rollup of all events, users within 2%."""
    monkeypatch.setattr(st, "MERGE_EVERY", 2)
    ev = src.activity_events(spark, SF001, with_country=True)
    first = F.col("event_type").isin("click", "view")
    stream = _arrive_in_order(spark, ev.filter(first & (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))), "ts", ["2024-01-20"])
    path = _arrived[-1]
    old = ev.filter(first & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")))
    got = st.run_rollup(spark, stream, f"t-{uuid.uuid4().hex[:6]}", lambda: old.coalesce(1).write.mode("append").parquet(path))
    merged = act.rollup_estimates(act.merge_rollups(got, act.daily_rollup(ev.filter(~first), sketch=True)))
    exact = act.daily_rollup(ev)
    j = merged.join(exact.withColumnsRenamed({"event_count": "_n", "total_duration": "_d", "total_value": "_v"}), ["day", "country", "device_type"])
    bad = j.filter((F.abs(F.col("unique_users_est") - F.col("unique_users")) > F.greatest(F.lit(1), F.col("unique_users") * 0.02))
                   | (F.col("event_count") != F.col("_n")) | (F.col("total_duration") != F.col("_d")) | (F.col("total_value") != F.col("_v")))
    assert j.count() == exact.count() == merged.count() and bad.count() == 0


def test_ingest_reads_the_ids_of_its_own_days_only(spark, monkeypatch):
    """Twelve arrivals, each a new day and copies of the day before: a batch opens the files of two days."""
    seen = []
    stored = st.stored_ids

    def spy(*args):
        out = stored(*args)
        seen.append(0 if out is None else len({f.split("_from=")[1].split("/")[0] for f in out.inputFiles()}))
        return out

    monkeypatch.setattr(st, "stored_ids", spy)
    day = dt.datetime(2026, 6, 1)
    rows = [(f"e{k}-{i}", day + dt.timedelta(days=k, hours=i), 0) for k in range(12) for i in range(5)]
    schema = "event_id string, timestamp timestamp_ntz, delivery int"
    path = os.path.join(scratch_path(spark, "ids"), "source")

    def arrive(k):
        own = [r for r in rows if r[1].date() == (day + dt.timedelta(days=k)).date()]
        again = [(i, t, 1) for i, t, _ in rows if t.date() == (day + dt.timedelta(days=k - 1)).date()]
        spark.createDataFrame(own + again, schema).coalesce(1).write.mode("append").parquet(path)

    arrive(0)
    stream = st.read_source(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=None)
    out = st.run_ingest(spark, stream, f"t-{uuid.uuid4().hex[:6]}", *[lambda k=k: arrive(k) for k in range(1, 12)])
    assert sorted(r.event_id for r in out.collect()) == sorted(r[0] for r in rows)
    assert out.columns == ["event_id", "timestamp", "delivery"] and len(seen) == 12 and max(seen) <= 2


def test_rollup_sketch_merge_close_to_exact(spark):
    ev = src.activity_events(spark, SF001, with_country=True)
    first = F.col("event_type").isin("click", "view")
    merged = act.rollup_estimates(act.merge_rollups(act.daily_rollup(ev.filter(first), sketch=True),
                                                    act.daily_rollup(ev.filter(~first), sketch=True)))
    exact = act.daily_rollup(ev)
    j = merged.join(exact, ["day", "country", "device_type"])
    bad = j.filter(F.abs(F.col("unique_users_est") - F.col("unique_users")) > F.greatest(F.lit(1), F.col("unique_users") * 0.02))
    assert j.count() == exact.count() and bad.count() == 0


def test_units_of_cart_lines_judge_only_lines_with_a_cancel_or_a_confirm(spark, monkeypatch):
    """Null users, products and quantities, cancels of too much; the units are those of the row-by-row form."""
    day = dt.datetime(2026, 6, 1)
    rows = [(u, 1, 0, p, "reserve", q, day + dt.timedelta(minutes=p or 0), 10 * i + j)
            for i, u in enumerate([1, 2, None]) for j, (p, q) in enumerate([(1, 2), (1, 3), (2, None), (3, -1), (None, 4), (4, 0)])]
    rows += [(2, 1, 0, 1, "cancel", 2, day + dt.timedelta(hours=1), 90), (2, 1, 0, 1, "confirm", 9, day + dt.timedelta(hours=2), 91),
             (None, 1, 0, None, "cancel", 4, day + dt.timedelta(hours=1), 92), (1, None, 0, 1, "cancel", 1, day, 93)]
    assigned = spark.createDataFrame(rows, "user_id long, cart_no long, warehouse_id long, product_id long, action string, "
                                           "quantity long, ts timestamp_ntz, event_id long")
    keys = ["user_id", "cart_no", "warehouse_id", "product_id"]
    exp = inv.apply_cancels(assigned).filter("cart_no IS NOT NULL").groupBy(*keys).agg(
        F.max_by("line_after", F.struct("ts", "event_id")).alias("units"))
    exp = _rows(exp, [*keys, "units"])
    fold, folded = inv.guarded_fold, []
    monkeypatch.setattr(inv, "guarded_fold", lambda df, *a, **k: folded.append(df.count()) or fold(df, *a, **k))
    assert _rows(inv.cart_line_units(assigned), [*keys, "units"]) == exp and len(exp) == 15
    assert folded == [6]


def test_settle_writes_its_rows_once(spark, monkeypatch):
    """Beside the output a trigger writes keys and start balances only."""
    stock = spark.createDataFrame([(0, 1, 20), (0, 2, 5)], "warehouse_id long, product_id long, quantity long")
    schema = "warehouse_id long, product_id long, ts timestamp_ntz, order_id long, quantity long"
    day = dt.datetime(2026, 6, 1)
    reqs = spark.createDataFrame([(0, 1 + i % 3, day + dt.timedelta(hours=i), i, 1) for i in range(60)], schema)
    keep, written = jobs.saved, []
    monkeypatch.setattr(jobs, "saved", lambda df, name: written.append(keep(df, name)) or written[-1])
    t = _tables(spark, jobs.settle_job(stock, reqs.schema, ["ts", "order_id"]), reqs.schema, delay="1 hour")
    for k in range(2):
        t.run(reqs.filter(F.col("order_id").between(30 * k, 30 * k + 29)), k)
    out = spark.read.parquet(t.at("output")).drop("_batch")
    exp = inv.settle(stock, reqs, ["ts", "order_id"]).filter("order_id < 59")
    assert _rows(out, exp.columns) == _rows(exp, exp.columns)
    assert sum(w.count() for w in written) <= 2 * (3 + 2)
