"""Contracts on read, reports from footers, replay from a snapshot, ranks deep in an order."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, SF01
from tidemark.operators import commerce
from tidemark.operators import inventory as inv
from tidemark.plans import ranking
from tidemark.plans.layouts import four_layouts
from tidemark.session import scratch_path
from tidemark.sources import contracts
from tidemark.sources import driver as src
from tidemark.sources import layout as lay


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_line_is_a_row_or_a_reject(spark):
    lines = ["1,10,2026-01-02,new,5.25", "2,,2026-01-02,,", " 3 ,x,soon,lost,-1", ",10,2026-01-02,new,1", "4,10,2026-01-02,paid", "5,1,2026-01-02,done,1,more",
             "6,10,2026-01-02 03:04:05,shipped,99999999999.00", "7,99999999999999999999,,paid,0"]
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = contracts.read_text(spark, path, "orders")
    rows = {r.id: tuple(r)[1:] for r in got.rows.collect()}
    assert got.rows.schema.simpleString() == contracts.contract("orders").simpleString()
    assert {k: (v[0], v[2], None if v[3] is None else float(v[3])) for k, v in rows.items()} == {1: (10, "new", 5.25), 2: (None, "new", None)}
    assert rows[1][1] == dt.datetime(2026, 1, 2)
    faults = sorted(tuple(r.faults) for r in got.rejects.collect())
    assert faults == sorted([
        ("client_id: not a bigint", "order_date: not a timestamp_ntz", "status: not allowed", "total_amount: not allowed"), ("id: missing",),
        ("line: malformed",), ("line: malformed",), ("total_amount: not a decimal(12,2)",), ("client_id: not a bigint",)])
    assert len(rows) + len(faults) == len(lines)
    assert "raw" not in got.rejects.columns and "id" in got.rejects.columns


def test_typed_rows_against_a_contract(spark):
    raw = spark.createDataFrame([(1, 2, 3, 4, None, None), (2, 2, 3, 0, 1.0, 5.0), (3, 2, 3, 1, 1.0, 200.0), (4, 2, 3, 1, 2.5, None)],
                                "id int, order_id int, product_id int, quantity int, unit_price double, discount double")
    got = contracts.checked(raw.withColumn("extra", F.lit("x")), "order_items")
    assert [(r.id, float(r.unit_price), float(r.discount)) for r in got.rows.collect()] == [(4, 2.5, 0.0)]
    assert {r.id: r.faults for r in got.rejects.collect()} == {1: ["unit_price: missing"], 2: ["quantity: not allowed"], 3: ["discount: not allowed"]}
    assert contracts.checked(raw.limit(0), "order_items").rows.count() == 0


def test_reports_read_no_rows(spark):
    paths = four_layouts(spark, SF01)
    path = paths["events_daily_userid"]
    report = lay.partition_report(spark, path)
    p = plan(report)
    assert "PushedAggregation: [COUNT(*)]" in p and "PushedGroupBy: [event_date]" in p and "binaryFile" in p.replace("BinaryFile", "binaryFile")
    df = spark.read.parquet(path)
    want = {r.event_date: (r.n, r.f, r.b) for r in df.select("event_date", "_metadata.file_path", "_metadata.file_size").groupBy("event_date", "file_path")
            .agg(F.count(F.lit(1)).alias("n"), F.first("file_size").alias("b")).groupBy("event_date")
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("f"), F.sum("b").alias("b")).collect()}
    assert {r.event_date: (r.rows, r.files, r.bytes) for r in report.collect()} == want
    total = {r.table_name: r for r in lay.layout_report(spark, paths).collect()}["events_daily_userid"]
    assert (total.total_rows, total.total_bytes, total.partition_count) == (sum(w[0] for w in want.values()), sum(w[2] for w in want.values()), len(want))


def test_replay_reads_only_later_months(spark):
    """Redeliveries across the snapshot count once; the earlier partitions are not read."""
    log = lay.write_layout(src.inventory_events(spark, SF001).drop("metadata"), scratch_path(spark, "log"), "month", ("timestamp",), ts_col="timestamp")
    events = spark.read.parquet(log)
    stock = src.warehouse_stock(spark, SF001)
    snapshot = inv.stock_snapshot(stock, events, "1997-03-10")
    replay = inv.replay_stock(snapshot, events, "1997-03-10", date_col="event_month")
    want = inv.project_stock(stock, inv.append_events(None, events))
    assert replay.exceptAll(want).isEmpty() and want.exceptAll(replay).isEmpty()
    only = inv.replay_stock(stock, events, "1997-03-10", date_col="event_month")
    assert "PartitionFilters: [isnotnull(event_month" in plan(only)


def test_deep_pages_and_large_claims_go_by_partition_counts(spark, monkeypatch):
    """Same rows as sorting and skipping; no unpartitioned window and no offset over the skipped rows."""
    df = spark.range(5000).select("id", F.pmod(F.xxhash64("id"), F.lit(97)).alias("created_at"), F.array(F.lit("a")).alias("tags"))
    want = df.orderBy(F.desc("created_at"), "id").offset(3000).limit(20).collect()
    monkeypatch.setattr(ranking, "TOP_ROWS", 100)
    monkeypatch.setattr(commerce, "TOP_ROWS", 100)
    items, total = commerce.page(df, skip=3000, limit=20)
    assert items.collect() == want and total.first()[0] == 5000
    p = plan(items)
    assert "Offset" not in p and "GlobalLimit" not in p
    ranked = ranking.first_k_ranked(df, [F.desc("created_at"), F.asc("id")], 1500)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 1501))
    assert [r.id for r in ranked.orderBy("rank").collect()] == [r.id for r in df.orderBy(F.desc("created_at"), "id").limit(1500).collect()]
