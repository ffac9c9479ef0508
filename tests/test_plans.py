"""Plan checks: filters and column pruning reach the scan, partitions are pruned, heavy
queries scan their fact table once, dictionaries are broadcast, top-k stays a top-k."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tidemark.operators import activity as act
from tidemark.operators import workqueue as wq
from tidemark.plans import load_all
from tidemark.plans.layouts import four_layouts
from tidemark.sources import driver as src

QUERIES, _ = load_all()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_j01_pushdown_and_pruning(spark):
    p = plan(QUERIES["j01_top_clients"](spark, SF01))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-01T00:00)" in p
    assert "EqualTo(p_type,ECONOMY)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in p
    assert "TakeOrderedAndProject" in p


def test_layout_partition_pruning(spark):
    paths = four_layouts(spark, SF01)
    daily = act.range_activity(spark.read.parquet(paths["events_daily_userid"]), "2024-01-10", "2024-01-13",
                               date_col="event_date")
    monthly = act.range_activity(spark.read.parquet(paths["events_monthly_ts"]), "2024-01-10", "2024-01-13",
                                 date_col="event_month", grain="month")
    pd_ = plan(daily)
    assert "PartitionFilters: [isnotnull(event_date" in pd_ and "(event_date#" in pd_
    assert "PartitionFilters: [isnotnull(event_month" in plan(monthly)


def test_u04_scans_events_once(spark):
    p = plan(QUERIES["u04_dau_wau_mau"](spark, SF01))
    assert p.count("FileScan parquet") == 1


def test_u11_and_u08_scan_events_once(spark):
    assert plan(QUERIES["u11_peak_hours"](spark, SF01)).count("FileScan parquet") == 1
    assert plan(QUERIES["u08_event_mix"](spark, SF01)).count("FileScan parquet") == 1


def test_nation_is_broadcast(spark):
    p = plan(src.user_countries(spark, SF01))
    assert "BroadcastExchange" in p


def test_bounded_claims_are_a_top_k(spark):
    p = plan(wq.claim_batch(src.jobs(spark, SF01), 2, 50))
    assert "TakeOrderedAndProject" in p


def test_top_users_has_no_expand(spark):
    """Three distinct counts are computed level by level, not through an Expand."""
    p = plan(act.top_users(src.activity_events(spark, SF01)))
    assert "Expand" not in p


def test_activity_adapter_prunes_columns(spark):
    df = src.activity_events(spark, SF01).select("ts").filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p
    assert "GreaterThanOrEqual(ts," in p


def test_u07_retention_shuffles_the_events_once(spark):
    """Per-user week sets: one exchange on the user, one small one on the cohort; the only sort is that
    of the finished report (one row per cohort)."""
    p = plan(QUERIES["u07_retention"](spark, SF01))
    assert p.count("Exchange hashpartitioning") == 2
    assert "Window" not in p and p.count("Sort [") == 1 and p.count("Exchange SinglePartition") == 1 and "rangepartitioning" not in p
    assert "Sort [cohort_week" in p


@pytest.mark.parametrize("name, columns", [
    ("u05_hourly_profile", [("hour", 1)]), ("u07_retention", [("cohort_week", 1)]),
    ("u08_event_mix", [("events", -1)]), ("u09_country_mix", [("events", -1)]),
    ("u10_device_conversion", [("events", -1)]), ("u12_weekday_load", [("day_num", 1)])])
def test_reports_come_out_sorted(spark, name, columns):
    rows = QUERIES[name](spark, SF01).collect()
    (column, way), = columns
    values = [r[column] for r in rows]
    assert len(values) > 1 and values == sorted(values, reverse=way < 0)


def test_shared_file_write_reads_back(spark):
    import os

    from tidemark.session import scratch_path, write_shared_file

    path = os.path.join(scratch_path(spark, "bytes"), "deep", "blob.bin")
    data = bytes(range(256)) * 10
    write_shared_file(spark, path, data)
    with open(path, "rb") as f:
        assert f.read() == data


def test_layouts_are_cut_by_the_bytes_that_a_task_sorts(spark, tmp_path, monkeypatch):
    from tidemark.sources import layout as lay

    raw = str(tmp_path / "raw")
    spark.range(3000).selectExpr("id AS user_id", "timestamp_seconds(1704067200 + id)::timestamp_ntz AS ts").write.parquet(raw)
    df = spark.read.parquet(raw)
    monkeypatch.setattr(lay, "SORT_BYTES", 400)
    path = lay.write_layout(df, str(tmp_path / "out"))
    files = lay._files(spark, path).collect()
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions")) and all(f.path.endswith(".zstd.parquet") for f in files)
    assert spark.read.parquet(path).agg({"user_id": "sum"}).first()[0] == 3000 * 2999 // 2


def test_no_sketch_is_kept_for_each_user(spark, tmp_path):
    import re

    from pyspark.sql import functions as F
    from tidemark.plans import load_all

    ev = spark.range(400).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
                                 (F.col("id") % 7).alias("user_id"), F.when(F.col("id") % 3 > 0, F.lit("click")).alias("event_type"),
                                 F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    out = load_all()[0]["a04_users_exact_vs_approx"](spark, str(tmp_path))
    assert sorted(map(tuple, out.collect()), key=repr) == [("click", 7, True), (None, 7, True)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    keys = re.findall(r"keys=\[([^\]]*)\], functions=\[[^\n]*approx_count_distinct", plan)
    assert keys and not any("user_key" in k for k in keys)
