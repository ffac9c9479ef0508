"""Generators (S03-S06) and the small fixtures of the table operations."""

import duckdb
from pyspark.sql import functions as F

from tidemark.functions.numeric import seeded_int
from tidemark.operators import commerce, quality
from tidemark.operators import workqueue as wq
from tidemark.sources import generate as gen


def test_seeded_int_same_in_duckdb(spark):
    got = [r[0] for r in spark.range(5).select(seeded_int(7, F.col("id"))).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT ('0x' || substr(md5('7|{i}'), 1, 8))::BIGINT").fetchone()[0] for i in range(5)]
    assert got == exp


def test_shop_generators(spark):
    clients = gen.gen_clients(spark, 200)
    products = gen.gen_products(spark, 50)
    orders = gen.gen_orders(spark, 300, 200)
    items = gen.gen_order_items(orders, products, per_order=3)
    assert gen.series(spark, 1, 10).count() == 10
    assert quality.check_unique(clients, "email").count() == 0
    assert items.count() == 900
    assert quality.check_fk(items, products, "product_id", "id").count() == 0
    assert quality.check_fk(orders, clients, "client_id", "id").count() == 0
    bad_price = items.join(products.select(F.col("id").alias("product_id"), "price"), "product_id") \
        .filter(F.col("price") != F.col("unit_price"))
    assert bad_price.count() == 0
    q = items.agg(F.min("quantity"), F.max("quantity")).first()
    assert 1 <= q[0] and q[1] <= 6
    cats = {r[0] for r in products.select("category").distinct().collect()}
    assert cats == set(gen.CATEGORY_BY_MOD5)
    totals = commerce.order_totals(orders.drop("total_amount"), items.withColumn(
        "revenue", F.col("quantity") * F.col("unit_price") * (1 - F.col("discount") / 100)))
    assert totals.filter(F.col("total_amount") <= 0).count() == 0


def test_order_without_items_totals_zero(spark):
    orders = spark.createDataFrame([(1,), (2,)], "id long")
    items = spark.createDataFrame([(1, 5.0)], "order_id long, revenue double")
    out = {r.id: r.total_amount for r in commerce.order_totals(orders, items).collect()}
    assert out == {1: 5.0, 2: 0.0}


def test_batch_claim_fixture(spark):
    jobs = gen.gen_jobs(spark, 1000)
    claims = wq.claim_batch(jobs, 2, 50)
    rows = claims.orderBy("claim_rank").collect()
    assert len(rows) == 100
    assert {r.worker_id for r in rows[:50]} == {1} and {r.worker_id for r in rows[50:]} == {2}
    log = wq.claim_log(claims, "2026-06-01 00:00:00")
    assert wq.double_claims(log).count() == 0
    dist = {r.worker_id: r.tasks_processed for r in wq.worker_distribution(log).collect()}
    assert dist == {1: 50, 2: 50}
    # priority order, ties broken by id
    pr = [(r.priority, r.id) for r in jobs.join(claims.select(F.col("job_id").alias("id"), "claim_rank"), "id")
          .orderBy("claim_rank").collect()]
    assert pr == sorted(pr, key=lambda x: (-x[0], x[1]))


def test_activity_generator_shape(spark):
    ev = gen.gen_activity(spark, 20000, days=30, users=1000)
    assert ev.count() == 20000
    assert ev.select(F.min("event_date"), F.max("event_date")).first()[1].toordinal() \
        - ev.select(F.min("event_date")).first()[0].toordinal() == 29
    share9 = ev.filter(F.hour("ts") == 9).count() / 20000
    assert share9 > 0.12
    purchases = ev.filter("event_type = 4").agg(F.min("event_value")).first()[0]
    assert purchases >= 10
