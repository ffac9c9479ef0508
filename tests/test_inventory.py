"""Inventory operators on small hand-written rows."""

from tidemark.operators import inventory as inv


def test_log_drift_equals_two_pass_drift(spark):
    stock = spark.createDataFrame([(0, 1, 10), (0, 2, 10), (1, 1, 5)],
                                  "warehouse_id long, product_id long, quantity long")
    # e1 delivered three times, e2 once, e3 twice (a take), e4 for a key without stock
    ev = spark.createDataFrame([
        ("e1", 0, 1, 4, 0), ("e1", 0, 1, 4, 1), ("e1", 0, 1, 4, 2),
        ("e2", 0, 2, -3, 0),
        ("e3", 1, 1, -2, 0), ("e3", 1, 1, -2, 1),
        ("e4", 9, 9, 7, 0), ("e4", 9, 9, 7, 1),
    ], "event_id string, warehouse_id long, product_id long, quantity long, delivery int")
    one = inv.log_drift(stock, ev)
    two = inv.stock_drift(inv.restock(stock, ev), inv.project_stock(stock, inv.append_events(None, ev)))
    cols = ["warehouse_id", "product_id", "stored", "projected", "drift"]
    a = sorted(tuple(r) for r in one.select(*cols).collect())
    b = sorted(tuple(r) for r in two.select(*cols).collect())
    assert a == b == [(0, 1, 22, 14, 8), (1, 1, 1, 3, -2)]
