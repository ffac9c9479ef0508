"""I08 with give-back against a simulation of the log, row by row."""

import datetime as dt
import heapq
import random
from collections import defaultdict

from tidemark.operators.reservations import reserve_with_give_back

START = dt.datetime(2026, 6, 20)


def simulated(stock, log):
    """Rows (event_id, outcome, reserved, remaining, line_after) of ``log`` (event, user, product, action,
    quantity, minute, ttl seconds), in order of minute and event."""
    left, cart, lines, timers, out = dict(stock), {}, defaultdict(dict), [], []
    for event, user, product, action, q, minute, ttl in sorted(log, key=lambda r: (r[5], r[0])):
        now = minute * 60
        while timers and timers[0][0] <= now:
            at, _, who = heapq.heappop(timers)
            if cart.get(who) == at:
                for p, n in lines.pop(who).items():
                    left[p] = left.get(p, 0) + n
                del cart[who]
        mine, ok = lines[user].get(product, 0), q is not None and q >= 0
        if not ok:
            outcome = "refused_invalid"
        elif action == "reserve":
            ok = product in stock and left[product] >= q
            outcome = "reserved" if ok else "refused_stock"
            if ok:
                left[product] -= q
                lines[user][product] = mine + q
                cart[user] = now + ttl
                heapq.heappush(timers, (now + ttl, len(out), user))
        else:
            ok = user in cart and mine >= q
            outcome = {("cancel", True): "cancelled", ("confirm", True): "confirmed", ("confirm", False): "confirmed_unreserved"}.get(
                (action, ok), "refused_exceeds" if user in cart else "refused_no_cart")
            if ok:
                lines[user][product] = mine - q
                if action == "cancel":
                    left[product] += q
        after = lines[user].get(product, 0) if user in cart and (action != "reserve" or ok) else None
        out.append((event, outcome, q if ok and action == "reserve" else 0, left[product] if product in stock else 0, after))
    return out


def reserved(spark, stock, log):
    rows = [(e, u, p, a, q, START + dt.timedelta(minutes=m), ttl, 0, "x") for e, u, p, a, q, m, ttl in log]
    table = spark.createDataFrame(rows, "event_id long, user_id long, product_id long, action string, quantity long, ts timestamp_ntz, "
                                        "ttl int, warehouse_id int, accepted string")
    s = spark.createDataFrame([(0, p, n) for p, n in stock.items()], "warehouse_id int, product_id long, quantity long")
    out = reserve_with_give_back(s, table)
    assert out.columns[:9] == table.columns
    got = out.orderBy("ts", "event_id").collect()
    return [(r.event_id, r.outcome, r.reserved_quantity, r.remaining_quantity, r.line_after) for r in got], got


def test_units_come_back(spark):
    """Product 1 has 3 units: taken, cancelled in part, expired, taken again."""
    log = [(1, 1, 1, "reserve", 3, 0, 600), (2, 2, 1, "reserve", 1, 1, 600), (3, 1, 1, "cancel", 2, 2, 0), (4, 2, 1, "reserve", 2, 3, 600),
           (5, 3, 1, "reserve", 1, 9, 600), (6, 3, 1, "reserve", 1, 10, 600), (7, 2, 1, "confirm", 2, 11, 0), (8, 3, 1, "reserve", 1, 40, 600),
           (9, 3, 9, "reserve", 0, 41, 600), (10, 3, 1, "cancel", None, 42, 0)]
    got, rows = reserved(spark, {1: 3}, log)
    assert got == simulated({1: 3}, log)
    assert [g[1] for g in got] == ["reserved", "refused_stock", "cancelled", "reserved", "refused_stock", "reserved", "confirmed",
                                   "reserved", "refused_stock", "refused_invalid"]
    assert rows[0].expires_at == START + dt.timedelta(minutes=10) and rows[1].expires_at is None


def test_scarce_stock_with_a_hot_product_and_a_hot_user(spark):
    """A third of the rows are one product's and a third one user's; chains of refusals and
    expiries, carts replaced by shorter ones, expiries at the very minute of a row, bad quantities."""
    rng = random.Random(2)
    log = []
    for e in range(120):
        user = 0 if rng.random() < 0.33 else rng.randrange(1, 12)
        product = 0 if rng.random() < 0.33 else rng.randrange(1, 6)
        action = rng.choice(["reserve", "reserve", "reserve", "cancel", "confirm"])
        q = rng.choice([1, 1, 2, 3]) if rng.random() < 0.93 else rng.choice([None, -2, 0])
        log.append((e, user, product, action, q, e // 2, rng.choice([60, 600, 1800])))
    stock = {p: 4 for p in range(5)}  # product 5 has no stock row
    got, _ = reserved(spark, stock, log)
    want = simulated(stock, log)
    assert got == want
    assert len({g[1] for g in got}) == 8


def test_no_rows_and_no_stock(spark):
    log = [(1, 1, 1, "reserve", 1, 0, 60), (2, None, 1, "cancel", 1, 1, 0)]
    assert reserved(spark, {}, log)[0] == simulated({}, log)
    assert reserved(spark, {1: 1}, [])[0] == []


def chain(users):
    """One unit of one product, asked for every minute and held for a minute and a half."""
    return [(e, e, 1, "reserve", 1, e, 90) for e in range(users)]


def test_chain_of_hand_overs_takes_no_rounds(spark, monkeypatch):
    from tidemark.operators import reservations

    judged, calls = reservations._judged, []
    monkeypatch.setattr(reservations, "_judged", lambda *a: calls.append(1) or judged(*a))
    log = chain(12)
    got, _ = reserved(spark, {1: 1}, log)
    assert got == simulated({1: 1}, log)
    assert [g[1] for g in got] == ["reserved", "refused_stock"] * 6
    assert len(calls) == 1


def test_slices_of_time_and_users_in_two_warehouses(spark, monkeypatch):
    """Slices of a few rows carry stock and carts on; the same log with every user in one warehouse, and not;
    rows that are there twice."""
    from tidemark.operators import reservations

    judged, calls = reservations._judged, []
    monkeypatch.setattr(reservations, "_judged", lambda *a: calls.append(1) or judged(*a))
    rng = random.Random(3)
    schema = "event_id long, user_id long, warehouse_id long, product_id long, action string, quantity long, ts timestamp_ntz, ttl int"
    s = spark.createDataFrame([(w, p, 4) for w in range(2) for p in range(3)], "warehouse_id long, product_id long, quantity long")
    stock = {(w, p): 4 for w in range(2) for p in range(3)}
    for apart in (True, False):
        log = []
        for e in range(150):
            user = rng.randrange(8)
            product = (user % 2 if apart else rng.randrange(2), rng.randrange(3))
            log.append((e, user, product, rng.choice(["reserve", "reserve", "cancel", "confirm"]), rng.choice([1, 1, 2, 3]), e // 2,
                        rng.choice([60, 600, 1800])))
        rows = [(e, u, *p, a, q, START + dt.timedelta(minutes=m), ttl) for e, u, p, a, q, m, ttl in log]
        calls.clear()
        out = reserve_with_give_back(s, spark.createDataFrame(rows, schema), slice_rows=20).orderBy("ts", "event_id").collect()
        assert [(r.event_id, r.outcome, r.reserved_quantity, r.remaining_quantity, r.line_after) for r in out] == simulated(stock, log)
        assert len(calls) == 1
    twice = reserve_with_give_back(s, spark.createDataFrame(rows + rows, schema), slice_rows=20).collect()
    want = simulated(stock, sorted(log + log, key=lambda r: (r[5], r[0])))
    assert sorted((r.event_id, r.outcome, r.reserved_quantity, r.remaining_quantity) for r in twice) == sorted(r[:4] for r in want)
