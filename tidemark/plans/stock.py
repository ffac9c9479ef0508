"""Registered inventory queries (I01-I15, J07, S13) with SQL oracles (recursive CTEs for the
order-dependent folds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import inventory as inv
from tidemark.operators import reservations
from tidemark.plans.registry import register
from tidemark.session import saved, scratch_path
from tidemark.sources import driver as src
from tidemark.sources import layout as lay

STOCK0 = src.INITIAL_STOCK
AS_OF = "2024-01-31 00:00:00"

REQ = """
req AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
         l_suppkey % 5 AS warehouse_id, l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_shipdate AS ts, l_returnflag <> 'R' AS event_ok, l_linestatus <> 'O' AS release_ok,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey % 5
                            ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity,
                                     l_extendedprice, l_discount, l_tax) AS rn
  FROM lineitem)
"""

# guarded fold over req; `consume` decides whether an accepted request keeps the units
FOLD = """
fold AS (
  SELECT order_id, line_no, product_id, warehouse_id, supplier_id, quantity, ts, event_ok, release_ok, rn,
         quantity <= {s0} AS accepted,
         CASE WHEN quantity <= {s0} AND {consume} THEN {s0} - quantity ELSE {s0} END AS balance_after
  FROM req WHERE rn = 1
  UNION ALL
  SELECT r.order_id, r.line_no, r.product_id, r.warehouse_id, r.supplier_id, r.quantity, r.ts, r.event_ok,
         r.release_ok, r.rn, r.quantity <= f.balance_after,
         CASE WHEN r.quantity <= f.balance_after AND {rconsume} THEN f.balance_after - r.quantity ELSE f.balance_after END
  FROM fold f JOIN req r ON r.product_id = f.product_id AND r.warehouse_id = f.warehouse_id AND r.rn = f.rn + 1)
"""

FOLD_ALL = FOLD.format(s0=STOCK0, consume="true", rconsume="true")
FOLD_SAGA = FOLD.format(s0=STOCK0, consume="event_ok", rconsume="r.event_ok")


def _requests(spark, d):
    return src.stock_requests(spark, d)


OUT_COLS = ["order_id", "line_no", "supplier_id", "quantity", "ts"]


def _settled(spark, d):
    return inv.settle(src.warehouse_stock(spark, d), _requests(spark, d), src.REQUEST_ORDER, keep=OUT_COLS)


@register("i01_settle", f"""WITH RECURSIVE {REQ}, {FOLD_ALL}
SELECT order_id, line_no, product_id, warehouse_id, supplier_id, quantity, accepted, balance_after FROM fold
""")
def i01_settle(spark, d):
    return _settled(spark, d).select("order_id", "line_no", "product_id", "warehouse_id", "supplier_id",
                                     "quantity", "accepted", "balance_after")


@register("i01_final_stock", f"""WITH RECURSIVE {REQ}, {FOLD_ALL},
used AS (SELECT warehouse_id, product_id, sum(quantity) FILTER (WHERE accepted) AS used FROM fold GROUP BY 1, 2)
SELECT CAST(s.w AS BIGINT) AS warehouse_id, s.p_partkey AS product_id, {STOCK0} - COALESCE(u.used, 0) AS quantity
FROM (SELECT p_partkey, unnest(range(0, 5)) AS w FROM part) s
LEFT JOIN used u ON u.warehouse_id = s.w AND u.product_id = s.p_partkey
""")
def i01_final_stock(spark, d):
    return inv.final_stock(src.warehouse_stock(spark, d), _settled(spark, d))


@register("i01_settle_totals", f"""WITH RECURSIVE {REQ}, {FOLD_ALL}
SELECT count(*) FILTER (WHERE accepted) AS accepted, count(*) FILTER (WHERE NOT accepted) AS rejected,
       min(balance_after) AS min_balance FROM fold
""")
def i01_settle_totals(spark, d):
    out = _settled(spark, d)
    return out.agg(F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"),
                   F.min("balance_after").alias("min_balance"))


@register("i02_restock_returns", f"""
WITH ret AS (SELECT l_suppkey % 5 AS warehouse_id, l_partkey AS product_id, sum(CAST(l_quantity AS BIGINT)) AS q
             FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
stock AS (SELECT w AS warehouse_id, p_partkey AS product_id, {STOCK0} AS quantity
          FROM part, (SELECT unnest(range(0, 5)) AS w))
SELECT s.warehouse_id, s.product_id, s.quantity + COALESCE(r.q, 0) AS quantity
FROM stock s LEFT JOIN ret r ON r.warehouse_id = s.warehouse_id AND r.product_id = s.product_id
""")
def i02_restock_returns(spark, d):
    moves = _requests(spark, d).filter(F.col("return_flag") == "R")
    return inv.restock(src.warehouse_stock(spark, d), moves)


def _outcomes(spark, d):
    # the step results are attributes of the same line rows, so they are projected, not joined
    reqs = _requests(spark, d).withColumns(src.step_flags())
    return inv.confirm_orders(src.warehouse_stock(spark, d), reqs, None, None, src.REQUEST_ORDER, keep=OUT_COLS)


OUTCOME_SQL = """CASE WHEN NOT accepted THEN 'rejected' WHEN NOT event_ok THEN 'compensated'
                      WHEN NOT release_ok THEN 'confirmed_uncleared' ELSE 'confirmed' END"""


@register("i03_confirm_orders", f"""WITH RECURSIVE {REQ}, {FOLD_SAGA}
SELECT order_id, line_no, product_id, warehouse_id, supplier_id, quantity, {OUTCOME_SQL} AS outcome, balance_after
FROM fold
""")
def i03_confirm_orders(spark, d):
    return _outcomes(spark, d).select("order_id", "line_no", "product_id", "warehouse_id", "supplier_id",
                                      "quantity", "outcome", "balance_after")


@register("i04_stock_events", f"""WITH RECURSIVE {REQ}, {FOLD_SAGA}
SELECT md5(CAST(order_id AS VARCHAR) || '|' || CAST(line_no AS VARCHAR) || '|' || CAST(supplier_id AS VARCHAR) || '|' ||
           CAST(product_id AS VARCHAR) || '|' || CAST(quantity AS VARCHAR)) AS event_id,
       'STOCK_DECREASED' AS event_type, product_id, warehouse_id, -quantity AS quantity, ts AS timestamp,
       CAST(order_id AS VARCHAR) AS order_ref, CAST(o_custkey AS VARCHAR) AS user_ref
FROM fold LEFT JOIN orders ON o_orderkey = order_id WHERE {OUTCOME_SQL} IN ('confirmed', 'confirmed_uncleared')
""")
def i04_stock_events(spark, d):
    buyers = src.shop_orders(spark, d).select(F.col("id").alias("order_id"), F.col("client_id").alias("user_id"))
    ev = inv.stock_events(_outcomes(spark, d).join(buyers, "order_id", "left"),
                          ["order_id", "line_no", "supplier_id", "product_id", "quantity"], "user_id")
    return ev.select("event_id", "event_type", "product_id", "warehouse_id", "quantity", "timestamp",
                     F.col("metadata")["order_id"].alias("order_ref"), F.col("metadata")["user_id"].alias("user_ref"))


# ------------------------------------------------------------------------------- carts

CART = f"""
log AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         user_id % {src.WAREHOUSES} AS warehouse_id,
         CASE WHEN event_type IN ('click', 'view') THEN 'reserve' WHEN event_type = 'error' THEN 'cancel'
              WHEN event_type = 'purchase' THEN 'confirm' END AS action,
         1 + event_id % 5 AS quantity, ts, {src.CART_TTL_SECONDS} AS ttl
  FROM events WHERE event_type <> 'signup'),
x AS (SELECT *, CASE WHEN action = 'reserve' THEN ts + to_seconds(ttl) END AS expires_at FROM log),
p AS (SELECT *, last_value(expires_at IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_exp FROM x),
f AS (SELECT *, CASE WHEN action = 'reserve' AND (prev_exp IS NULL OR ts >= prev_exp) THEN 1 ELSE 0 END AS flag FROM p),
a AS (SELECT *, sum(flag) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cno,
             (prev_exp IS NOT NULL AND ts < prev_exp) AS live_now FROM f),
assigned AS (
  SELECT event_id, user_id, product_id, warehouse_id, action, quantity, ts, ttl, expires_at,
         CASE WHEN action = 'reserve' OR live_now THEN cno END AS cart_no,
         CASE WHEN action <> 'reserve' THEN live_now END AS cart_live
  FROM a),
carts AS (
  SELECT user_id, cart_no, min(ts) AS opened_at, max(last_exp) AS expires_at, count(*) AS reserves,
         sum(quantity) AS units,
         min(ts) <= TIMESTAMP '{AS_OF}' AND max(last_exp) > TIMESTAMP '{AS_OF}' AS live
  FROM (SELECT *, last_value(expires_at) OVER (PARTITION BY user_id, cart_no ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_exp
        FROM assigned WHERE action = 'reserve') r
  GROUP BY user_id, cart_no)
"""

# Line by line: reserves add; a cancel or a confirm takes all of its units or none.
CANCELS = CART + """,
lr AS (SELECT *, CASE WHEN action = 'reserve' THEN quantity ELSE -quantity END AS delta,
              row_number() OVER (PARTITION BY user_id, cart_no, warehouse_id, product_id ORDER BY ts, event_id) AS rn
       FROM assigned WHERE cart_no IS NOT NULL),
cf AS (
  SELECT event_id, user_id, cart_no, warehouse_id, product_id, action, quantity, ts, rn,
         delta >= 0 AS accepted, greatest(delta, 0) AS bal
  FROM lr WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.user_id, r.cart_no, r.warehouse_id, r.product_id, r.action, r.quantity, r.ts, r.rn,
         c.bal + r.delta >= 0, CASE WHEN c.bal + r.delta >= 0 THEN c.bal + r.delta ELSE c.bal END
  FROM cf c JOIN lr r ON r.user_id = c.user_id AND r.cart_no = c.cart_no AND r.warehouse_id = c.warehouse_id
                     AND r.product_id = c.product_id AND r.rn = c.rn + 1),
cancelled AS (
  SELECT event_id, user_id, cart_no, warehouse_id, product_id, action, quantity, ts,
         CASE WHEN action = 'reserve' THEN 'reserved'
              WHEN action = 'confirm' THEN CASE WHEN accepted THEN 'confirmed' ELSE 'confirmed_unreserved' END
              WHEN accepted THEN 'cancelled' ELSE 'refused_exceeds' END AS outcome,
         bal AS line_after FROM cf
  UNION ALL
  SELECT event_id, user_id, cart_no, warehouse_id, product_id, action, quantity, ts,
         CASE WHEN action = 'confirm' THEN 'confirmed_unreserved' ELSE 'refused_no_cart' END, NULL
  FROM assigned WHERE action <> 'reserve' AND cart_no IS NULL),
lines AS (
  SELECT l.user_id, l.cart_no, l.warehouse_id, l.product_id, l.units, c.expires_at, c.live
  FROM (SELECT user_id, cart_no, warehouse_id, product_id, arg_max(bal, rn) AS units FROM cf GROUP BY 1, 2, 3, 4) l
  JOIN carts c ON c.user_id = l.user_id AND c.cart_no = l.cart_no
  WHERE l.units > 0)
"""


def _assigned(spark, d):
    return inv.assign_carts(src.cart_log(spark, d).filter(F.col("ts") <= F.lit(AS_OF).cast("timestamp_ntz")))


def _cart_table(spark, d):
    return inv.carts(_assigned(spark, d), AS_OF)


def _cancelled(spark, d):
    return inv.apply_cancels(_assigned(spark, d))


def _cart_state(spark, d):
    """(cancelled, lines), built on one cart assignment, written once: the range cut of the lines
    reads it twice, the carts a third time."""
    assigned = saved(_assigned(spark, d), "assigned")
    cancelled = inv.apply_cancels(assigned)
    return cancelled, inv.cart_lines(cancelled, inv.carts(assigned, AS_OF))


def _lines(spark, d):
    return _cart_state(spark, d)[1]


@register("i05_assign_carts", f"""WITH {CART}
SELECT event_id, user_id, action, expires_at, cart_no, cart_live FROM assigned
""")
def i05_assign_carts(spark, d):
    return _assigned(spark, d).select("event_id", "user_id", "action", "expires_at", "cart_no", "cart_live")


@register("i05_carts", f"""WITH {CART}
SELECT user_id, cart_no, opened_at, expires_at, reserves, units, live FROM carts
""")
def i05_carts(spark, d):
    return _cart_table(spark, d)


@register("i05_live_carts", f"""WITH {CART}
SELECT user_id, cart_no, opened_at, expires_at, units FROM carts WHERE live
""")
def i05_live_carts(spark, d):
    return _cart_table(spark, d).filter("live").select("user_id", "cart_no", "opened_at", "expires_at", "units")


@register("i06_apply_cancels", f"""WITH RECURSIVE {CANCELS}
SELECT event_id, user_id, cart_no, warehouse_id, product_id, action, outcome, line_after FROM cancelled
""")
def i06_apply_cancels(spark, d):
    return _cancelled(spark, d).select("event_id", "user_id", "cart_no", "warehouse_id", "product_id", "action",
                                       "outcome", "line_after")


@register("i06_returned_stock", f"""WITH RECURSIVE {CANCELS},
moved AS (
  SELECT warehouse_id, product_id, quantity AS c, 0 AS e FROM cancelled WHERE outcome = 'cancelled'
  UNION ALL
  SELECT warehouse_id, product_id, 0, units FROM lines WHERE NOT live)
SELECT warehouse_id, product_id, sum(c) AS cancelled_units, sum(e) AS expired_units FROM moved GROUP BY 1, 2
""")
def i06_returned_stock(spark, d):
    return inv.returned_stock(*_cart_state(spark, d))


@register("i07_cancel_all", f"""WITH RECURSIVE {CANCELS},
u AS (SELECT c_custkey AS user_id FROM customer WHERE c_mktsegment = 'HOUSEHOLD'),
per AS (SELECT l.user_id, warehouse_id, product_id, sum(units) AS quantity FROM lines l JOIN u ON u.user_id = l.user_id
        WHERE live GROUP BY 1, 2, 3)
SELECT user_id, string_agg(concat_ws(':', warehouse_id, product_id, quantity), ',' ORDER BY warehouse_id, product_id) AS cancelled_items,
       sum(quantity) AS cancelled_units
FROM per GROUP BY user_id
""")
def i07_cancel_all(spark, d):
    users = src.load(spark, d, "customer").filter(F.col("c_mktsegment") == "HOUSEHOLD") \
        .select(F.col("c_custkey").alias("user_id"))
    out = inv.cancel_all(_lines(spark, d), users)
    items = F.array_join(F.transform("cancelled_items", lambda x: F.concat_ws(
        ":", *[x[c].cast("string") for c in ("warehouse_id", "product_id", "quantity")])), ",")
    return out.select("user_id", items.alias("cancelled_items"), "cancelled_units")


@register("i09_user_reservations", f"""WITH RECURSIVE {CANCELS},
per AS (SELECT user_id, concat_ws(':', warehouse_id, product_id) AS line, sum(units) AS units
        FROM lines WHERE live GROUP BY 1, 2)
SELECT user_id, string_agg(concat_ws('=', line, units), ',' ORDER BY line) AS reservations,
       COALESCE(max(units) FILTER (WHERE line = '2:7'), 0) AS product_7_at_2
FROM per GROUP BY user_id
""")
def i09_user_reservations(spark, d):
    r = inv.user_reservations(_lines(spark, d))
    text = F.array_join(F.transform(F.map_entries("reservations"), lambda e: F.concat_ws(
        "=", e["key"], e["value"].cast("string"))), ",")
    return r.select("user_id", text.alias("reservations"), inv.reserved_quantity(7, 2).alias("product_7_at_2"))


@register("i10_reserved_totals", f"""WITH RECURSIVE {CANCELS}
SELECT warehouse_id, product_id, sum(units) AS reserved FROM lines WHERE live GROUP BY 1, 2
""")
def i10_reserved_totals(spark, d):
    return inv.reserved_totals(_lines(spark, d))


@register("i11_availability", f"""WITH RECURSIVE {CANCELS},
res AS (SELECT warehouse_id, product_id, sum(units) AS reserved FROM lines WHERE live GROUP BY 1, 2)
SELECT s.w AS warehouse_id, s.p_partkey AS product_id, {STOCK0} AS total_physical,
       COALESCE(r.reserved, 0) AS currently_reserved, {STOCK0} - COALESCE(r.reserved, 0) AS available_to_buy
FROM (SELECT p_partkey, unnest(range(0, {src.WAREHOUSES})) AS w FROM part) s
LEFT JOIN res r ON r.warehouse_id = s.w AND r.product_id = s.p_partkey
""")
def i11_availability(spark, d):
    return inv.availability(src.warehouse_stock(spark, d), inv.reserved_totals(_lines(spark, d)))


@register("i08_reserve", f"""WITH RECURSIVE
raw AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         user_id % {src.WAREHOUSES} AS warehouse_id, 1 + event_id % 5 AS quantity, ts
  FROM events WHERE event_type IN ('click', 'view')),
req AS (
  SELECT r.*, CASE WHEN p_partkey IS NULL THEN 0 ELSE {STOCK0} END AS stock,
         row_number() OVER (PARTITION BY r.warehouse_id, r.product_id ORDER BY ts, event_id) AS rn
  FROM raw r LEFT JOIN part ON p_partkey = r.product_id),
fold AS (
  SELECT event_id, user_id, warehouse_id, product_id, quantity, rn, quantity <= stock AS accepted,
         CASE WHEN quantity <= stock THEN stock - quantity ELSE stock END AS bal FROM req WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.user_id, r.warehouse_id, r.product_id, r.quantity, r.rn, r.quantity <= f.bal,
         CASE WHEN r.quantity <= f.bal THEN f.bal - r.quantity ELSE f.bal END
  FROM fold f JOIN req r ON r.warehouse_id = f.warehouse_id AND r.product_id = f.product_id AND r.rn = f.rn + 1)
SELECT event_id, user_id, warehouse_id, product_id, CASE WHEN accepted THEN quantity ELSE 0 END AS reserved_quantity,
       bal AS remaining_quantity
FROM fold
""")
def i08_reserve(spark, d):
    """Reserve actions take units of product k from the warehouse that serves the user."""
    reqs = src.cart_log(spark, d).filter(F.col("action") == "reserve")
    out = inv.reserve(src.warehouse_stock(spark, d), reqs, ["ts", "event_id"])
    return out.select("event_id", "user_id", "warehouse_id", "product_id", "reserved_quantity", "remaining_quantity")


SCARCE = 5  # units of every product, so that reserves compete for what comes back

# One warehouse's log, row by row: ``lines`` are the lines of live carts (user, product, units, expiry of the
# cart), ``sold`` the units sold of products 0..99.
GIVE_BACK = f"""
ev AS (SELECT l.*, CASE WHEN p_partkey IS NULL THEN 0 ELSE {SCARCE} END AS stock,
              row_number() OVER (PARTITION BY warehouse_id ORDER BY ts, event_id) AS rn
       FROM log l LEFT JOIN part ON p_partkey = product_id),
sim AS (
  SELECT DISTINCT warehouse_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, NULL::VARCHAR AS outcome, 0::BIGINT AS reserved_quantity,
         0::BIGINT AS remaining_quantity, NULL::TIMESTAMP AS expires_at, NULL::BIGINT AS line_after,
         []::STRUCT(u BIGINT, p BIGINT, n BIGINT, e TIMESTAMP)[] AS lines, list_transform(range(0, 100), lambda x: 0::BIGINT) AS sold
  FROM ev
  UNION ALL
  SELECT warehouse_id, rn, event_id,
         CASE WHEN action = 'reserve' THEN CASE WHEN ok THEN 'reserved' ELSE 'refused_stock' END
              WHEN action = 'confirm' THEN CASE WHEN ok THEN 'confirmed' ELSE 'confirmed_unreserved' END
              WHEN ok THEN 'cancelled' WHEN cart IS NULL THEN 'refused_no_cart' ELSE 'refused_exceeds' END,
         CASE WHEN ok AND action = 'reserve' THEN quantity ELSE 0 END,
         avail + CASE WHEN NOT ok OR action = 'confirm' THEN 0 WHEN action = 'reserve' THEN -quantity ELSE quantity END,
         CASE WHEN ok AND action = 'reserve' THEN expiry END,
         CASE WHEN action = 'reserve' THEN CASE WHEN ok THEN own + quantity END
              WHEN cart IS NOT NULL THEN own - CASE WHEN ok THEN quantity ELSE 0 END END,
         CASE WHEN NOT ok THEN live
              WHEN action = 'reserve' THEN list_append(
                list_transform(live, lambda x: {{'u': x.u, 'p': x.p, 'n': x.n, 'e': CASE WHEN x.u = user_id THEN expiry ELSE x.e END}}),
                {{'u': user_id, 'p': product_id, 'n': quantity, 'e': expiry}})
              ELSE list_append(list_filter(live, lambda x: NOT (x.u = user_id AND x.p = product_id)),
                               {{'u': user_id, 'p': product_id, 'n': own - quantity, 'e': cart}}) END,
         CASE WHEN ok AND action = 'confirm' THEN list_transform(sold, lambda x, i: x + CASE WHEN i = product_id + 1 THEN quantity ELSE 0 END)
              ELSE sold END
  FROM (SELECT *, CASE WHEN action = 'reserve' THEN avail >= quantity ELSE cart IS NOT NULL AND own >= quantity END AS ok
        FROM (SELECT *, stock - sold[product_id + 1]
                        - coalesce(list_sum(list_transform(list_filter(live, lambda x: x.p = product_id), lambda x: x.n)), 0)::BIGINT AS avail,
                     coalesce(list_sum(list_transform(list_filter(live, lambda x: x.p = product_id AND x.u = user_id), lambda x: x.n)), 0)::BIGINT AS own,
                     list_max(list_transform(list_filter(live, lambda x: x.u = user_id), lambda x: x.e)) AS cart
              FROM (SELECT e.warehouse_id, e.rn, e.event_id, e.user_id, e.product_id, e.action, e.quantity, e.stock, s.sold,
                           e.ts + to_seconds(e.ttl) AS expiry, list_filter(s.lines, lambda x: x.e > e.ts) AS live
                    FROM sim s JOIN ev e ON e.warehouse_id = s.warehouse_id AND e.rn = s.rn + 1))))
"""


@register("i08_reserve_give_back", f"""WITH RECURSIVE {CART.split("x AS (")[0]} {GIVE_BACK}
SELECT sim.event_id, l.user_id, l.warehouse_id, l.product_id, l.action, outcome, reserved_quantity, remaining_quantity,
       expires_at, line_after
FROM sim JOIN log l ON l.event_id = sim.event_id
""")
def i08_reserve_give_back(spark, d):
    """The whole cart log on scarce stock: what cancels and expired carts return can be reserved again."""
    out = reservations.reserve_with_give_back(src.warehouse_stock(spark, d, SCARCE), src.cart_log(spark, d))
    return out.select("event_id", "user_id", "warehouse_id", "product_id", "action", "outcome", "reserved_quantity",
                      "remaining_quantity", "expires_at", "line_after")


# ------------------------------------------------------------------------------ events

EVENTS = """
ev AS (
  SELECT md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' ||
             CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) || '|' ||
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '|' || strftime(l_shipdate, '%Y-%m-%d')) AS event_id,
         CASE WHEN l_returnflag = 'R' THEN 'STOCK_RECEIVED' ELSE 'STOCK_DECREASED' END AS event_type,
         l_partkey AS product_id, l_suppkey % 5 AS warehouse_id,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE -CAST(l_quantity AS BIGINT) END AS quantity,
         l_shipdate AS timestamp, l_linestatus
  FROM lineitem),
delivered AS (SELECT * FROM ev UNION ALL SELECT * FROM ev WHERE l_linestatus = 'O'),
uniq AS (SELECT DISTINCT event_id, event_type, product_id, warehouse_id, quantity, timestamp FROM delivered)
"""

BASE_BEFORE = "1998-01-01 00:00:00"


def _deduped(spark, d):
    return inv.append_events(None, src.inventory_events(spark, d))


@register("i12_append_events", f"""WITH {EVENTS}
SELECT event_id, event_type, product_id, warehouse_id, quantity, timestamp FROM uniq
WHERE event_id NOT IN (SELECT event_id FROM uniq WHERE timestamp < TIMESTAMP '{BASE_BEFORE}')
""")
def i12_append_events(spark, d):
    """Replay of the whole delivered log onto a base holding the events before 1998."""
    new = src.inventory_events(spark, d)
    base = _deduped(spark, d).filter(F.col("timestamp") < F.lit(BASE_BEFORE).cast("timestamp_ntz"))
    out = inv.append_events(base, new)
    return out.select("event_id", "event_type", "product_id", "warehouse_id", "quantity", "timestamp")


@register("i12_dedupe_count", f"""WITH {EVENTS}
SELECT (SELECT count(*) FROM delivered) AS delivered, (SELECT count(*) FROM uniq) AS kept
""")
def i12_dedupe_count(spark, d):
    delivered = src.inventory_events(spark, d).agg(F.count(F.lit(1)).alias("delivered"))
    kept = _deduped(spark, d).agg(F.count(F.lit(1))).scalar()
    return delivered.withColumn("kept", kept)


STOCK_SQL = f"""stock AS (SELECT w AS warehouse_id, p_partkey AS product_id, {STOCK0} AS quantity
          FROM part, (SELECT unnest(range(0, 5)) AS w))"""


@register("i13_project_stock", f"""WITH {EVENTS}, {STOCK_SQL},
m AS (SELECT warehouse_id, product_id, sum(quantity) AS q FROM uniq GROUP BY 1, 2)
SELECT s.warehouse_id, s.product_id, s.quantity + COALESCE(m.q, 0) AS quantity
FROM stock s LEFT JOIN m ON m.warehouse_id = s.warehouse_id AND m.product_id = s.product_id
""")
def i13_project_stock(spark, d):
    return inv.project_stock(src.warehouse_stock(spark, d), _deduped(spark, d))


SNAPSHOT_AT = "1999-01-01 00:00:00"


@register("i13_replay_from_snapshot", f"""WITH {EVENTS}, {STOCK_SQL},
m AS (SELECT warehouse_id, product_id, sum(quantity) AS q FROM uniq GROUP BY 1, 2)
SELECT s.warehouse_id, s.product_id, s.quantity + COALESCE(m.q, 0) AS quantity
FROM stock s LEFT JOIN m ON m.warehouse_id = s.warehouse_id AND m.product_id = s.product_id
""")
def i13_replay_from_snapshot(spark, d):
    """The same projection from a written snapshot and the log's later months."""
    log = lay.write_layout(src.inventory_events(spark, d).drop("metadata"), scratch_path(spark, "event-log"), "month",
                           ("timestamp", "event_id"), ts_col="timestamp")
    events = spark.read.parquet(log)
    snapshot = saved(inv.stock_snapshot(src.warehouse_stock(spark, d), events, SNAPSHOT_AT), "snapshot")
    return inv.replay_stock(snapshot, events, SNAPSHOT_AT, date_col="event_month")


@register("i13_stock_drift", f"""WITH {EVENTS}, {STOCK_SQL},
m AS (SELECT warehouse_id, product_id, sum(quantity) AS q FROM uniq GROUP BY 1, 2),
n AS (SELECT warehouse_id, product_id, sum(quantity) AS q FROM delivered GROUP BY 1, 2),
p AS (SELECT s.warehouse_id, s.product_id, s.quantity + COALESCE(m.q, 0) AS projected
      FROM stock s LEFT JOIN m ON m.warehouse_id = s.warehouse_id AND m.product_id = s.product_id),
st AS (SELECT s.warehouse_id, s.product_id, s.quantity + COALESCE(n.q, 0) AS stored
       FROM stock s LEFT JOIN n ON n.warehouse_id = s.warehouse_id AND n.product_id = s.product_id)
SELECT st.warehouse_id, st.product_id, stored, projected, stored - projected AS drift
FROM st JOIN p ON p.warehouse_id = st.warehouse_id AND p.product_id = st.product_id
WHERE stored <> projected
""")
def i13_stock_drift(spark, d):
    """Stored stock is a counter that applied every delivery (redeliveries twice); the
    projection applies each event once.  Drift = the redelivered quantities."""
    out = inv.log_drift(src.warehouse_stock(spark, d), src.inventory_events(spark, d))
    return out.select("warehouse_id", "product_id", "stored", "projected", "drift")


MOVE_LO, MOVE_HI = "1998-01-01 00:00:00", "1999-01-01 00:00:00"


@register("i14_movements", f"""WITH {EVENTS}
SELECT event_id, warehouse_id, product_id, timestamp, quantity,
       sum(quantity) OVER (PARTITION BY warehouse_id, product_id ORDER BY timestamp, event_id
                           ROWS UNBOUNDED PRECEDING) AS running_change
FROM uniq WHERE timestamp >= TIMESTAMP '{MOVE_LO}' AND timestamp < TIMESTAMP '{MOVE_HI}'
""")
def i14_movements(spark, d):
    # only the reported columns enter the chunked scan: its input is cut and checkpointed when it is
    # built, so a later projection could not prune it
    cols = ["event_id", "warehouse_id", "product_id", "timestamp", "quantity"]
    events = inv.append_events(None, src.inventory_events(spark, d).select(*cols, "delivery"))
    out = inv.movements(events.select(*cols), MOVE_LO, MOVE_HI)
    return out.select(*cols, "running_change")


MOVED_PRODUCT = 7


@register("i14_product_movements", f"""WITH {EVENTS}
SELECT event_id, warehouse_id, timestamp, quantity,
       sum(quantity) OVER (PARTITION BY warehouse_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS running_change
FROM uniq WHERE product_id = {MOVED_PRODUCT} AND timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '{MOVE_HI}'
""")
def i14_product_movements(spark, d):
    """One product's history: the product reaches the scan before copies are dropped."""
    cols = ["event_id", "warehouse_id", "product_id", "timestamp", "quantity"]
    own = src.inventory_events(spark, d).select(*cols, "delivery").filter(F.col("product_id") == MOVED_PRODUCT)
    out = inv.movements(inv.append_events(None, own).select(*cols), "1996-01-01", MOVE_HI, MOVED_PRODUCT)
    return out.select("event_id", "warehouse_id", "timestamp", "quantity", "running_change")


SET_CHANGES = """
ch AS (SELECT l_suppkey % 7 AS warehouse_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
              l_shipdate AS ts, l_orderkey, l_linenumber, l_suppkey
       FROM lineitem WHERE l_returnflag = 'A')
"""


def _set_stock(spark, d):
    li = src.load(spark, d, "lineitem").filter(F.col("l_returnflag") == "A")
    changes = li.select(F.pmod("l_suppkey", F.lit(7)).alias("warehouse_id"), F.col("l_partkey").alias("product_id"),
                        F.col("l_quantity").cast("long").alias("quantity"),
                        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey").alias("ts"))
    products = src.products(spark, d)
    warehouses = src.load(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("id"))
    return inv.set_stock(src.warehouse_stock(spark, d), changes, products, warehouses)


@register("i15_set_stock", f"""WITH {SET_CHANGES}, {STOCK_SQL},
ok AS (SELECT * FROM ch WHERE warehouse_id IN (SELECT r_regionkey FROM region)
                          AND product_id IN (SELECT p_partkey FROM part)),
last AS (SELECT warehouse_id, product_id, arg_max(quantity, (ts, l_orderkey, l_linenumber, l_suppkey)) AS q
         FROM ok GROUP BY 1, 2)
SELECT s.warehouse_id, s.product_id, COALESCE(l.q, s.quantity) AS quantity
FROM stock s LEFT JOIN last l ON l.warehouse_id = s.warehouse_id AND l.product_id = s.product_id
""")
def i15_set_stock(spark, d):
    new_stock, _rej = _set_stock(spark, d)
    return new_stock


@register("i15_set_stock_rejects", f"""WITH {SET_CHANGES}
SELECT CASE WHEN product_id NOT IN (SELECT p_partkey FROM part) THEN 'product not found'
            ELSE 'warehouse not found' END AS reason, count(*) AS n
FROM ch WHERE warehouse_id NOT IN (SELECT r_regionkey FROM region) OR product_id NOT IN (SELECT p_partkey FROM part)
GROUP BY 1
""")
def i15_set_stock_rejects(spark, d):
    _new, rej = _set_stock(spark, d)
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
