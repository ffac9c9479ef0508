"""Inventory, carts and events (I01-I15, J07), re-aimed from per-request service calls to jobs
over request logs.

Order-dependent work keeps a hot (warehouse, product) or a hot user parallel: guarded decrements and
cancels run through ``tidemark.plans.guarded``, movement balances through ``tidemark.plans.chunked``, cart
expiry as windows over spans of time.  Everything else is joins and aggregations.

Corrections of faults in the reference service (each is stated where it applies): expired carts
return their stock; reserved totals are derived from live carts; a failed event write returns
the stock at once (the compensation), so a compensated request does not consume stock for later
requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import ntz_micros
from tidemark.plans.chunked import _columns, running_sum
from tidemark.plans.guarded import guarded_fold
from tidemark.session import saved

STOCK_KEYS = ["warehouse_id", "product_id"]


# -------------------------------------------------------------------------- stock folds

def settle(stock: DataFrame, requests: DataFrame, order: list, keys=STOCK_KEYS, qty: str = "quantity",
           consume_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Per key, in ``order``, accept a request if the balance covers it (and take it),
    else reject it and keep the balance.  Adds ``accepted`` and ``balance_after``.

    A stock row is the first row of its key, so the requests are not joined to the stock before they
    are cut.  Requests for a key without a stock row are rejected, with balance 0; so are requests of
    a null or negative quantity, with the balance as it is.  ``consume_col`` = False marks a request
    that is checked but gives its units back at once (a compensated saga step).
    """
    keys = list(keys)
    asked = F.col(qty).cast("long")
    cols = requests.columns if keep is None else list(dict.fromkeys([*keys, *keep, qty, *([consume_col] if consume_col else [])]))
    first = stock.select(*keys, F.col("quantity").cast("long").alias("_start0"), F.lit(0).alias("_row"))
    r = requests.withColumns({"_delta": F.when(asked >= 0, -asked), "_row": F.lit(1)})
    both = r.unionByName(first, allowMissingColumns=True)
    out = guarded_fold(both, keys, ["_row", *order], "_delta", "_start0", consume_col, keep=[*cols, "_row"])
    return out.filter("_row = 1").select(*cols, "accepted", "balance_after")


def final_stock(stock: DataFrame, outcomes: DataFrame, keys=STOCK_KEYS, qty: str = "quantity",
                consume_col: str | None = None) -> DataFrame:
    """Stock after settlement = initial - accepted (consumed) requests; keys without requests keep
    their stock.  The outcomes are aggregated once."""
    keys = list(keys)
    took = F.col("accepted") if consume_col is None else (F.col("accepted") & F.col(consume_col))
    used = outcomes.groupBy(*keys).agg(F.sum(F.when(took, F.col(qty).cast("long"))).alias("_used"))
    return stock.join(used, keys, "left").select(
        *keys, (F.col("quantity") - F.coalesce(F.col("_used"), F.lit(0))).alias("quantity"))


def restock(stock: DataFrame, moves: DataFrame, keys=STOCK_KEYS, qty: str = "quantity") -> DataFrame:
    """Add returned / received units to stock (moves pre-aggregated per key, then joined)."""
    keys = list(keys)
    add = moves.groupBy(*keys).agg(F.sum(F.col(qty).cast("long")).alias("_add"))
    return stock.join(add, keys, "left").select(
        *keys, (F.col("quantity") + F.coalesce(F.col("_add"), F.lit(0))).alias("quantity"))


def confirm_orders(stock: DataFrame, requests: DataFrame, steps: DataFrame | None, on: list | None,
                   order: list, keys=STOCK_KEYS, keep: list[str] | None = None) -> DataFrame:
    """Saga outcome per request.  Step results (``event_ok``, ``release_ok``) come from
    ``steps`` joined on ``on``, or are already columns of ``requests`` (``steps=None``).

    rejected             stock did not cover the request (step 1 failed)
    compensated          stock was taken, the event write failed, the stock was given back
    confirmed_uncleared  confirmed, but the reservation could not be released (step 3 failed)
    confirmed            all steps passed
    """
    r = requests if steps is None else requests.join(steps, on)
    if keep is not None:
        keep = list(dict.fromkeys([*keep, "release_ok"]))
    out = settle(stock, r, order, keys, consume_col="event_ok", keep=keep)
    outcome = F.when(~F.col("accepted"), "rejected") \
        .when(~F.col("event_ok"), "compensated") \
        .when(~F.col("release_ok"), "confirmed_uncleared") \
        .otherwise("confirmed")
    return out.withColumn("outcome", outcome)


def stock_events(outcomes: DataFrame, id_cols: list, user_col: str | None = None) -> DataFrame:
    """One STOCK_DECREASED event per confirmed request: negative quantity, order metadata.
    The event id is an md5 of the request key, so a re-run produces the same ids."""
    ok = outcomes.filter(F.col("outcome").isin("confirmed", "confirmed_uncleared"))
    meta = [F.lit("order_id"), F.col("order_id").cast("string")]
    if user_col:
        meta += [F.lit("user_id"), F.col(user_col).cast("string")]
    return ok.select(
        F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols])).alias("event_id"),
        F.lit("STOCK_DECREASED").alias("event_type"),
        "product_id", "warehouse_id",
        (-F.col("quantity").cast("long")).alias("quantity"),
        F.col("ts").alias("timestamp"),
        F.create_map(*meta).alias("metadata"),
    )


def reserve(stock: DataFrame, requests: DataFrame, order: list, keys=STOCK_KEYS) -> DataFrame:
    """Check, take from stock, report reserved and remaining.  Refused requests reserve 0."""
    out = settle(stock, requests, order, keys)
    return out.withColumn("reserved_quantity", F.when(F.col("accepted"), F.col("quantity")).otherwise(F.lit(0))) \
        .withColumnRenamed("balance_after", "remaining_quantity")


# ---------------------------------------------------------------------------------- carts

def assign_carts(cart_log: DataFrame, user: str = "user_id", order=("ts", "event_id"), span_seconds: int = 3600) -> DataFrame:
    """Number each user's carts.

    A reserve sets the whole cart's expiry to its own ts + ttl (replacing the previous one, also
    with a shorter one).  A reserve at or after the current expiry opens a new cart.  Cancels and
    confirms do not touch the expiry; each belongs to the cart that is live at its time, else to none.
    This is not Spark's session window, which keeps the longest end and merges a row landing
    exactly on it.

    Adds expires_at (reserves), cart_no (reserves; live cancels and confirms), cart_live (cancels
    and confirms: a cart was live).

    Plain windows, but over (user, span of time), so that a hot user is many groups: the last expiry and
    the number of carts of the spans before come from one row per (user, span).  ``order`` starts with ts.
    """
    order = _columns(list(order))
    is_res = F.col("action") == "reserve"
    takes = F.col("action").isin("cancel", "confirm")
    cut = ["_user", "_span"]
    log = cart_log.withColumns({
        "expires_at": F.when(is_res, F.timestamp_add("SECOND", F.col("ttl").cast("long"), F.col("ts"))).cast("timestamp_ntz"),
        "_user": F.struct(user),  # null users are one user
        "_span": F.coalesce(F.floor(ntz_micros("ts") / (span_seconds * 1_000_000)), F.lit(-(1 << 62)))})
    within = Window.partitionBy(*cut).orderBy(*order)
    sofar, earlier = within.rowsBetween(Window.unboundedPreceding, 0), within.rowsBetween(Window.unboundedPreceding, -1)
    rows = log.withColumn("_prev", F.last("expires_at", ignorenulls=True).over(earlier))
    # the first reserve of a span depends on the spans before, the others do not
    rows = rows.withColumn("_inner", (is_res & F.coalesce(F.col("ts") >= F.col("_prev"), F.lit(False))).cast("long"))
    rows = rows.withColumns({"_own": F.sum("_inner").over(sofar), "_seen": F.max(is_res).over(sofar)})
    at = F.when(is_res, F.struct(*order))
    per = rows.groupBy(*cut).agg(F.max_by("expires_at", at).alias("_latest"), F.min_by("ts", at).alias("_first"), F.sum("_inner").alias("_n"))
    spans = Window.partitionBy("_user").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_carried", F.last("_latest", ignorenulls=True).over(spans))
    per = per.withColumn("_opens", (F.col("_first").isNotNull() & (F.col("_carried").isNull() | (F.col("_first") >= F.col("_carried")))).cast("long"))
    per = per.select(*cut, "_carried", "_opens", F.coalesce(F.sum(F.col("_n") + F.col("_opens")).over(spans), F.lit(0)).alias("_before"))
    rows = rows.join(per, cut)
    prev = F.coalesce("_prev", "_carried")
    live = prev.isNotNull() & (F.col("ts") < prev)
    number = F.col("_before") + F.col("_own") + F.when(F.col("_seen"), F.col("_opens")).otherwise(F.lit(0))
    return rows.select(*cart_log.columns, "expires_at", F.when(is_res | (takes & live), number).alias("cart_no"),
                       F.when(takes, live).alias("cart_live"))


def carts(assigned: DataFrame, as_of, user: str = "user_id", order=("ts", "event_id")) -> DataFrame:
    """One row per cart: opened, expiry (the last reserve's), reserves, units put in (cancels and
    confirms are netted per line, see ``cart_lines``), live at as_of."""
    res = assigned.filter(F.col("action") == "reserve")
    per = res.groupBy(user, "cart_no").agg(
        F.min("ts").alias("opened_at"),
        F.max_by("expires_at", F.struct(*_columns(list(order)))).alias("expires_at"),
        F.count(F.lit(1)).alias("reserves"),
        F.sum(F.col("quantity").cast("long")).alias("units"),
    )
    t = F.lit(as_of).cast("timestamp_ntz")
    return per.withColumn("live", (F.col("opened_at") <= t) & (F.col("expires_at") > t))


def apply_cancels(assigned: DataFrame, user: str = "user_id", order=("ts", "event_id"), line=STOCK_KEYS) -> DataFrame:
    """Per (user, cart, warehouse, product) line, a reserve adds units, a cancel gives units
    back and a confirm (a sale) clears units that are no longer reserved but sold.

    A cancel or confirm takes all of its units or none: a cancel of more than the line holds, or
    without a live cart, is refused; a confirm of such units is a sale that leaves the reservations
    alone (the reference's counter would go below zero).  Adds ``outcome`` (reserved / cancelled /
    refused_exceeds / refused_no_cart / confirmed / confirmed_unreserved) and ``line_after``
    (units still reserved on the line; 0 means the line is gone).  In a cart, a null or negative
    quantity changes nothing (refused_invalid).
    """
    rows = assigned.filter(F.col("action").isin("reserve", "cancel", "confirm"))
    is_sale = F.col("action") == "confirm"
    in_cart = rows.filter(F.col("cart_no").isNotNull()) \
        .withColumn("_delta", F.when(F.col("quantity") >= 0, F.when(F.col("action") == "reserve", F.col("quantity").cast("long"))
                                     .otherwise(-F.col("quantity").cast("long")))) \
        .withColumn("_start", F.lit(0).cast("long"))
    folded = guarded_fold(in_cart, [user, "cart_no", *line], list(order), "_delta", "_start")
    folded = folded.withColumn(
        "outcome", F.when(F.col("_delta").isNull(), "refused_invalid").when(F.col("action") == "reserve", "reserved")
        .when(F.col("accepted"), F.when(is_sale, "confirmed").otherwise("cancelled"))
        .otherwise(F.when(is_sale, "confirmed_unreserved").otherwise("refused_exceeds"))) \
        .withColumnRenamed("balance_after", "line_after").drop("_delta", "_start", "accepted")
    no_cart = rows.filter(F.col("cart_no").isNull()) \
        .withColumn("outcome", F.when(is_sale, "confirmed_unreserved").otherwise("refused_no_cart")) \
        .withColumn("line_after", F.lit(None).cast("long"))
    return folded.unionByName(no_cart)


def cart_line_units(assigned: DataFrame, user: str = "user_id", order=("ts", "event_id"), line=STOCK_KEYS) -> DataFrame:
    """(user, cart, warehouse, product) -> units that the line holds after all rows of ``assigned``.

    Only rows of lines with a cancel or a confirm are judged one by one (``apply_cancels``): what the others
    hold is the sum of their reserves.
    """
    keys = [user, "cart_no", *line]
    rows = assigned.filter(F.col("cart_no").isNotNull() & F.col("action").isin("reserve", "cancel", "confirm"))
    row_line = F.struct(*keys).alias("_line")  # as a struct, nulls equal each other
    put = F.when(F.col("quantity") >= 0, F.col("quantity").cast("long"))
    per = saved(rows.groupBy(row_line).agg(F.coalesce(F.sum(put), F.lit(0)).alias("units"), F.max(F.col("action") != "reserve").alias("_takes")),
                "cart-lines")
    taken = saved(rows.withColumn("_line", row_line).join(per.filter("_takes").select("_line"), "_line", "left_semi").drop("_line"), "cart-taken")
    judged = apply_cancels(taken, user, order, line).filter(F.col("cart_no").isNotNull()).groupBy(row_line).agg(
        F.max_by("line_after", F.struct(*_columns(list(order)))).alias("units"))
    return per.filter("NOT _takes").select("_line", "units").unionByName(judged).select("_line.*", "units")


def cart_lines(cancelled: DataFrame, cart_table: DataFrame, user: str = "user_id", order=("ts", "event_id"),
               line=STOCK_KEYS) -> DataFrame:
    """Lines of each cart after reserves, cancels and confirms: (user, cart, warehouse, product) ->
    units reserved."""
    last = cancelled.filter(F.col("cart_no").isNotNull()).groupBy(user, "cart_no", *line).agg(
        F.max_by("line_after", F.struct(*_columns(list(order)))).alias("units"))
    return last.filter(F.col("units") > 0).join(
        cart_table.select(user, "cart_no", "expires_at", "live"), [user, "cart_no"])


def returned_stock(cancelled: DataFrame, lines: DataFrame, keys=STOCK_KEYS) -> DataFrame:
    """Units going back to stock per (warehouse, product): accepted cancels, plus what every line of
    an expired cart still holds (the reference never returned those: its carts expired with the
    stock still taken).  Confirmed units are sold and do not come back."""
    keys = list(keys)
    c = cancelled.filter(F.col("outcome") == "cancelled") \
        .groupBy(*keys).agg(F.sum(F.col("quantity").cast("long")).alias("cancelled_units"))
    e = lines.filter(~F.col("live")).groupBy(*keys).agg(F.sum("units").alias("expired_units"))
    return c.join(e, keys, "full").select(
        *keys,
        F.coalesce("cancelled_units", F.lit(0)).alias("cancelled_units"),
        F.coalesce("expired_units", F.lit(0)).alias("expired_units"))


def cancel_all(lines: DataFrame, users: DataFrame, user: str = "user_id", keys=STOCK_KEYS) -> DataFrame:
    """For the given users, every live line is cancelled; the list of returned items per
    user (bounded by the distinct lines of that user's live carts)."""
    live = lines.filter(F.col("live")).join(users.select(user), user, "left_semi")
    per = live.groupBy(user, *keys).agg(F.sum("units").alias("quantity"))
    return per.groupBy(user).agg(
        F.sort_array(F.collect_list(F.struct(*keys, "quantity"))).alias("cancelled_items"),
        F.sum("quantity").alias("cancelled_units"))


def user_reservations(lines: DataFrame, user: str = "user_id", keys=STOCK_KEYS) -> DataFrame:
    """Live reservations of each user as a map "warehouse:product" -> units."""
    live = lines.filter(F.col("live")).groupBy(user, *keys).agg(F.sum("units").alias("units"))
    entry = F.struct(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("line"), "units")
    return live.groupBy(user).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("reservations"))


def reserved_quantity(product_id, warehouse_id) -> Column:
    """One line's reserved units from the map, 0 when absent."""
    return F.coalesce(F.col("reservations").getItem(f"{warehouse_id}:{product_id}"), F.lit(0).cast("long"))


def reserved_totals(lines: DataFrame, keys=STOCK_KEYS) -> DataFrame:
    """Reserved units per (warehouse, product) over all users' live carts."""
    return lines.filter(F.col("live")).groupBy(*keys).agg(F.sum("units").alias("reserved"))


def availability(stock: DataFrame, reserved: DataFrame, keys=STOCK_KEYS) -> DataFrame:
    """Physical, reserved (0 if none) and available = physical - reserved (not
    clamped at 0, as in the reference)."""
    keys = list(keys)
    j = stock.join(reserved, keys, "left")
    return j.select(*keys, F.col("quantity").alias("total_physical"),
                    F.coalesce("reserved", F.lit(0)).cast("long").alias("currently_reserved"),
                    (F.col("quantity") - F.coalesce("reserved", F.lit(0))).cast("long").alias("available_to_buy"))


# ------------------------------------------------------------------------------ events

def append_events(base: DataFrame | None, new: DataFrame, order_col: str = "delivery") -> DataFrame:
    """Idempotent append.  A repeated ``event_id`` keeps its first delivery; ids already in
    ``base`` are ignored.  The first copy is picked by an aggregate (``min_by``), which Spark
    pre-aggregates on every task, so one id delivered a million times is never one group in one
    task.  Returns the rows to append."""
    cols = [c for c in new.columns if c != "event_id"]
    first = new.groupBy("event_id").agg(F.min_by(F.struct(*cols), F.col(order_col)).alias("_e"))
    first = first.select("event_id", "_e.*")
    if base is not None:
        first = first.join(base.select("event_id"), "event_id", "left_anti")
    return first


def project_stock(initial: DataFrame, events: DataFrame, keys=STOCK_KEYS) -> DataFrame:
    """Stock rebuilt from the event log: initial + sum of signed event quantities."""
    return restock(initial, events, keys)


def stock_snapshot(initial: DataFrame, events: DataFrame, upto, keys=STOCK_KEYS) -> DataFrame:
    """The projection of the events before ``upto`` (each id once): what a replay starts from."""
    mark = F.lit(upto).cast("timestamp_ntz")
    return project_stock(initial, append_events(None, events.filter(F.col("timestamp") < mark)), keys)


def replay_stock(snapshot: DataFrame, log: DataFrame, since, keys=STOCK_KEYS, date_col: str | None = None, grain: str = "month") -> DataFrame:
    """The projection, from the snapshot of everything before ``since`` and the later events only.

    Copies of an event carry its time, so a redelivery after the snapshot of an event before it is not
    replayed, and one within the later events counts once.  With ``date_col`` (the log's partition column)
    the earlier partitions are not read.
    """
    later = log.filter(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    if date_col:
        day = F.to_date(F.lit(since).cast("timestamp_ntz"))
        later = later.filter(F.col(date_col) >= (F.trunc(day, "month") if grain == "month" else day))
    return project_stock(snapshot, append_events(None, later), keys)


def stock_drift(stored: DataFrame, projected: DataFrame, keys=STOCK_KEYS) -> DataFrame:
    """Keys where the stored stock and the projection differ (full outer join)."""
    keys = list(keys)
    s = stored.select(*keys, F.col("quantity").alias("stored"))
    p = projected.select(*keys, F.col("quantity").alias("projected"))
    j = s.join(p, keys, "full")
    return j.filter(~F.col("stored").eqNullSafe(F.col("projected"))) \
        .withColumn("drift", F.coalesce("stored", F.lit(0)) - F.coalesce("projected", F.lit(0)))


def log_drift(initial: DataFrame, events: DataFrame, keys=STOCK_KEYS, qty: str = "quantity",
              order_col: str = "delivery") -> DataFrame:
    """I13 in one pass over the event log: the stored counter (every delivery applied) against the
    projection (each event id once, its first delivery), for the keys of ``initial``.

    Redeliveries are copies of their event, so an event id has one key.  One aggregate per
    (event id, key) gives both the sum over deliveries and the first delivery's quantity; a second,
    per key, adds them up.  The log is scanned once, and no full outer join of two stock tables is
    needed.  Same result as ``stock_drift(restock(initial, events), project_stock(initial,
    append_events(None, events)))``.
    """
    keys = list(keys)
    q = F.col(qty).cast("long")
    per_event = events.groupBy("event_id", *keys).agg(
        F.sum(q).alias("_all"), F.min_by(q, F.col(order_col)).alias("_once"))
    per_key = per_event.groupBy(*keys).agg(F.sum("_all").alias("_all"), F.sum("_once").alias("_once"))
    j = initial.select(*keys, F.col("quantity").cast("long").alias("_q0")).join(per_key, keys, "left")
    stored = F.col("_q0") + F.coalesce(F.col("_all"), F.lit(0))
    projected = F.col("_q0") + F.coalesce(F.col("_once"), F.lit(0))
    out = j.select(*keys, stored.alias("stored"), projected.alias("projected"))
    return out.filter(~F.col("stored").eqNullSafe(F.col("projected"))) \
        .withColumn("drift", F.coalesce("stored", F.lit(0)) - F.coalesce("projected", F.lit(0)))


def movements(events: DataFrame, lo, hi, product_id=None, keys=STOCK_KEYS) -> DataFrame:
    """Movement history over [lo, hi) with the running balance change per key (hot keys
    are split by the chunked scan, not sorted on one task)."""
    e = events.filter((F.col("timestamp") >= F.lit(lo).cast("timestamp_ntz"))
                      & (F.col("timestamp") < F.lit(hi).cast("timestamp_ntz")))
    if product_id is not None:
        e = e.filter(F.col("product_id") == product_id)
    return running_sum(e, list(keys), ["timestamp", "event_id"], "quantity", "running_change")


def upsert(base: DataFrame, changes: DataFrame, keys, order_col: str) -> DataFrame:
    """Union + last value per key wins (by ``order_col``; base rows count as oldest).
    ``max_by`` is an aggregate, so a key changed very often is pre-aggregated per task."""
    keys = list(keys)
    cols = [c for c in base.columns if c not in keys]
    cols = [c for c in cols if c != order_col]
    otype = changes.schema[order_col].dataType
    u = base.select(*keys, *cols, F.lit(None).cast(otype).alias("_o"), F.lit(0).alias("_src")) \
        .unionByName(changes.select(*keys, *cols, F.col(order_col).alias("_o"), F.lit(1).alias("_src")))
    # changes beat the base row; among changes the latest wins
    last = u.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("_src", "_o")).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in cols])


def set_stock(stock: DataFrame, changes: DataFrame, products: DataFrame, warehouses: DataFrame,
              order_col: str = "ts"):
    """Set absolute stock values, only for a known product and warehouse.

    Returns (new_stock, rejects).  Rejects carry the reason (J09 anti joins); accepted changes
    are applied last-value-wins per key (S13).
    """
    p = products.select(F.col("id").alias("product_id"))
    w = warehouses.select(F.col("id").alias("warehouse_id"))
    known_p = changes.join(p, "product_id", "left_semi")
    ok = known_p.join(w, "warehouse_id", "left_semi")
    rej_p = changes.join(p, "product_id", "left_anti").withColumn("reason", F.lit("product not found"))
    rej_w = known_p.join(w, "warehouse_id", "left_anti").withColumn("reason", F.lit("warehouse not found"))
    new_stock = upsert(stock.select("warehouse_id", "product_id", "quantity"),
                       ok.select("warehouse_id", "product_id", "quantity", order_col),
                       STOCK_KEYS, order_col)
    return new_stock, rej_p.unionByName(rej_w)
