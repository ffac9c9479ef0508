"""What the event-time streams do with their due rows (Z03 cart expiry, Z05 guarded decrement, Z07
sessions): the batch operators, started from what the keys had come to."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.inventory import STOCK_KEYS, assign_carts, cart_line_units, settle
from tidemark.plans.chunked import gap_sessions
from tidemark.session import saved
from tidemark.streaming.microbatch import EventTimeJob, struct


def _of(rows: DataFrame, few: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join; as structs, nulls equal each other."""
    return rows.withColumn("_m", F.struct(*columns)).join(few.select(F.struct(*columns).alias("_m")), "_m", how).drop("_m")


def settle_job(stock: DataFrame, requests: T.StructType, order: list[str], keys=STOCK_KEYS, ts_col: str = "ts") -> EventTimeJob:
    """Accept a request if the balance covers it, in request order (I01).  A key starts from its
    row of ``stock`` and goes on from its last balance; without a stock row everything is rejected."""
    keys = list(keys)
    state = T.StructType([*[requests[k] for k in keys], T.StructField("quantity", T.LongType())])
    output = T.StructType([*requests.fields, T.StructField("accepted", T.BooleanType()), T.StructField("balance_after", T.LongType())])

    def step(due: DataFrame, balances: DataFrame, horizon):
        asked = saved(due.select(*keys).distinct(), "settle-keys")
        known = _of(balances, asked, keys)
        first = _of(stock.select(*keys, F.col("quantity").cast("long").alias("quantity")), asked, keys)
        start = saved(_of(first, known, keys, "left_anti").unionByName(known), "settle-start")

        def last(out: DataFrame) -> DataFrame:
            return _of(out.groupBy(*keys).agg(F.max_by("balance_after", F.struct(*order)).alias("quantity")), start, keys)

        return settle(start, due, order, keys), last

    return EventTimeJob(keys, state, output, step, ts_col)


_LONG, _TIME = T.LongType(), T.TimestampNTZType()

CART_STATE = struct(user_id=_LONG, cart_no=_LONG, opened_by=_TIME, ttl=_LONG, warehouse_id=_LONG, product_id=_LONG, units=_LONG)
CART_OUT = struct(user_id=_LONG, cart_no=_LONG, warehouse_id=_LONG, product_id=_LONG, units=_LONG, expires_at=_TIME)


def carts_job() -> EventTimeJob:
    """The lines that closed carts still hold: the units that go back to stock.

    A user's state is the number of their last cart, with the time and ttl of its last reserve and its lines
    while it is open.  An open cart comes back as reserves of that time and ttl, before all due rows.
    """
    def step(due: DataFrame, state: DataFrame, horizon):
        expiry = F.timestamp_add("SECOND", F.col("ttl"), F.col("opened_by")).cast("timestamp_ntz")
        # a user's rows of the state have one expiry
        asked = due.select(F.struct("user_id").alias("_m")).distinct().withColumn("_due", F.lit(True))
        state = saved(state.withColumn("_m", F.struct("user_id")).join(asked, "_m", "left")
                      .filter(F.col("_due") | (expiry <= horizon)).drop("_m", "_due"), "cart-state")
        again = state.filter(F.col("opened_by").isNotNull()).select(
            "user_id", F.lit(None).cast("long").alias("event_id"), F.lit("reserve").alias("action"),
            F.coalesce("warehouse_id", F.lit(-1)).alias("warehouse_id"), F.coalesce("product_id", F.lit(-1)).alias("product_id"),
            F.coalesce("units", F.lit(0)).alias("quantity"), F.col("opened_by").alias("ts"), "ttl")
        log = again.unionByName(due.select("user_id", F.col("event_id").cast("long").alias("event_id"), "action", F.col("warehouse_id").cast("long").alias("warehouse_id"),
                                           F.col("product_id").cast("long").alias("product_id"), F.col("quantity").cast("long").alias("quantity"),
                                           "ts", F.col("ttl").cast("long").alias("ttl")))
        rows = saved(assign_carts(log).filter(F.col("cart_no").isNotNull()), "cart-rows")
        # carts are numbered on from the last one; an open one keeps its number
        before = state.groupBy("user_id").agg((F.max("cart_no") - F.max(F.col("opened_by").isNotNull().cast("long"))).alias("_before"))
        cart = F.struct("user_id", "cart_no").alias("_cart")
        by = F.struct("ts", "event_id")
        lines = cart_line_units(rows).filter("units > 0").select(cart, "warehouse_id", "product_id", "units")
        last = F.max_by(F.struct("ts", "ttl", "expires_at"), by)
        carts = rows.filter("action = 'reserve'").groupBy(cart).agg(last.alias("_r")).select(
            "_cart", F.struct("_cart.user_id").alias("_user"), F.col("_cart.cart_no").alias("_no"), "_r.*")
        newest = carts.groupBy("_user").agg(F.max("_no").alias("_newest"))
        carts = saved(carts.join(newest, "_user").join(before.select(F.struct("user_id").alias("_user"), "_before"), "_user", "left")
                      .withColumn("number", F.col("_no") + F.coalesce("_before", F.lit(0)))
                      .withColumn("closed", (F.col("_no") < F.col("_newest")) | (F.col("expires_at") <= horizon)), "carts")
        held = carts.join(lines, "_cart", "left")
        out = held.filter("closed AND units IS NOT NULL").select(
            F.col("_user.user_id").alias("user_id"), F.col("number").alias("cart_no"), "warehouse_id", "product_id", "units", "expires_at")
        still = held.filter(~F.col("closed")).select(
            F.col("_user.user_id").alias("user_id"), F.col("number").alias("cart_no"), F.col("ts").alias("opened_by"), "ttl",
            "warehouse_id", "product_id", "units")
        done = carts.filter((F.col("_no") == F.col("_newest")) & F.col("closed")).select(
            F.col("_user.user_id").alias("user_id"), F.col("number").alias("cart_no"), F.lit(None).cast("timestamp_ntz").alias("opened_by"),
            *[F.lit(None).cast("long").alias(c) for c in ("ttl", "warehouse_id", "product_id", "units")])
        return out, still.unionByName(done)

    return EventTimeJob(["user_id"], CART_STATE, CART_OUT, step)


SESSION_STATE = struct(user_id=_LONG, first_event=_TIME, last_event=_TIME, events=_LONG)
SESSION_OUT = struct(user_id=_LONG, session_start=_TIME, session_end=_TIME, events=_LONG)


def sessions_job(gap: str = "30 minutes", user_col: str = "user_id") -> EventTimeJob:
    """Sessions per user, once nothing can join them any more (as the batch form: a new one after
    more than ``gap`` without events)."""
    gap_us = int(pd.Timedelta(gap) / pd.Timedelta(microseconds=1))
    end = F.timestamp_add("MICROSECOND", F.lit(gap_us), F.col("last_event")).cast("timestamp_ntz")

    def step(due: DataFrame, state: DataFrame, horizon):
        own = due.select(F.col(user_col).cast("long").alias("user_id"), "ts", F.col("ts").alias("first_event"), F.lit(1).cast("long").alias("n"))
        over = state.filter(end <= horizon).select("user_id")
        users = saved(own.select("user_id").unionByName(over).distinct(), "session-users")
        state = _of(state, users, ["user_id"])
        rows = own.unionByName(state.select("user_id", F.col("last_event").alias("ts"), "first_event", F.col("events").alias("n")))
        numbered = gap_sessions(rows, ["user_id"], ["ts"], "ts", gap_us)
        per = numbered.groupBy(F.struct("user_id").alias("_user"), "session_no").agg(
            F.min("first_event").alias("first_event"), F.max("ts").alias("last_event"), F.sum("n").alias("events"))
        newest = per.groupBy("_user").agg(F.max("session_no").alias("_newest"))
        per = saved(per.join(newest, "_user").withColumn("closed", (F.col("session_no") < F.col("_newest")) | (end <= horizon))
                    .withColumn("user_id", F.col("_user.user_id")), "sessions")
        out = per.filter("closed").select("user_id", F.col("first_event").alias("session_start"), end.alias("session_end"), "events")
        still = per.filter("NOT closed").select("user_id", "first_event", "last_event", "events")
        done = per.filter((F.col("session_no") == F.col("_newest")) & F.col("closed")).select(
            "user_id", *[F.lit(None).cast(SESSION_STATE[c].dataType).alias(c) for c in ("first_event", "last_event", "events")])
        return out, still.unionByName(done)

    return EventTimeJob(["user_id"], SESSION_STATE, SESSION_OUT, step)
