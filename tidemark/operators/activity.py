"""User-activity analytics (U01-U12), the daily rollup (A15), the event-type dictionary join
(J10) and batch sessions (Z07).

Distinct counts are exact by default (``exact=False`` switches to HyperLogLog).  Where a query
needs several distinct counts over the same rows, it aggregates level by level (e.g. user x day
x session, then user x day, then user) instead of one aggregate with several DISTINCTs, which
Spark would run through an Expand that multiplies the rows.  Reports (U05, U07-U10, U12) come
out sorted (T05): the sort sees one row per hour, week, type, country, device or weekday.  Every level keeps Spark's
partial (map-side) aggregation, so a user holding a third of the events is pre-reduced on every
task before anything is shuffled.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import between_ts, iso_weekday, week_start_sunday, weekday_name
from tidemark.functions.numeric import pct, round_half_up


def share_total(col: str) -> Column:
    """The column's total over a *grouped* result, as a whole-table window.  Used only on
    results with a bounded number of groups (event types, devices, hours of a period), where it
    saves the second scan of the events a scalar subquery would cost."""
    return F.sum(col).over(Window.partitionBy())


def users(col: str = "user_id", exact: bool = True) -> Column:
    """Distinct users, exact or HyperLogLog (rsd 1%)."""
    return F.count_distinct(F.col(col)) if exact else F.approx_count_distinct(F.col(col), 0.01)


def money_sum(col: str) -> Column:
    """Exact sum of a cents-valued DOUBLE column, returned as DOUBLE."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


# ---------------------------------------------------------------------------- lookups

def user_profile(events: DataFrame, user, lo, hi, user_col: str = "user_id",
                 date_col: str | None = None, exact: bool = True, grain: str = "day") -> DataFrame:
    """One user's events in [lo, hi): count, first/last, total value, sessions."""
    f = between_ts(events.filter(F.col(user_col) == F.lit(user)), lo, hi, "ts", date_col, grain)
    return f.agg(
        F.count(F.lit(1)).alias("events"),
        F.min("ts").alias("first_event"),
        F.max("ts").alias("last_event"),
        money_sum("event_value").alias("total_value"),
        users("session_id", exact).alias("sessions"),
    )


def user_event_count(events: DataFrame, user, lo, hi, user_col: str = "user_id",
                     date_col: str | None = None, grain: str = "day") -> DataFrame:
    """U01, count-only form."""
    f = between_ts(events.filter(F.col(user_col) == F.lit(user)), lo, hi, "ts", date_col, grain)
    return f.agg(F.count(F.lit(1)).alias("events"))


def hour_activity(events: DataFrame, lo, hi, user_col: str = "user_id",
                  date_col: str | None = None, exact: bool = True, grain: str = "day") -> DataFrame:
    """U02 (and U03 over a date range): events and distinct users in [lo, hi)."""
    f = between_ts(events, lo, hi, "ts", date_col, grain)
    return f.agg(F.count(F.lit(1)).alias("events"), users(user_col, exact).alias("unique_users"))


range_activity = hour_activity


# --------------------------------------------------------------------------- summaries

def dau_wau_mau(events: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Average daily users, average weekly users (Sunday weeks), all users, as rows.

    One linear pipeline over one scan: grouping sets (day, user), (week, user), (user) give the
    distinct pairs of all three levels at once (Expand + partial aggregation on every task),
    then counts per bucket, then the mean per level.  Three separate aggregates would each scan
    and shuffle the events (Spark optimises the branches apart, so no exchange is shared).
    """
    g = events.select(F.col(user_col).alias("u"), F.to_date("ts").alias("day")) \
        .withColumn("week", week_start_sunday("day"))
    sets = g.groupingSets([["day", "u"], ["week", "u"], ["u"]], "day", "week", "u") \
        .agg(F.grouping_id().alias("gid"))
    per_bucket = sets.groupBy("gid", "day", "week").agg(F.count(F.lit(1)).alias("n"))
    per_level = per_bucket.groupBy("gid").agg(F.avg("n").alias("avg_n"))
    # grouping_id bits: day = 4, week = 2, u = 1 (set bit = column not grouped)
    metric = F.when(F.col("gid") == 2, "DAU (avg)").when(F.col("gid") == 4, "WAU (avg)").otherwise("MAU")
    return per_level.select(metric.alias("metric"), round_half_up("avg_n", 0).alias("value"))


def sorted_report(df: DataFrame, *order) -> DataFrame:
    """A finished report in order: a handful of rows (hours, weekdays, weeks, types, countries), sorted in one
    partition; a global sort would sample them in a job of its own first."""
    return df.repartition(1).sortWithinPartitions(*order)


def hourly_profile(events: DataFrame, user_col: str = "user_id", exact: bool = True) -> DataFrame:
    """Per hour of day: events, distinct users, mean duration rounded to seconds."""
    per = events.groupBy(F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("events"),
        users(user_col, exact).alias("unique_users"),
        round_half_up(F.avg("duration"), 0).alias("avg_duration_sec"),
    )
    return sorted_report(per, "hour")


def top_users(events: DataFrame, k: int = 20, user_col: str = "user_id") -> DataFrame:
    """Most active users: events, active days, sessions, minutes, events/day, lifetime.

    Three aggregation levels (user x day x session -> user x day -> user) replace three DISTINCTs.
    A session id is a hash of (user, hour), so every session lies within one day.
    """
    u = F.col(user_col)
    per_session = events.groupBy(u.alias("user_id"), F.to_date("ts").alias("day"), "session_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("dur"))
    per_day = per_session.groupBy("user_id", "day").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("sessions"), F.sum("dur").alias("dur"))
    per_user = per_day.groupBy("user_id").agg(
        F.sum("n").alias("total_events"),
        F.count(F.lit(1)).alias("active_days"),
        F.sum("sessions").alias("total_sessions"),
        (F.sum("dur") / F.lit(60.0)).alias("total_minutes"),
        F.min("day").alias("d0"), F.max("day").alias("d1"),
    )
    out = per_user.select(
        "user_id", "total_events", "active_days", "total_sessions", "total_minutes",
        round_half_up(F.col("total_events") / F.col("active_days"), 1).alias("events_per_day"),
        F.datediff("d1", "d0").alias("lifetime_days"),
    )
    return out.orderBy(F.col("total_events").desc(), F.col("user_id").asc()).limit(k)


def retention(events: DataFrame, weeks: int = 3, user_col: str = "user_id") -> DataFrame:
    """Weekly cohorts (week of first activity, Sunday weeks): size, users active in
    weeks 0..n after, and percentages for weeks 1..n.

    One shuffle on the user: each user's set of active weeks is collected with map-side partial
    aggregation.  The set holds at most one entry per calendar week of the data, whatever the
    user's row count, so a user with a third of all events still sends a few dozen values.  The
    cohort week is the set's minimum; the final aggregate is per cohort.
    """
    week = week_start_sunday("ts")
    per_user = events.groupBy(F.col(user_col).alias("user_id")).agg(F.collect_set(week).alias("_weeks"))
    wk = per_user.select(F.array_min("_weeks").alias("cohort_week"), "_weeks")
    # offsets of the active weeks from the cohort week (whole weeks: all dates are Sundays)
    wk = wk.select("cohort_week", F.transform(
        "_weeks", lambda w: (F.datediff(w, F.col("cohort_week")) / 7).cast("int")).alias("_off"))
    aggs = [F.count(F.lit(1)).alias("cohort_size")]
    aggs += [F.count_if(F.array_contains("_off", i)).alias(f"week_{i}") for i in range(weeks + 1)]
    per = wk.groupBy("cohort_week").agg(*aggs)
    cols = ["cohort_week", "cohort_size"] + [f"week_{i}" for i in range(weeks + 1)]
    cols += [pct(f"week_{i}", "cohort_size", 1).alias(f"retention_w{i}_pct") for i in range(1, weeks + 1)]
    return sorted_report(per.select(*cols), "cohort_week")


def event_mix(events: DataFrame, user_col: str = "user_id", exact: bool = True) -> DataFrame:
    """Per event type: events, distinct users, share of all events (%)."""
    per = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                           users(user_col, exact).alias("unique_users"))
    out = per.select("event_type", "events", "unique_users",
                     pct(F.col("events"), share_total("events"), 2).alias("pct_of_total"))
    return sorted_report(out, F.col("events").desc(), "event_type")


def country_mix(events: DataFrame, user_col: str = "user_id", exact: bool = True) -> DataFrame:
    """Per country: events, users, events per user, mean duration."""
    per = events.groupBy("country").agg(
        F.count(F.lit(1)).alias("events"), users(user_col, exact).alias("users"),
        F.avg("duration").alias("_d"))
    out = per.select("country", "events", "users",
                     round_half_up(F.col("events") / F.col("users"), 1).alias("events_per_user"),
                     round_half_up("_d", 1).alias("avg_duration"))
    return sorted_report(out, F.col("events").desc(), "country")


def device_conversion(events: DataFrame, purchase: str = "purchase", user_col: str = "user_id",
                      exact: bool = True) -> DataFrame:
    """Per device: events, users, purchase value, purchases, purchases per user (%)."""
    is_p = F.col("event_type") == purchase
    per = events.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("events"), users(user_col, exact).alias("users"),
        F.sum(F.when(is_p, F.col("event_value").cast("decimal(18,2)"))).alias("_v"),
        F.count_if(is_p).alias("purchases"))
    out = per.select("device_type", "events", "users",
                     round_half_up(F.coalesce("_v", F.lit(0)), 2).alias("total_purchase_value"),
                     "purchases", pct("purchases", "users", 2).alias("conversion_rate_pct"))
    return sorted_report(out, F.col("events").desc(), "device_type")


def peak_hours(events: DataFrame, q: float = 0.95, k: int = 20, user_col: str = "user_id",
               exact: bool = True) -> DataFrame:
    """(day, hour) buckets with more requests than the q-quantile of all buckets, top k.

    The bucket table has one row per hour of the covered period, whatever the data volume, so
    the exact percentile over it is cheap; it is computed as a window over that table, so the
    events are scanned once.
    """
    hourly = events.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("requests"), users(user_col, exact).alias("users"))
    # one row per hour of the period: the whole-table window holds (days x 24) rows at most
    threshold = F.percentile("requests", q).over(Window.partitionBy())
    out = hourly.withColumn("_thr", threshold).filter(F.col("requests") > F.col("_thr")).select(
        "day", "hour", "requests", "users",
        round_half_up(F.col("requests") / F.lit(3600.0), 2).alias("req_per_sec"))
    return out.orderBy(F.col("requests").desc(), F.col("day").asc(), F.col("hour").asc()).limit(k)


def weekday_load(events: DataFrame, literal: bool = True, user_col: str = "user_id") -> DataFrame:
    """Load by weekday (Monday = 1).

    ``literal=True`` reproduces the reference query: its inner GROUP BY (day, ts, user) makes
    one row per distinct (ts, user) pair, so each day is weighted by its number of pairs n:
    avg_events = sum(n^2)/sum(n), avg_users = sum(n*u)/sum(n).  ``literal=False`` is the plain
    mean of daily event counts and daily users.  Both aggregate per day first (no window).
    """
    day = F.to_date("ts").alias("day")
    if literal:
        pairs = events.select(day, "ts", F.col(user_col).alias("u")).distinct()
        per_day = pairs.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("du"))
        agg = [(F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("avg_events"),
               (F.sum(F.col("n") * F.col("du")) / F.sum("n")).alias("avg_users")]
    else:
        per_day = events.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(user_col).alias("du"))
        agg = [F.avg("n").alias("avg_events"), F.avg("du").alias("avg_users")]
    return sorted_report(per_day.groupBy(iso_weekday("day").alias("day_num"), weekday_name("day").alias("day_name")).agg(*agg), "day_num")


# --------------------------------------------------------------------------- rollups

def daily_rollup(events: DataFrame, sketch: bool = False, user_col: str = "user_id") -> DataFrame:
    """Per (day, country, device): events, users, duration, value.

    ``sketch=True`` carries distinct users as an HLL sketch (``users_sketch``), so rollups of
    separate batches merge without double counting (``merge_rollups``).
    """
    aggs = [F.count(F.lit(1)).alias("event_count"),
            F.sum("duration").cast("long").alias("total_duration"),
            F.sum(F.col("event_value").cast("decimal(18,2)")).alias("total_value")]
    if sketch:
        aggs.append(F.hll_sketch_agg(F.col(user_col), 12).alias("users_sketch"))
    else:
        aggs.append(F.count_distinct(user_col).alias("unique_users"))
    return events.groupBy(F.to_date("ts").alias("day"), "country", "device_type").agg(*aggs)


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """Merge sketch rollups of disjoint batches (sums add, sketches union)."""
    u = rollups[0]
    for r in rollups[1:]:
        u = u.unionByName(r)
    return u.groupBy("day", "country", "device_type").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("total_duration").alias("total_duration"),
        F.sum("total_value").alias("total_value"),
        F.hll_union_agg("users_sketch", True).alias("users_sketch"),
    )


def rollup_estimates(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("unique_users_est", F.hll_sketch_estimate("users_sketch")).drop("users_sketch")


def with_event_type(events: DataFrame, types: DataFrame, on: str = "event_type") -> DataFrame:
    """Code -> (id, name, weight) through the dictionary.  The dictionary is a literal
    table of a handful of rows, so it is broadcast."""
    t = types.select(F.col("event_name").alias(on), F.col("event_id").alias("type_id"), "event_weight")
    return events.join(F.broadcast(t), on, "left")


def sessions(events: DataFrame, gap: str = "30 minutes", user_col: str = "user_id",
             method: str = "chunked") -> DataFrame:
    """Z07 (batch): sessions per user, a new one after more than ``gap`` without events.

    ``method='chunked'`` numbers sessions with the range-partitioned ordered scan (a user with a
    third of all events is split over tasks), then aggregates per (user, session).
    ``method='window'`` is Spark's ``session_window`` (one user's rows sorted in one task).
    Both give session_end = last event + gap.
    """
    if method == "window":
        s = events.groupBy(F.col(user_col).alias("user_id"), F.session_window("ts", gap).alias("w")).agg(
            F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))
        return s.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                        "events", "first_event", "last_event")
    from tidemark.plans.chunked import gap_sessions

    gap_us = int(pd.Timedelta(gap).total_seconds() * 1_000_000)
    # Rows with equal ts always share a session, so the event id is only a tie-break that lets a
    # range cut split a (user, ts) run; it is optional.
    tie = ["event_id"] if "event_id" in events.columns else []
    ev = events.select(F.col(user_col).alias("user_id"), "ts", *tie)
    numbered = gap_sessions(ev, ["user_id"], ["ts", *tie], "ts", gap_us)
    per = numbered.groupBy("user_id", "session_no").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_event"), F.max("ts").alias("last_event"))
    return per.select("user_id", F.col("first_event").alias("session_start"),
                      F.timestamp_add("MICROSECOND", F.lit(gap_us), F.col("last_event")).alias("session_end"),
                      "events", "first_event", "last_event")
