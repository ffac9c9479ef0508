"""I08 with give-back: reserves take stock, cancels and expired carts return it to later reserves.

Two folds depend on each other.  Whether a reserve is accepted depends on its product's stock, and so on what
other users' carts have given back by then; when a cart expires and what it holds depends on which of its
user's reserves were accepted.  No key holds all rows of such a chain, so the answer is found in rounds:

1. Foretell which reserves are refused: the log is cut into slices of time, and each slice is followed row by row
   from the stock and the open carts' lines that the slices before it left (``_foretold``).  A task reads one slice
   of a warehouse (of the log, if some user buys from several), and holds the state of that, not the rows.
2. With these, carts, cancels and expiries follow user by user (``assign_carts``, ``apply_cancels``), and with them
   the units that come back, each with its time; give-backs and all rows are folded product by product
   (``guarded_fold``), which says which reserves are refused.  If they are the foretold ones, this is the result.
3. If not (rows whose cart has no expiry, say), the refusals are settled in rounds: the users with a reserve that
   was judged differently are worked out again, then the products whose give-backs changed thereby, and so on until
   no judgement changes, and step 2 is taken again.

Everything depends on earlier rows only, so each round settles at least the earliest row still wrong; there is
one fixed point and the rounds end in it, wherever they begin.  Rounds alone would follow how often scarce stock
changes hands; the slices follow the number of rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.dates import ntz_micros
from tidemark.operators.inventory import STOCK_KEYS, apply_cancels, assign_carts
from tidemark.plans.guarded import guarded_fold
from tidemark.session import range_partitions, saved, ship_package

EXPIRY, ROW = 0, 1  # of one moment, expiries come before the rows of the log
SLICE_ROWS = 1_000_000  # of the log, about, in a slice of time
STOCK, LINE, RESERVE, CANCEL, CONFIRM = range(5)  # what a row of a slice is; the state comes first


def _carts_of(rows: DataFrame, user: str, order: list, keys: list[str]) -> DataFrame:
    """The rows with their cart, outcome and what is left on their line; written once."""
    assigned = assign_carts(rows, user, order)
    return saved(apply_cancels(assigned, user, order, keys), "reserve-carts")


def _give_backs(rows: DataFrame, user: str, order: list, keys: list[str]) -> DataFrame:
    """What comes back: (user, keys, order columns, kind, units) of accepted cancels, and of every line
    of a cart at its expiry."""
    time, *rest = order
    in_cart = rows.filter(F.col("cart_no").isNotNull())
    by = F.struct(*order)
    cart = F.struct(user, "cart_no").alias("_cart")  # as a struct, a null user is one user
    expiry = in_cart.filter("action = 'reserve'").groupBy(cart).agg(F.max_by("expires_at", by).alias(time))
    left = in_cart.groupBy(cart, *keys).agg(F.max_by("line_after", by).alias("units")).filter("units > 0")
    expired = left.join(expiry, "_cart").select(F.col(f"_cart.{user}").alias(user), *keys, time, "units")
    for c in rest:
        expired = expired.withColumn(c, F.lit(None).cast(rows.schema[c].dataType))
    cancelled = rows.filter("outcome = 'cancelled'").select(user, *keys, *order, F.col("quantity").cast("long").alias("units"))
    return cancelled.withColumn("_kind", F.lit(ROW)).unionByName(expired.withColumn("_kind", F.lit(EXPIRY)))


def _judged(stock: DataFrame, rows: DataFrame, give_backs: DataFrame, order: list, keys: list[str], keep: list[str]) -> DataFrame:
    """``rows`` (with ``_delta``: what they take, or change at once) folded with the stock and the
    give-backs; adds ``accepted`` and ``balance_after``."""
    time, *rest = order
    first = stock.select(*keys, F.col("quantity").cast("long").alias("_start0"), F.lit(-1).alias("_kind"))
    back = give_backs.select(*keys, *order, "_kind", F.col("units").alias("_delta"))
    both = rows.withColumns({"_kind": F.lit(ROW), "_mine": F.lit(True)}) \
        .unionByName(back, allowMissingColumns=True).unionByName(first, allowMissingColumns=True)
    both = both.withColumn("_stock", F.col("_kind") >= 0)  # the stock row of a key first
    out = guarded_fold(both, keys, ["_stock", time, "_kind", *rest], "_delta", "_start0", keep=[*keep, "_mine"])
    return out.filter("_mine").drop("_mine")


def _matching(rows: DataFrame, few: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Semi or anti join; as structs, nulls equal each other."""
    return rows.withColumn("_m", F.struct(*columns)).join(few.select(F.struct(*columns).alias("_m")), "_m", how).drop("_m")


class _Shop:
    """Stock and open carts of one part of the log, row by row."""

    def __init__(self):
        self.left, self.lines, self.until, self.timers = {}, defaultdict(dict), {}, []

    def expire(self, now: int) -> None:
        while self.timers and self.timers[0][0] <= now:
            at, _, user = heapq.heappop(self.timers)
            if self.until.get(user) == at:
                for product, n in self.lines.pop(user, {}).items():
                    self.left[product] += n
                del self.until[user]

    def keep(self, user, until: int) -> None:
        if self.until.get(user) != until:
            self.until[user] = until
            heapq.heappush(self.timers, (until, len(self.timers), user))

    def take(self, what: int, user, product: tuple, n: int | None, now: int | None, until: int | None) -> bool:
        """Whether a row of the log is refused; only reserves are told."""
        if now is not None:
            self.expire(now)
        if what == RESERVE:
            left = self.left.get(product)
            if n is None or n < 0 or left is None or (now is not None and 0 < n > left):
                return True
            if until is not None:  # else what the cart holds comes back before everything
                self.left[product] = left - n
                mine = self.lines[user]
                mine[product] = mine.get(product, 0) + n
                self.keep(user, until)
        elif n is not None and n > 0 and user in self.until:
            mine = self.lines[user]
            if mine.get(product, 0) >= n:
                mine[product] -= n
                if what == CANCEL:
                    self.left[product] += n
        return False

    def state(self) -> Iterator[tuple]:
        """(what, user, product, units, until) of the stock and of the lines that hold units."""
        for product, n in self.left.items():
            yield STOCK, None, product, n, None
        for user, mine in self.lines.items():
            for product, n in mine.items():
                if n > 0:
                    yield LINE, user, product, n, self.until[user]


def _followed(rows: DataFrame, user: str, keys: list[str], order: list) -> DataFrame:
    """The state and a slice's rows, part by part in order: ids of refused reserves (what = RESERVE), new state."""
    names = ["_what", "_part", user, *keys, "_units", "_until", "_id"]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.select(*names).schema])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(part, shop: _Shop, refused: list, closed: bool) -> pa.RecordBatch:
            out = [(RESERVE, part, None, *[None] * len(keys), None, None, i) for i in refused]
            if closed:
                out += [(what, part, who, *product, n, until, None) for what, who, product, n, until in shop.state()]
            columns = zip(*out) if out else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        part, shop, refused = None, None, []
        for batch in batches:
            what, parts, users, units, until, at, ids = (
                batch.column(c).to_pylist() for c in ("_what", "_part", user, "_units", "_until", "_at", "_id"))
            products = zip(*[batch.column(c).to_pylist() for c in keys])
            for k, p, who, product, n, end, now, i in zip(what, parts, users, products, units, until, at, ids):
                if shop is None or p != part:
                    if shop is not None:
                        yield told(part, shop, refused, True)
                    part, shop, refused = p, _Shop(), []
                if k == STOCK:
                    shop.left.setdefault(product, n)
                elif k == LINE:
                    shop.lines[who][product] = n
                    shop.keep(who, end)
                elif shop.take(k, who, product, n, now, end):
                    refused.append(i)
            if refused:
                yield told(part, shop, refused, False)
                refused = []
        if shop is not None:
            yield told(part, shop, refused, True)

    by = ["_part", F.when(F.col("_what") <= LINE, F.col("_what")).otherwise(LINE + 1), "_at", *order]
    ordered = rows.repartition("_part").sortWithinPartitions(*by).select(*names, "_at")
    return ordered.mapInArrow(run, schema)


def _foretold(stock: DataFrame, log: DataFrame, user: str, order: list, keys: list[str], slice_rows: int) -> DataFrame:
    """Ids of the reserves of ``log`` that are refused, slice of time by slice of time."""
    ship_package(log.sparkSession)
    time, place = order[0], keys[0]
    # users who buy in one place only leave the places independent of each other
    places = log.groupBy(F.struct(user).alias("_u")).agg(F.min(F.struct(place)).alias("_a"), F.max(F.struct(place)).alias("_b"))
    apart = places.filter("NOT (_a <=> _b)").isEmpty()
    part = F.col(place).cast("string") if apart else F.lit(None).cast("string")
    at = ntz_micros(time)
    what = F.when(F.col("action") == "reserve", RESERVE).when(F.col("action") == "cancel", CANCEL).when(F.col("action") == "confirm", CONFIRM)
    rows = log.select("_id", user, *keys, *[c for c in order if c not in ("_id", user, *keys)], what.alias("_what"), part.alias("_part"),
                      F.col("quantity").cast("long").alias("_units"), at.alias("_at"),
                      (at + F.col("ttl").cast("long") * 1_000_000).alias("_until")).filter("_what IS NOT NULL")
    # laid out by time, so that a slice reads its own row groups
    rows = saved(rows.repartitionByRange(range_partitions(log), "_at").sortWithinPartitions("_at"), "reserve-slices")
    n = -(-rows.count() // slice_rows)
    cuts = sorted(set(rows.agg(F.percentile_approx("_at", [i / n for i in range(1, n)], 10_000).alias("c")).first()["c"] or [])) if n > 1 else []
    held = _matching(stock, rows.select(*keys).distinct(), keys, "left_semi")
    state = held.select(F.lit(STOCK).alias("_what"), part.alias("_part"), *keys, F.col("quantity").cast("long").alias("_units"))
    refused = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        one = rows if low is None else rows.filter(F.col("_at") > low)
        if high is not None:  # rows without a time come first
            one = one.filter(F.col("_at") <= high if low is not None else F.col("_at").isNull() | (F.col("_at") <= high))
        told = saved(_followed(one.unionByName(state, allowMissingColumns=True), user, keys, order), "reserve-slice")
        refused.append(told.filter(F.col("_what") == RESERVE).select("_id"))
        state = told.filter(F.col("_what") <= LINE).drop("_id")
    out = refused[0]
    for more in refused[1:]:
        out = out.unionByName(more)
    return out


def reserve_with_give_back(stock: DataFrame, cart_log: DataFrame, user: str = "user_id", order=("ts", "event_id"),
                           keys=STOCK_KEYS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per row of ``cart_log`` (actions reserve, cancel, confirm), with

    outcome             reserved, refused_stock, refused_invalid (null or negative quantity), cancelled,
                        refused_exceeds, refused_no_cart, confirmed or confirmed_unreserved
    reserved_quantity   units taken by a reserve, 0 if refused
    remaining_quantity  the product's stock after the row
    cart_no, expires_at, line_after   the cart row that a reserve makes or a cancel or confirm changes; null
                        for refused reserves

    ``order`` names the columns that order the log, time first, and should end with a unique one.  Of one
    moment, carts that expire then return their units before the log's rows are judged.  A product
    without a stock row has none.  A cart that is still open at the end gives nothing back.  ``slice_rows`` of the log,
    about, are followed at a time.
    """
    order, keys = list(order), list(keys)
    if any(not isinstance(c, str) for c in order):
        raise ValueError("order columns by name")
    needed = [user, *keys, *order, "action", "quantity", "ttl"]
    order.append("_id")  # rows of one place in the order keep one
    log = saved(cart_log.select(*dict.fromkeys(needed), F.struct(*cart_log.columns).alias("_row"),
                                F.monotonically_increasing_id().alias("_id")), "reserve-log")
    bare = log.drop("_row")
    asks = F.col("quantity").cast("long")
    reserves = bare.filter("action = 'reserve'").withColumn("_delta", F.when(asks >= 0, -asks))
    mark = ["_id", user, *keys]

    def give_backs(rows: DataFrame, refused: DataFrame) -> DataFrame:
        kept = rows.join(refused.select("_id"), "_id", "left_anti")
        return saved(_give_backs(_carts_of(kept, user, order, keys), user, order, keys), "reserve-backs")

    def refusals(rows: DataFrame, back: DataFrame, of: DataFrame) -> DataFrame:
        judged = _judged(of, rows.select(*dict.fromkeys([*mark, *order, "_delta"])), back, order, keys, mark)
        return saved(judged.filter("NOT accepted").select(*mark), "reserve-refused")

    def in_rounds(refused: DataFrame) -> DataFrame:
        """From these refusals to those that their own give-backs lead to."""
        back = give_backs(bare, refused)
        new = refusals(reserves, back, stock)
        while True:
            users = new.join(refused, "_id", "left_anti").unionByName(refused.join(new, "_id", "left_anti")).select(user).distinct()
            refused = new
            users = saved(users, "reserve-users")
            if users.isEmpty():
                return refused
            theirs = give_backs(_matching(bare, users, [user], "left_semi"), refused)
            before = _matching(back, users, [user], "left_semi")
            columns = back.columns
            differ = theirs.withColumn("_n", F.lit(1)).unionByName(before.withColumn("_n", F.lit(-1))) \
                .groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
            products = saved(differ.select(*keys).distinct(), "reserve-products")
            back = saved(_matching(back, users, [user], "left_anti").unionByName(theirs), "reserve-backs")
            if products.isEmpty():
                return refused
            some = [_matching(x, products, keys, "left_semi") for x in (reserves, back, stock)]
            again = refusals(*some)
            new = saved(_matching(refused, products, keys, "left_anti").unionByName(again), "reserve-refused")

    def outcomes(refused: DataFrame) -> tuple[DataFrame, bool]:
        """All rows judged with these refusals, and whether the judgement is the same."""
        refused_ids = refused.select("_id")
        rows = _carts_of(log.join(refused_ids, "_id", "left_anti"), user, order, keys)
        turned_away = log.join(refused_ids, "_id", "left_semi")
        both = rows.unionByName(turned_away, allowMissingColumns=True)
        # a reserve takes; an accepted cancel gives back with its row; the others change nothing
        both = both.withColumn("_delta", F.when(is_reserve, F.when(asks >= 0, -asks))
                               .otherwise(F.when(F.col("outcome") == "cancelled", asks).otherwise(F.lit(0))))
        expired = _give_backs(rows, user, order, keys).filter(F.col("_kind") == EXPIRY)
        keep = ["_row", "_id", "action", "quantity", "outcome", "cart_no", "expires_at", "line_after"]
        out = saved(_judged(stock, both, expired, order, keys, keep), "reserve-outcomes")
        turned = out.filter(is_reserve & ~F.col("accepted")).select("_id")
        same = turned.join(refused_ids, "_id", "left_anti").isEmpty() and refused_ids.join(turned, "_id", "left_anti").isEmpty()
        return out, same

    is_reserve = F.col("action") == "reserve"
    refused = saved(bare.join(_foretold(stock, bare, user, order, keys, slice_rows), "_id", "left_semi").select(*mark), "reserve-refused")
    out, settled = outcomes(refused)
    if not settled:
        out, settled = outcomes(in_rounds(refused))
    if not settled:
        raise RuntimeError("the rounds ended before the outcomes were settled")
    taken = is_reserve & F.col("accepted")
    outcome = F.when(asks.isNull() | (asks < 0), "refused_invalid").when(is_reserve & ~F.col("accepted"), "refused_stock") \
        .otherwise(F.col("outcome"))
    return out.select("_row.*", outcome.alias("outcome"), F.when(taken, asks).otherwise(F.lit(0)).alias("reserved_quantity"),
                      F.col("balance_after").alias("remaining_quantity"), "cart_no", "expires_at", "line_after")
