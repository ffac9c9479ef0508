"""Table contracts (S01) and literal tables.

A contract is an explicit ``StructType`` with defaults and rules.  ``read_text`` and ``checked`` hold rows
against it when they are read: no schema is inferred, and what breaks the contract is an output of its own.
What needs other rows (unique, foreign keys) is checked by ``operators.quality``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
D = T.DoubleType()
TS = T.TimestampNTZType()
DT = T.DateType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CONTRACTS: dict[str, T.StructType] = {
    # shop
    "clients": _st(("id", L, False), ("name", S, False), ("email", S, False), ("phone", S, True),
                   ("created_at", TS, True)),
    "products": _st(("id", L, False), ("name", S, False), ("price", T.DecimalType(10, 2), False),
                    ("category", S, True)),
    "orders": _st(("id", L, False), ("client_id", L, True), ("order_date", TS, True), ("status", S, True),
                  ("total_amount", T.DecimalType(12, 2), True)),
    "order_items": _st(("id", L, False), ("order_id", L, True), ("product_id", L, True), ("quantity", I, False),
                       ("unit_price", T.DecimalType(10, 2), False), ("discount", T.DecimalType(5, 2), True)),
    # queue
    "jobs": _st(("id", L, False), ("title", S, False), ("description", S, True), ("status", S, True),
                ("priority", I, True), ("worker_id", L, True), ("created_at", TS, True),
                ("started_at", TS, True), ("completed_at", TS, True)),
    "job_log": _st(("id", L, False), ("job_id", L, True), ("worker_id", L, False), ("action", S, True),
                   ("action_time", TS, True)),
    # catalogue documents
    "product_documents": _st(("id", S, False), ("name", S, False), ("price", D, False), ("quantity", I, False),
                             ("tags", T.ArrayType(S), True), ("created_at", TS, True), ("updated_at", TS, True)),
    # inventory
    "warehouse_stock": _st(("warehouse_id", L, False), ("product_id", L, False), ("quantity", L, False)),
    "inventory_events": _st(("event_id", S, False), ("event_type", S, False), ("product_id", L, False),
                            ("warehouse_id", L, False), ("quantity", L, False), ("timestamp", TS, True),
                            ("metadata", T.MapType(S, S), True)),
    # activity
    "activity_events": _st(("event_date", DT, True), ("ts", TS, False), ("user_id", L, False),
                           ("event_type", S, False), ("event_value", D, True), ("session_id", S, True),
                           ("device_type", S, True), ("country", S, True), ("duration", I, True)),
    "event_types": _st(("event_id", I, False), ("event_name", S, False), ("event_weight", T.FloatType(), False)),
    "daily_stats": _st(("day", DT, False), ("country", S, True), ("device_type", S, True),
                       ("event_count", L, False), ("total_duration", L, True), ("total_value", D, True)),
    "table_sizes": _st(("table_name", S, False), ("total_rows", L, False), ("total_bytes", L, False),
                       ("avg_bytes_per_row", D, True), ("partition_count", L, False)),
}

# The allowed values of enumerations in the reference's tables.
JOB_STATUSES = ["new", "processing", "completed"]
JOB_LOG_ACTIONS = ["started", "completed"]
INVENTORY_EVENT_TYPES = ["STOCK_RECEIVED", "PRODUCT_RESERVED", "RESERVATION_CANCELLED", "STOCK_DECREASED"]
ORDER_STATUSES = ["new", "paid", "shipped", "done"]
PRODUCT_CATEGORIES = ["Electronics", "Books", "Clothing", "Home", "Sports"]

# The reference's event-type dictionary (id, name, weight).
REFERENCE_EVENT_TYPES = [
    (1, "page_view", 1.0),
    (2, "click", 0.8),
    (3, "login", 2.0),
    (4, "purchase", 5.0),
    (5, "search", 1.5),
    (6, "add_to_cart", 3.0),
    (7, "logout", 0.5),
]

# The same dictionary over the driver's event names ('view' plays page_view,
# 'signup' plays login, 'error' plays logout).
DRIVER_EVENT_TYPES = [
    (1, "view", 1.0),
    (2, "click", 0.8),
    (3, "signup", 2.0),
    (4, "purchase", 5.0),
    (7, "error", 0.5),
]

def contract(name: str) -> T.StructType:
    """The schema of a domain table."""
    return CONTRACTS[name]


def event_types(spark: SparkSession, rows=None) -> DataFrame:
    """The event-type dictionary as a (tiny, fixed-size) DataFrame."""
    return spark.createDataFrame(rows or REFERENCE_EVENT_TYPES, schema=CONTRACTS["event_types"])


# ------------------------------------------------------------------------- contracts on read

# What a missing value becomes.  The reference's defaults of "now" have no place in a repeatable read.
DEFAULTS: dict[str, dict[str, object]] = {
    "orders": {"status": "new"},
    "order_items": {"discount": 0},
    "jobs": {"status": "new", "priority": 0},
}

# What a value must be beside its type; a missing value of a nullable column is no breach.
RULES: dict[str, dict[str, Callable[[Column], Column]]] = {
    "products": {"price": lambda c: c >= 0, "category": lambda c: c.isin(PRODUCT_CATEGORIES)},
    "orders": {"status": lambda c: c.isin(ORDER_STATUSES), "total_amount": lambda c: c >= 0},
    "order_items": {"quantity": lambda c: c > 0, "unit_price": lambda c: c >= 0, "discount": lambda c: c.between(0, 100)},
    "jobs": {"status": lambda c: c.isin(JOB_STATUSES), "priority": lambda c: c.between(0, 10)},
    "job_log": {"action": lambda c: c.isin(JOB_LOG_ACTIONS)},
    "inventory_events": {"event_type": lambda c: c.isin(INVENTORY_EVENT_TYPES)},
    "warehouse_stock": {"quantity": lambda c: c >= 0},
}

MALFORMED = "_malformed"


class Checked(NamedTuple):
    """Rows that keep a contract, typed; and the others as they came, with what is wrong."""
    rows: DataFrame
    rejects: DataFrame


def read_text(spark: SparkSession, path: str, name: str, **options) -> Checked:
    """Delimited text read by a contract.  No schema is inferred; lines with too many or too few
    fields, values that are not of their type and values that break a rule go to ``rejects``."""
    fields = [T.StructField(f.name, S) for f in CONTRACTS[name]] + [T.StructField(MALFORMED, S)]
    raw = (spark.read.schema(T.StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
           .options(**options).csv(path))
    return checked(raw, name, MALFORMED)


def checked(raw: DataFrame, name: str, malformed: str | None = None) -> Checked:
    """``raw`` held against a contract: blank text is missing, missing takes the default, a value that
    cannot be cast, a missing value of a required column and a broken rule are faults.  Every row is in one
    of the two results; ``rejects`` has the raw columns and ``faults``, a list of "column: what"."""
    values, faults = {}, []
    for f in CONTRACTS[name]:
        given = F.col(f.name) if f.name in raw.columns else F.lit(None).cast(S)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value, wrong = given, F.lit(False)
        else:
            text = F.nullif(F.trim(given.cast(S)), F.lit(""))
            value = text.try_cast(f.dataType)
            wrong = text.isNotNull() & value.isNull()
        if f.name in DEFAULTS.get(name, {}):
            value = F.coalesce(value, F.lit(DEFAULTS[name][f.name]).cast(f.dataType))
        faults.append(F.when(wrong, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
        if not f.nullable:
            faults.append(F.when(~wrong & value.isNull(), F.lit(f"{f.name}: missing")))
        if f.name in RULES.get(name, {}):
            faults.append(F.when(~wrong & value.isNotNull() & ~RULES[name][f.name](value), F.lit(f"{f.name}: not allowed")))
        values[f.name] = value
    if malformed:
        faults.insert(0, F.when(F.col(malformed).isNotNull(), F.lit("line: malformed")))
    found = raw.withColumn("faults", F.array_compact(F.array(*faults)))
    rows = found.filter(F.size("faults") == 0).select([v.alias(n) for n, v in values.items()])
    return Checked(rows, found.filter(F.size("faults") > 0))
