"""Shop analytics: top clients (J01/J02), denormalisation (S11), order totals (S12),
catalogue search and paging (F04, T04), table counts (A16).

Plan notes for J01 at scale.  The fact table (order items) is joined first to the date-filtered
orders on the order key (the most selective dimension filter; Spark's run-time bloom filter
prunes items before the shuffle), then semi-joined to the category's products (broadcast only
when the filtered product set is proven small).  Items are summed per (client, order) on the
order-key partitioning the join already produced, so that step adds no shuffle; only the much
smaller per-order rows are shuffled by client.  The top-k is a ``TakeOrderedAndProject``
(per-partition top-k, then a merge of k rows per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ranking import TOP_ROWS, ranked_between
from tidemark.functions.dates import months_before, ts_lit


def top_clients(clients: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
                category: str, as_of, months: int = 6, k: int = 100,
                revenue_col: str = "revenue") -> DataFrame:
    """Top-k clients by revenue in one category over the last ``months`` before ``as_of``.

    Output: client_id, name, email, order_count (distinct orders), total_revenue (DOUBLE of an
    exact decimal sum).  Ties on revenue are broken by client id.
    """
    cutoff = months_before(as_of, months)
    cat = products.filter(F.col("category") == category).select(F.col("id").alias("product_id"))
    recent = orders.filter(F.col("order_date") >= ts_lit(cutoff)) \
        .select(F.col("id").alias("order_id"), "client_id")
    lines = items.select("order_id", "product_id", revenue_col) \
        .join(recent, "order_id") \
        .join(cat, "product_id", "left_semi")
    return _rank_clients(lines, clients, revenue_col, k)


def top_clients_denorm(clients: DataFrame, orders: DataFrame, items_with_category: DataFrame,
                       category: str, as_of, months: int = 6, k: int = 100,
                       revenue_col: str = "revenue") -> DataFrame:
    """The same answer as J01 from items that carry their product's category."""
    cutoff = months_before(as_of, months)
    recent = orders.filter(F.col("order_date") >= ts_lit(cutoff)) \
        .select(F.col("id").alias("order_id"), "client_id")
    lines = items_with_category.filter(F.col("category") == category) \
        .select("order_id", revenue_col).join(recent, "order_id")
    return _rank_clients(lines, clients, revenue_col, k)


def _rank_clients(lines: DataFrame, clients: DataFrame, revenue_col: str, k: int) -> DataFrame:
    per_order = lines.groupBy("order_id", "client_id").agg(F.sum(revenue_col).alias("rev"))
    per_client = per_order.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("rev").alias("rev"),
    )
    named = per_client.join(
        clients.select(F.col("id").alias("client_id"), "name", "email"), "client_id")
    ranked = named.select(
        "client_id", "name", "email", "order_count",
        F.col("rev").cast("double").alias("total_revenue"),
    )
    return ranked.orderBy(F.col("total_revenue").desc(), F.col("client_id").asc()).limit(k)


def denormalise(items: DataFrame, products: DataFrame, key: str = "product_id",
                cols=("category",), product_key: str = "id") -> DataFrame:
    """Copy product columns onto items, only where the item's value is NULL."""
    look = products.select(F.col(product_key).alias(key), *[F.col(c).alias(f"_p_{c}") for c in cols])
    out = items.join(look, key, "left")
    for c in cols:
        if c in items.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_p_{c}")))
        else:
            out = out.withColumn(c, F.col(f"_p_{c}"))
    return out.drop(*[f"_p_{c}" for c in cols])


def order_totals(orders: DataFrame, items: DataFrame, amount_col: str = "revenue",
                 order_key: str = "id", item_key: str = "order_id") -> DataFrame:
    """Orders with ``total_amount`` recomputed from their items (0 for an order without
    items).  Items are pre-aggregated per order before the join, so the join is one-to-one."""
    sums = items.groupBy(F.col(item_key).alias(order_key)).agg(F.sum(amount_col).alias("_total"))
    out = orders.join(sums, order_key, "left")
    zero = F.lit(0).cast(sums.schema["_total"].dataType)
    return out.withColumn("total_amount", F.coalesce(F.col("_total"), zero)).drop("_total")


def search_catalog(df: DataFrame, category: str | None = None, tag: str | None = None,
                   tags_col: str = "tags") -> DataFrame:
    """rows of ``category`` whose tag array holds ``tag`` (all given conditions hold)."""
    out = df
    if category is not None:
        out = out.filter(F.col("category") == category)
    if tag is not None:
        out = out.filter(F.array_contains(F.col(tags_col), tag))
    return out


def page(df: DataFrame, skip: int = 0, limit: int = 20, tag: str | None = None,
         order_col: str = "created_at", key_col: str = "id", tags_col: str = "tags", after: tuple | None = None):
    """Newest first, skip ``skip``, at most ``limit`` (1..100) rows, plus the total count.

    Returns ``(items_df, total_df)``.  A page near the top is a top-(skip+limit) per partition followed
    by an offset; a deep one is found by the counts of the sorted partitions, so no task sees the rows
    that are skipped (``ranked_between``).  ``after`` = (order value, key) of the last row seen continues
    from there with a filter instead, whatever the depth.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be within 1..100")
    if skip < 0:
        raise ValueError("skip must be >= 0")
    base = df if tag is None else df.filter(F.array_contains(F.col(tags_col), tag))
    rest = base
    if after is not None:
        value, key = F.lit(after[0]), F.lit(after[1])
        rest = base.filter((F.col(order_col) < value) | ((F.col(order_col) == value) & (F.col(key_col) > key)))
    order = [F.col(order_col).desc(), F.col(key_col).asc()]
    if skip + limit > TOP_ROWS:
        items = ranked_between(rest, order, skip + 1, skip + limit, "_rank").orderBy("_rank").drop("_rank")
    else:
        items = rest.orderBy(*order)
        items = items.offset(skip).limit(limit) if skip else items.limit(limit)
    total = base.agg(F.count(F.lit(1)).alias("total"))
    return items, total


def table_counts(tables: dict) -> DataFrame:
    """One row per table with its row count (``UNION ALL`` of labelled counts)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out
