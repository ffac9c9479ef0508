"""Table operations.

Spark cannot ``UPDATE`` or ``DELETE`` Parquet in place; each operation returns the new version
of the table as a DataFrame (written back with ``sources.layout.replace``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.inventory import upsert  # noqa: F401  (S13 lives with its stock use)


def reset_columns(df: DataFrame, values: dict) -> DataFrame:
    """``UPDATE t SET c = v, ...`` for every row (constants, NULL allowed)."""
    return df.withColumns({c: (F.lit(v) if not isinstance(v, Column) else v).cast(df.schema[c].dataType)
                           for c, v in values.items()})


def patch(base: DataFrame, patches: DataFrame, key: str, as_of, updated_col: str = "updated_at"):
    """Partial update: only the non-NULL fields a patch supplies replace the row's values,
    and ``updated_at`` is set.  Several patches of one id are reduced to the last supplied value
    per field first (the order of ``patch_order``, if the patches have that column; else the
    greatest value), so a row is never multiplied.  Returns (new_table, rejected_patches): a
    patch that supplies no field is rejected as ``empty`` (the reference answers 400), one for an
    id without a row as ``unknown`` (404)."""
    fields = [c for c in patches.columns if c not in (key, "patch_order")]
    by = "patch_order" if "patch_order" in patches.columns else None
    supplied = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in fields], F.lit(False))
    good = patches.filter(supplied)

    def last(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(by))) if by else F.max(c)

    p = good.groupBy(key).agg(*[last(c).alias(f"_p_{c}") for c in fields], F.lit(True).alias("_hit"))
    j = base.join(p, key, "left")
    cols = []
    for c in base.columns:
        if c in fields:
            cols.append(F.coalesce(F.col(f"_p_{c}"), F.col(c)).cast(base.schema[c].dataType).alias(c))
        elif c == updated_col:
            cols.append(F.when(F.col("_hit"), F.lit(as_of).cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    empty = patches.filter(~supplied).withColumn("reason", F.lit("empty"))
    unknown = good.join(base.select(key), key, "left_anti").withColumn("reason", F.lit("unknown"))
    return j.select(*cols), empty.unionByName(unknown)


def delete_keys(base: DataFrame, keys: DataFrame, key: str):
    """Delete rows by key.  Returns (new_table, missing_keys): keys with no row are
    reported (the reference answers 404)."""
    k = keys.select(key).distinct()
    return base.join(k, key, "left_anti"), k.join(base.select(key), key, "left_anti")


def create_rows(base: DataFrame, new: DataFrame, defaults: dict) -> DataFrame:
    """Insert rows, filling the columns they lack with defaults (created/updated times,
    empty tags ...).  Uniqueness is checked separately (quality.check_unique)."""
    cols = []
    for f in base.schema.fields:
        if f.name in new.columns:
            cols.append(F.col(f.name).cast(f.dataType))
        elif f.name in defaults:
            v = defaults[f.name]
            cols.append((v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return base.unionByName(new.select(*cols))


def keep_known(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows whose key exists in ``ref`` (semi join; ``ref`` is never multiplied in)."""
    return df.join(ref.select(F.col(ref_key or key).alias(key)), key, "left_semi")


def unknown_keys(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows whose key does not exist in ``ref`` (anti join)."""
    return df.join(ref.select(F.col(ref_key or key).alias(key)), key, "left_anti")


def get_by_id(df: DataFrame, ids, key: str = "id") -> DataFrame:
    """lookup by id: one id is a pushed-down filter, many ids (a DataFrame) a semi join."""
    if isinstance(ids, DataFrame):
        return keep_known(df, ids, key)
    if isinstance(ids, (list, tuple, set)):
        return df.filter(F.col(key).isin(list(ids)))  # F05
    return df.filter(F.col(key) == F.lit(ids))  # F01


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    """The k first rows in ``order`` (top-k per partition, then one merge of k rows each);
    end ``order`` with a unique key for a unique answer."""
    return df.orderBy(*order).limit(k)


def with_partition_counts(df: DataFrame, part: Column, part_name: str, distinct_col: str | None = None,
                          bounded: bool = False) -> DataFrame:
    """``count() OVER (PARTITION BY part)`` and ``uniq(x) OVER (PARTITION BY part)``
    as a pre-aggregate per partition joined back: no window buffers a whole (possibly huge)
    partition, and the distinct count (refused inside a window) is an ordinary aggregate.
    ``bounded`` says that ``part`` has few values by definition (calendar days), so that the
    rows need no shuffle."""
    aggs = [F.count(F.lit(1)).alias("rows_in_partition")]
    if distinct_col:
        aggs.append(F.count_distinct(distinct_col).alias("distinct_in_partition"))
    per = df.groupBy(part.alias(part_name)).agg(*aggs)
    # one row per partition value (a day, a device): bounded by the values, not by the rows
    return df.withColumn(part_name, part).join(F.broadcast(per) if bounded else per, part_name)


def metrics(rows: dict) -> DataFrame:
    """Labelled one-row aggregates as one result (``UNION ALL``); values as text."""
    out = None
    for label, df in rows.items():
        one = df.select(F.lit(label).alias("metric"), F.col(df.columns[0]).cast("string").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out
