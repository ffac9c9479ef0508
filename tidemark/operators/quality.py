"""Data-quality checks (Q01-Q05), re-aimed from database constraints and request validation.

Each check is one pass (an aggregate, or an anti join for foreign keys) and returns violations
as rows; ``violations`` unions the per-check counts into one result (X01).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _summary(check: str, target: str, counts: DataFrame) -> DataFrame:
    return counts.select(F.lit(check).alias("check"), F.lit(target).alias("target"), "violations")


def check_not_null(df: DataFrame, cols, table: str = "table") -> DataFrame:
    """Q01: NULL count per column, all columns in one aggregate."""
    cols = list(cols)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = agg.unpivot([], cols, "column", "violations")
    return stacked.select(F.lit("not_null").alias("check"),
                          F.concat(F.lit(table + "."), F.col("column")).alias("target"), "violations")


def check_unique(df: DataFrame, keys) -> DataFrame:
    """Q02: key values held by more than one row (with their row counts)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def check_fk(df: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """Q03: rows whose ``key`` has no row in ``ref`` (NULL keys are not violations, as in SQL)."""
    r = ref.select(F.col(ref_key).alias(key))
    return df.filter(F.col(key).isNotNull()).join(r, key, "left_anti")


def check_rules(df: DataFrame, rules: dict[str, Column], table: str = "table"):
    """Q04: named boolean rules (range, length, accepted values).

    Returns (counts, bad_rows): violation count per rule in one aggregate, and the rows breaking
    at least one rule with the names of the rules they break.  A NULL rule result counts as a
    violation.
    """
    ok = {n: F.coalesce(c, F.lit(False)) for n, c in rules.items()}
    counts = df.agg(*[F.count_if(~c).alias(n) for n, c in ok.items()]) \
        .unpivot([], list(ok), "rule", "violations") \
        .select(F.lit("rule").alias("check"), F.concat(F.lit(table + "."), F.col("rule")).alias("target"),
                "violations")
    failed = F.filter(F.array(*[F.when(~c, F.lit(n)) for n, c in ok.items()]), lambda x: x.isNotNull())
    bad = df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)
    return counts, bad


def violations(*parts: DataFrame) -> DataFrame:
    """Q05: one result over all checks: (check, target, violations)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_summary(df: DataFrame, keys, target: str) -> DataFrame:
    d = check_unique(df, keys).agg(F.count(F.lit(1)).alias("violations"))
    return _summary("unique", target, d)


def fk_summary(df: DataFrame, ref: DataFrame, key: str, ref_key: str, target: str) -> DataFrame:
    d = check_fk(df, ref, key, ref_key).agg(F.count(F.lit(1)).alias("violations"))
    return _summary("foreign_key", target, d)
