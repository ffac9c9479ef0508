"""Numeric helpers: exact money, half-up rounding, ratios, seeded integers, readable sizes.

Money is summed as DECIMAL so the result does not depend on the order rows arrive in; a
rounded ratio is rounded as a decimal (half up) and returned as DOUBLE.  Both rules make the
same query give bit-equal answers on Spark and on an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_money(c, precision: int = 15, scale: int = 2) -> Column:
    return _col(c).cast(f"decimal({precision},{scale})")


def line_revenue(quantity=None, price="unit_price", discount="discount", discount_in_percent: bool = True) -> Column:
    """``quantity * price * (1 - discount/100)`` in decimals.

    ``quantity=None`` means ``price`` is already extended (price times quantity).
    ``discount_in_percent=False`` takes the discount as a fraction.
    """
    p = as_money(price)
    if quantity is not None:
        p = p * _col(quantity).cast("decimal(10,0)")
    d = as_money(discount, 5, 2)
    factor = (F.lit(100).cast("decimal(3,0)") - d) / F.lit(100).cast("decimal(3,0)") if discount_in_percent \
        else (F.lit(1).cast("decimal(1,0)") - d)
    return p * factor


def round_half_up(c, digits: int = 0) -> Column:
    """Round half up at ``digits`` decimals through DECIMAL(38,10); result is DOUBLE."""
    return F.round(_col(c).cast("decimal(38,10)"), digits).cast("double")


def pct(part, whole, digits: int = 2) -> Column:
    """``round(100 * part / whole, digits)``; NULL when ``whole`` is 0 (ANSI-safe)."""
    return round_half_up(F.try_divide(F.lit(100.0) * _col(part), _col(whole)), digits)


def avg_seconds(start, end) -> Column:
    """Mean of ``end - start`` in seconds, 0 when there is no pair."""
    from tidemark.functions.dates import ntz_micros

    micros = ntz_micros(_col(end)) - ntz_micros(_col(start))
    return F.coalesce(F.avg(micros) / F.lit(1_000_000.0), F.lit(0.0))


def seeded_int(seed, *parts, bits: int = 32) -> Column:
    """Deterministic pseudo-random non-negative integer from ``md5(seed || parts)``.

    The first ``bits/4`` hex digits of the md5 are read as an unsigned integer; the same value
    comes out of any engine that has md5 and base-16 parsing.
    """
    s = F.concat_ws("|", F.lit(str(seed)), *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, bits // 4), 16, 10).cast("long")


# Unit names and thresholds of the human-readable size format (powers of 1024).
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]


def readable_size(c) -> Column:
    """Bytes as text with two decimals in the largest unit below the value, e.g. '1.50 MiB'."""
    b = _col(c).cast("double")
    expr = F.format_string("%.2f %s", b, F.lit(SIZE_UNITS[0]))
    for i, unit in enumerate(SIZE_UNITS[1:], start=1):
        expr = F.when(b >= F.lit(float(1024 ** i)), F.format_string("%.2f %s", b / F.lit(float(1024 ** i)), F.lit(unit))) \
            .otherwise(expr)
    return expr
