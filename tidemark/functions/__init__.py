"""Column helpers.  Everything here builds built-in Spark expressions (JVM side, codegen)."""

from tidemark.functions.dates import (  # noqa: F401
    between_ts,
    hour_start,
    iso_weekday,
    months_before,
    since,
    ts_lit,
    week_start_sunday,
    weekday_name,
)
from tidemark.functions.numeric import (  # noqa: F401
    as_money,
    avg_seconds,
    line_revenue,
    pct,
    readable_size,
    round_half_up,
    seeded_int,
)
