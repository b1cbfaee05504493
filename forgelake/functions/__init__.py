"""Column-level helpers built only from ``pyspark.sql.functions`` (JVM side)."""

from forgelake.functions.columns import (
    count_where,
    event_date_parts,
    has_bot_marker,
    is_bot_login,
    month_start,
    ratio,
    typed_null,
)

__all__ = [
    "count_where",
    "event_date_parts",
    "has_bot_marker",
    "is_bot_login",
    "month_start",
    "ratio",
    "typed_null",
]
