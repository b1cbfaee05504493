"""Scalar expressions shared by the layers.

Everything here returns a ``Column`` made of built-in functions, so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: must equal the source pipeline's rules -------------------
# Staging bot rule: case-insensitive "[bot]" anywhere, or a "-bot" suffix.
BOT_LOGIN_REGEX = r"(?i).*\[bot\].*|.*-bot$"
# Silver bot rule: case-sensitive literal marker (LIKE '%[bot]%').
BOT_MARKER = "[bot]"
# -----------------------------------------------------------------------------


def is_bot_login(login: Column) -> Column:
    """TRUE / FALSE by the staging rule; NULL login stays NULL (row lands in neither split)."""
    return login.rlike(BOT_LOGIN_REGEX)


def has_bot_marker(login: Column) -> Column:
    """The narrower silver rule: literal, case-sensitive ``[bot]`` substring."""
    return login.contains(BOT_MARKER)


def typed_null(data_type: str | T.DataType) -> Column:
    return F.lit(None).cast(data_type)


def count_where(predicate: Column) -> Column:
    """COUNTIF: rows where the predicate is TRUE (NULL is not counted)."""
    return F.count_if(predicate)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator)


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def event_date_parts(created_at: Column, created_at_type: T.DataType) -> dict[str, Column]:
    """``created_at`` / ``date`` / ``month`` / ``year`` for a raw event time.

    Raw archive times are ISO-8601 strings.  ``date`` is cut from the string
    itself (the UTC day as written), and ``created_at`` becomes the UTC
    wall-clock time as ``timestamp_ntz``: the instant is parsed honouring any
    offset, and counted from the UTC epoch.  Malformed strings give
    NULL instead of failing the job (ANSI mode is on in Spark 4).

    An already typed timestamp (the driver fixture) is used as is.
    """
    if isinstance(created_at_type, T.StringType):
        instant = F.try_to_timestamp(created_at)
        # From the epoch, not by way of the session's wall time, which is ambiguous when clocks go back.
        ts = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
        date = F.call_function("try_to_date", created_at)
    else:
        ts = created_at.cast("timestamp_ntz")
        date = ts.cast("date")
    return {
        "created_at": ts,
        "date": date,
        "month": F.month(date).cast("int"),
        "year": F.year(date).cast("int"),
    }
