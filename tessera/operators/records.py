"""Queries over log-span records (JSON attributes, tag arrays, dates, level enum).

Each filter keeps a plain comparison on ``start_timestamp`` (or ``level``)
next to the JSON/date expression, so on a Parquet ``records`` table the scan
receives a pushed-down range / equality filter and skips row groups; the
JSON functions then run only on surviving rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the level enum, in order
LEVELS = ["debug", "info", "warning", "error", "critical"]


def _ts(now: dt.datetime) -> Column:
    return F.lit(now).cast("timestamp")


def attr_equals(df: DataFrame, key: str, json_value: str, attr_col: str = "attributes") -> DataFrame:
    """Rows whose top-level attribute ``key`` holds ``json_value`` (as JSON text, e.g. ``false``)."""
    return df.where(F.get_json_object(F.col(attr_col), f"$.{key}") == F.lit(json_value))


def has_key(df: DataFrame, key: str, attr_col: str = "attributes") -> DataFrame:
    """Rows whose attributes object has top-level ``key`` (also when its value is JSON null)."""
    return df.where(F.array_contains(F.json_object_keys(F.col(attr_col)), key))


def since_yesterday(df: DataFrame, now: dt.datetime, ts_col: str = "start_timestamp") -> DataFrame:
    """Literal meaning of ``ts::date > now - 1 day``: rows dated today (UTC) or later when
    ``now`` is past midnight.  The redundant ``ts >= day(now - 1 day)`` bound is implied by
    the predicate and is what reaches the Parquet scan."""
    cut = _ts(now) - F.expr("INTERVAL 1 DAY")
    return df.where((F.col(ts_col) >= F.date_trunc("day", cut)) &
                    (F.to_date(F.col(ts_col)).cast("timestamp") > cut))


def level_and_tag(df: DataFrame, level: str, tag: str) -> DataFrame:
    return df.where((F.col("level") == level) & F.array_contains("tags", tag))


def yesterday_with_level(df: DataFrame, now: dt.datetime, level: str = "error",
                         ts_col: str = "start_timestamp") -> DataFrame:
    """Rows of the calendar day before ``now`` (UTC) with the given level."""
    today = F.date_trunc("day", _ts(now))
    return df.where((F.col("level") == level) & (F.col(ts_col) >= today - F.expr("INTERVAL 1 DAY")) &
                    (F.col(ts_col) < today))


def valid_level(c: Column) -> Column:
    return c.isin(*LEVELS)


def days_since(d: Column, origin: str = "2000-01-01") -> Column:
    return F.datediff(d.cast("date"), F.lit(origin).cast("date")).cast("long")
