"""Registered queries over the ``records`` table derived from ``events``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import records as rc
from .common import register, table

NOW = dt.datetime(2024, 1, 15, 12, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-15 12:00:00'"


def records(spark, sf):
    """events -> records (FIXTURES.md: records)."""
    e = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    level = (F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "warning")
              .when(F.col("event_type") == "signup", "debug").otherwise("info"))
    m = F.col("event_id") % 4
    attrs = (F.when(m == 0, F.regexp_replace("props", "}$", ', "foobar": false}'))
              .when(m == 1, F.regexp_replace("props", "}$", ', "foobar": true}'))
              .when(m == 2, F.regexp_replace("props", "}$", ', "foobar": null}'))
              .otherwise(F.col("props")))
    tags = F.when(F.col("event_id") % 5 == 0, F.array(F.col("event_type"), F.lit("foobar"))) \
            .otherwise(F.array(F.col("event_type")))
    return e.select(
        ts.alias("created_at"), ts.alias("start_timestamp"), (ts + F.expr("INTERVAL 1 SECOND")).alias("end_timestamp"),
        F.col("user_id").cast("string").alias("trace_id"), F.col("event_id").cast("string").alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"), level.alias("level"),
        F.col("event_type").alias("span_name"),
        F.concat(F.col("event_type"), F.lit(" value="), F.col("value").cast("string")).alias("message"),
        F.lit(None).cast("string").alias("attributes_json_schema"), attrs.alias("attributes"), tags.alias("tags"),
        (level == "error").alias("is_exception"), F.lit(None).cast("string").alias("otel_status_message"),
        F.concat(F.lit("svc"), (F.col("user_id") % 3).cast("string")).alias("service_name"))


SQL_RECORDS = """
SELECT ts AS start_timestamp, user_id::VARCHAR AS trace_id, event_id::VARCHAR AS span_id,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warning' WHEN 'signup' THEN 'debug'
            ELSE 'info' END AS level,
       CASE event_id % 4 WHEN 0 THEN regexp_replace(props, '}$', ', "foobar": false}')
                         WHEN 1 THEN regexp_replace(props, '}$', ', "foobar": true}')
                         WHEN 2 THEN regexp_replace(props, '}$', ', "foobar": null}') ELSE props END AS attributes,
       CASE WHEN event_id % 5 = 0 THEN [event_type, 'foobar'] ELSE [event_type] END AS tags
FROM events"""


def _out(df):
    return df.select("span_id", "trace_id", "level", F.array_join("tags", ",").alias("tags"))


def _sql(where: str) -> str:
    return (f"SELECT span_id, trace_id, level, array_to_string(tags, ',') AS tags FROM ({SQL_RECORDS}) r "
            f"WHERE {where}")


@register("records_attr_equals", _sql("json_extract_string(attributes, '$.foobar') = 'false'"))
def q_attr_equals(spark, sf):
    return _out(rc.attr_equals(records(spark, sf), "foobar", "false"))


@register("records_has_key", _sql("list_contains(json_keys(attributes), 'foobar')"))
def q_has_key(spark, sf):
    return _out(rc.has_key(records(spark, sf), "foobar"))


@register("records_since_yesterday", _sql(f"start_timestamp::DATE > {NOW_SQL} - INTERVAL 1 DAY"))
def q_since_yesterday(spark, sf):
    return _out(rc.since_yesterday(records(spark, sf), NOW))


@register("records_level_tag", _sql("level = 'error' AND list_contains(tags, 'foobar')"))
def q_level_tag(spark, sf):
    return _out(rc.level_and_tag(records(spark, sf), "error", "foobar"))


@register("records_yesterday_errors", _sql(
    f"level = 'error' AND start_timestamp >= date_trunc('day', {NOW_SQL}) - INTERVAL 1 DAY "
    f"AND start_timestamp < date_trunc('day', {NOW_SQL})"))
def q_yesterday_errors(spark, sf):
    return _out(rc.yesterday_with_level(records(spark, sf), NOW, "error"))


@register("days_between", """
SELECT DISTINCT o_orderdate::DATE AS order_date, date_diff('day', DATE '2000-01-01', o_orderdate::DATE) AS days
FROM orders""")
def q_days_between(spark, sf):
    o = table(spark, sf, "orders")
    d = o.select(F.col("o_orderdate").cast("date").alias("order_date")).distinct()
    return d.select("order_date", rc.days_since(F.col("order_date")).alias("days"))
