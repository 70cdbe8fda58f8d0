"""Registered queries: accounts, whales display table, weather, geocoding, validation, SQL guard."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookups as lk
from ..functions import text as tx
from ..operators import validate as vd
from ..operators.records import LEVELS
from .common import q, register, sql_key_terms_table, table

SQL_DOC_TERMS = sql_key_terms_table("SELECT doc_id, text FROM documents", "doc_id", "text")

UNKNOWN_ID = -1
UNKNOWN_PLACE = "Atlantis"


# --- accounts -------------------------------------------------------------------

def accounts(spark, sf):
    """customer -> accounts; pending = sum of o_totalprice (as money) over status P orders, 0 if none."""
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    pend = o.groupBy(F.col("o_custkey").alias("account_number")) \
            .agg(F.sum(F.col("o_totalprice").cast(lk.MONEY)).alias("pending"))
    a = c.select(F.col("c_custkey").alias("account_number"),
                 F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("name"),
                 F.col("c_acctbal").cast(lk.MONEY).alias("balance"))
    return a.join(pend, "account_number", "left").withColumn("pending", F.coalesce("pending", F.lit(0).cast(lk.MONEY)))


def account_requests(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("account_number"))
    r = c.unionByName(spark.createDataFrame([(UNKNOWN_ID,)], "account_number long"))
    return r.withColumn("include_pending", F.col("account_number") % 2 == 0)


SQL_ACCOUNTS = """
(SELECT c.c_custkey AS account_number, '  ' || c.c_name || ' ' AS name, c.c_acctbal::DECIMAL(18,2) AS balance,
        coalesce(p.pending, 0)::DECIMAL(18,2) AS pending
 FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS pending FROM orders
                            WHERE o_orderstatus = 'P' GROUP BY o_custkey) p ON p.o_custkey = c.c_custkey)"""
SQL_REQUESTS = f"""
(SELECT account_number, account_number % 2 = 0 AS include_pending
 FROM (SELECT c_custkey AS account_number FROM customer UNION ALL SELECT {UNKNOWN_ID}))"""


@register("account_lookup", f"""
SELECT r.account_number, regexp_replace(a.name, '^\\s+|\\s+$', '', 'g') AS name, a.name IS NOT NULL AS found,
       CASE WHEN a.name IS NULL THEN '{lk.NOT_FOUND}' END AS reject_reason
FROM {SQL_REQUESTS} r LEFT JOIN {SQL_ACCOUNTS} a USING (account_number)""")
def q_account_lookup(spark, sf):
    r = account_requests(spark, sf).select("account_number")
    return lk.account_lookup(r, accounts(spark, sf)).select("account_number", "name", "found", "reject_reason")


@register("account_balance", f"""
SELECT account_number, include_pending, amount::DOUBLE AS amount, printf('$%.2f', amount) AS amount_text,
       reject_reason FROM (
  SELECT r.account_number, r.include_pending,
         (CASE WHEN r.include_pending THEN a.balance + a.pending ELSE a.balance END)::DECIMAL(18,2) AS amount,
         CASE WHEN a.balance IS NULL THEN '{lk.NOT_FOUND}' END AS reject_reason
  FROM {SQL_REQUESTS} r LEFT JOIN {SQL_ACCOUNTS} a USING (account_number))""")
def q_account_balance(spark, sf):
    b = lk.account_balance(account_requests(spark, sf), accounts(spark, sf))
    return b.select("account_number", "include_pending", F.col("amount").cast("double").alias("amount"),
                    "amount_text", "reject_reason")


# --- whales ---------------------------------------------------------------------

def whales(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    return p.select(k.alias("part_key"), F.col("p_name").alias("name"),
                    (F.col("p_size") + 0.5).alias("length"),
                    F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("p_retailprice") - 880).alias("weight"),
                    F.when(k % 4 == 0, F.lit("")).otherwise(F.col("p_type")).alias("ocean"),
                    F.when(k % 2 == 1, F.lit(None)).otherwise(F.concat(F.lit("a "), F.col("p_brand")))
                     .alias("description"), F.col("p_brand").alias("brand"))


SQL_WHALES = """
(SELECT p_partkey AS part_key, p_name AS name, p_size + 0.5 AS length,
        CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_retailprice - 880 END AS weight,
        CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_type END AS ocean,
        CASE WHEN p_partkey % 2 = 1 THEN NULL ELSE 'a ' || p_brand END AS description, p_brand AS brand
 FROM part)"""


def _sql_num(c):
    return f"CASE WHEN {c} IS NULL OR {c} = 0 THEN '{lk.ELLIPSIS}' ELSE printf('%.0f', round_even({c}, 0)) END"


def _sql_txt(c):
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN '{lk.ELLIPSIS}' ELSE {c} END"


@register("format_whale_rows", f"""
SELECT row_number() OVER (ORDER BY part_key) AS id, {_sql_txt('name')} AS name, {_sql_num('length')} AS length,
       {_sql_num('weight')} AS weight, {_sql_txt('ocean')} AS ocean, {_sql_txt('description')} AS description
FROM {SQL_WHALES}""")
def q_format_whale_rows(spark, sf):
    return lk.format_whale_rows(whales(spark, sf), ["part_key"]) \
             .select("id", "name", "length", "weight", "ocean", "description")


# --- weather --------------------------------------------------------------------

def observations(spark, sf):
    e = table(spark, sf, "events")
    codes = sorted(lk.WEATHER_CODES)
    code = F.element_at(F.array(*[F.lit(c) for c in codes + [9999]]), (F.col("event_id") % 24 + 1).cast("int"))
    return e.select("event_id", F.col("value").alias("temperature"), code.alias("weather_code"))


@register("weather_report", f"""
SELECT event_id, printf('%.0f', round_even(value, 0)) || '°C' AS temperature_text,
       coalesce(c.description, '{lk.WEATHER_UNKNOWN}') AS description
FROM (SELECT event_id, value, ({[c for c in sorted(lk.WEATHER_CODES)] + [9999]})[event_id % 24 + 1] AS weather_code
      FROM events) e
LEFT JOIN (VALUES {", ".join(f"({k}, {q(v)})" for k, v in sorted(lk.WEATHER_CODES.items()))}) c(weather_code, description)
USING (weather_code)""")
def q_weather_report(spark, sf):
    return lk.weather_report(observations(spark, sf)).select("event_id", "temperature_text", "description")


# --- geocoding ------------------------------------------------------------------

def gazetteer(spark, sf):
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    lat = (F.col("n_nationkey") * 7 % 180 - 90).cast("double")
    lng = (F.col("n_nationkey") * 13 % 360 - 180).cast("double")
    by_nation = j.select(F.col("n_name").alias("place"), lat.alias("lat"), lng.alias("lng"),
                         F.col("n_nationkey").alias("match_order"))
    by_region = j.select(F.col("r_name").alias("place"), lat.alias("lat"), lng.alias("lng"),
                         F.col("n_nationkey").alias("match_order"))
    return by_nation.unionByName(by_region)


def place_requests(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_name").alias("place"))
    r = table(spark, sf, "region").select(F.col("r_name").alias("place"))
    u = spark.createDataFrame([(UNKNOWN_PLACE, True), (UNKNOWN_PLACE + " Minor", False)], "place string, use_default boolean")
    return n.withColumn("use_default", F.lit(False)).unionByName(r.withColumn("use_default", F.col("place") == "ASIA")).unionByName(u)


@register("geocode_first", f"""
WITH g AS (SELECT n_name AS place, (n_nationkey * 7 % 180 - 90)::DOUBLE AS lat, (n_nationkey * 13 % 360 - 180)::DOUBLE AS lng,
                  n_nationkey AS match_order FROM nation JOIN region ON n_regionkey = r_regionkey
           UNION ALL
           SELECT r_name, (n_nationkey * 7 % 180 - 90)::DOUBLE, (n_nationkey * 13 % 360 - 180)::DOUBLE, n_nationkey
           FROM nation JOIN region ON n_regionkey = r_regionkey),
f AS (SELECT place, arg_min(lat, match_order) AS lat, arg_min(lng, match_order) AS lng FROM g GROUP BY place),
r AS (SELECT n_name AS place, false AS use_default FROM nation UNION ALL SELECT r_name, r_name = 'ASIA' FROM region
      UNION ALL SELECT '{UNKNOWN_PLACE}', true UNION ALL SELECT '{UNKNOWN_PLACE} Minor', false)
SELECT r.place, r.use_default, f.place IS NOT NULL AS found,
       CASE WHEN r.use_default THEN {lk.DEFAULT_LAT} ELSE f.lat END AS lat,
       CASE WHEN r.use_default THEN {lk.DEFAULT_LNG} ELSE f.lng END AS lng,
       (CASE WHEN r.use_default THEN {lk.DEFAULT_LAT} ELSE f.lat END)::VARCHAR || ',' ||
       (CASE WHEN r.use_default THEN {lk.DEFAULT_LNG} ELSE f.lng END)::VARCHAR AS location,
       CASE WHEN f.place IS NULL AND NOT r.use_default THEN 'location not found, retry' END AS reject_reason
FROM r LEFT JOIN f USING (place)""")
def q_geocode_first(spark, sf):
    return lk.geocode_first(place_requests(spark, sf), gazetteer(spark, sf))


# --- validation -----------------------------------------------------------------

# SQL answer texts cycled by event_id % 7 (FIXTURES.md: SQL answers)
SQL_TEXTS = ["SELECT trace_id, message FROM records WHERE is_exception", "select count(*) from records",
             "SEL\\ECT 1", "DELETE FROM records", " SELECT 1", "", None]


def sql_answers(spark, sf):
    e = table(spark, sf, "events")
    m = F.col("event_id") % 7
    txt = F.element_at(F.array(*[F.lit(t) for t in SQL_TEXTS]), (m + 1).cast("int"))
    return e.select("event_id", F.when(m == 6, "invalid_request").otherwise("success").alias("kind"),
                    F.when(m == 6, F.lit(None)).otherwise(txt).alias("sql_query"),
                    F.when(m == 6, F.lit(None)).otherwise(F.lit("")).alias("explanation"),
                    F.when(m == 6, F.lit("cannot answer from the records table")).alias("error_message"))


def _sql_texts():
    return "[" + ", ".join("NULL" if t is None else q(t) for t in SQL_TEXTS) + "]"


SQL_ANSWERS = f"""
(SELECT event_id, CASE WHEN event_id % 7 = 6 THEN 'invalid_request' ELSE 'success' END AS kind,
        CASE WHEN event_id % 7 = 6 THEN NULL ELSE ({_sql_texts()})[event_id % 7 + 1] END AS sql_query
 FROM events)"""


@register("sql_text_guard", f"""
SELECT event_id, kind, CASE WHEN kind = 'success' THEN replace(sql_query, '\\', '') END AS cleaned_sql,
       CASE WHEN kind = 'success' THEN coalesce(starts_with(upper(replace(sql_query, '\\', '')), 'SELECT'), false)
            ELSE true END AS ok
FROM {SQL_ANSWERS}""")
def q_sql_text_guard(spark, sf):
    return lk.sql_text_guard(sql_answers(spark, sf)).select("event_id", "kind", "cleaned_sql", "ok")


def validation_input(spark, sf):
    """Three record kinds as JSON text, as they would arrive from a model or a feed."""
    e = table(spark, sf, "events")
    support = e.select(F.lit("support").alias("record_kind"), F.col("event_id").alias("record_id"),
                       F.to_json(F.struct(F.concat(F.lit("advice "), F.col("event_id").cast("string")).alias("support_advice"),
                                          (F.col("event_type") == "error").alias("block_card"),
                                          (F.col("event_id") % 14 - 1).alias("risk"))).alias("json"))
    w = whales(spark, sf)
    whale = w.select(F.lit("whale").alias("record_kind"), F.col("part_key").alias("record_id"),
                     F.to_json(F.struct("name", "length", "weight", "ocean", "description")).alias("json"))
    a = sql_answers(spark, sf)
    answer = a.select(F.lit("sql_answer").alias("record_kind"), F.col("event_id").alias("record_id"),
                      F.to_json(F.struct("kind", "sql_query", "explanation", "error_message")).alias("json"))
    b = table(spark, sf, "benchmark")
    query = b.select(F.lit("search_query").alias("record_kind"), F.col("item_id").alias("record_id"),
                     F.to_json(F.struct(F.col("text").alias("query"), F.lit("general").alias("aspect"),
                                        F.lit("from the benchmark").alias("rationale"))).alias("json"))
    d = table(spark, sf, "documents")
    reflection = d.select(F.lit("reflection").alias("record_kind"), F.col("doc_id").alias("record_id"),
                          F.to_json(F.struct(tx.key_terms(F.col("text")).alias("knowledge_gaps"),
                                             F.array(F.col("lang")).alias("covered_topics"))).alias("json"))
    summary = d.select(F.lit("final_summary").alias("record_kind"), F.col("doc_id").alias("record_id"),
                       F.to_json(F.struct(F.col("text").alias("summary"))).alias("json"))
    return (support.unionByName(whale).unionByName(answer).unionByName(query)
                   .unionByName(reflection).unionByName(summary))


@register("validate_records", f"""
WITH r AS (
  SELECT 'support' AS record_kind, event_id AS record_id,
         CASE WHEN event_id % 14 - 1 BETWEEN 0 AND 10 THEN NULL ELSE 'risk_range' END AS r1,
         NULL AS r2, NULL AS r3, NULL AS r4, NULL AS r5, NULL AS r6, NULL AS r7 FROM events
  UNION ALL
  SELECT 'whale', part_key, NULL, NULL, NULL, NULL,
         CASE WHEN weight IS NULL OR weight >= 50 THEN NULL ELSE 'weight_min_50' END, NULL, NULL FROM {SQL_WHALES}
  UNION ALL
  SELECT 'sql_answer', event_id, NULL, NULL, NULL, NULL, NULL,
         CASE WHEN kind = 'success' AND NOT coalesce(length(sql_query) >= 1, false) THEN 'sql_query_nonempty' END,
         NULL FROM {SQL_ANSWERS}
  UNION ALL
  SELECT 'search_query', item_id, CASE WHEN length(text) > 100 THEN 'query_max_100' END,
         NULL, NULL, NULL, NULL, NULL, NULL FROM benchmark
  UNION ALL
  SELECT 'reflection', id, CASE WHEN len(kt) BETWEEN 3 AND 5 THEN NULL ELSE 'gaps_3_to_5' END,
         NULL, NULL, NULL, NULL, NULL, NULL FROM {SQL_DOC_TERMS}
  UNION ALL
  SELECT 'final_summary', doc_id,
         CASE WHEN len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) >= 1000 THEN NULL
              ELSE 'summary_min_1000_words' END,
         NULL, NULL, NULL, NULL, NULL, NULL FROM documents)
SELECT record_kind, record_id, concat_ws(',', r1, r2, r3, r4, r5, r6, r7) = '' AS valid,
       concat_ws(',', r1, r2, r3, r4, r5, r6, r7) AS reasons FROM r""")
def q_validate_records(spark, sf):
    return vd.validate_records(validation_input(spark, sf)).select("record_kind", "record_id", "valid", "reasons")


@register("record_levels", f"""
SELECT level, count(*) AS n, level IN ({", ".join(q(x) for x in LEVELS)}) AS valid FROM (
  SELECT CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warning' WHEN 'signup' THEN 'debug'
              ELSE 'info' END AS level FROM events) GROUP BY level""")
def q_record_levels(spark, sf):
    from .records_queries import records
    from ..operators.records import valid_level
    r = records(spark, sf).groupBy("level").agg(F.count("*").alias("n"))
    return r.withColumn("valid", valid_level(F.col("level")))
