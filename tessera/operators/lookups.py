"""Validated records, keyed lookups and display formatting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import global_index, probe_join

MONEY = "decimal(18,2)"
ELLIPSIS = "…"
NOT_FOUND = "not found"

# fixed values: weather code -> description, and the fallback text
WEATHER_CODES = {
    1000: "Clear, Sunny",
    1100: "Mostly Clear",
    1101: "Partly Cloudy",
    1102: "Mostly Cloudy",
    1001: "Cloudy",
    2000: "Fog",
    2100: "Light Fog",
    4000: "Drizzle",
    4001: "Rain",
    4200: "Light Rain",
    4201: "Heavy Rain",
    5000: "Snow",
    5001: "Flurries",
    5100: "Light Snow",
    5101: "Heavy Snow",
    6000: "Freezing Drizzle",
    6001: "Freezing Rain",
    6200: "Light Freezing Rain",
    6201: "Heavy Freezing Rain",
    7000: "Ice Pellets",
    7101: "Heavy Ice Pellets",
    7102: "Light Ice Pellets",
    8000: "Thunderstorm",
}
WEATHER_UNKNOWN = "Unknown"
# fixed values: location used when no geocoding key is configured
DEFAULT_LAT, DEFAULT_LNG = 51.1, -0.1


def account_lookup(requests: DataFrame, accounts: DataFrame, id_col: str = "account_number") -> DataFrame:
    """Trimmed customer name per requested id; unmatched ids get ``found = false`` and a reason
    (the reference raises)."""
    a = accounts.select(id_col, F.regexp_replace("name", r"^\s+|\s+$", "").alias("name"))
    j = probe_join(requests, a, id_col)
    return j.withColumn("found", F.col("name").isNotNull()) \
            .withColumn("reject_reason", F.when(~F.col("found"), F.lit(NOT_FOUND)))


def account_balance(requests: DataFrame, accounts: DataFrame, id_col: str = "account_number") -> DataFrame:
    """Balance (plus pending when ``include_pending``) as decimal(18,2) and as ``$%.2f`` text
    (a decimal of scale 2 prints exactly two places, so the text is the decimal's plain form).
    A missing pending amount, which the reference cannot add, gives a reject reason."""
    a = accounts.select(id_col, F.col("balance").cast(MONEY).alias("balance"),
                        F.col("pending").cast(MONEY).alias("pending"))
    j = probe_join(requests, a, id_col)
    amount = F.when(F.col("include_pending"), F.col("balance") + F.col("pending")).otherwise(F.col("balance"))
    amount = amount.cast(MONEY)
    reason = (F.when(F.col("balance").isNull(), F.lit(NOT_FOUND))
               .when(F.col("include_pending") & F.col("pending").isNull(), F.lit("pending missing")))
    return j.select(id_col, "include_pending", amount.alias("amount"),
                    F.concat(F.lit("$"), amount.cast("string")).alias("amount_text"), reason.alias("reject_reason"))


def _shown(c: Column, number: bool) -> Column:
    """Display text; falsy values (null, 0, "") show as an ellipsis."""
    if number:
        v = F.bround(c.cast("double"), 0)
        return F.when(c.isNull() | (c == 0), F.lit(ELLIPSIS)).otherwise(F.format_string("%.0f", v))
    return F.when(c.isNull() | (c == ""), F.lit(ELLIPSIS)).otherwise(c)


def format_whale_rows(whales: DataFrame, order_cols: list[str]) -> DataFrame:
    """Display table: id from 1 in the given order, lengths/weights as whole numbers (half to even)."""
    rows = global_index(whales, order_cols, start=1, out_col="id")
    return rows.select("id", _shown(F.col("name"), False).alias("name"),
                       _shown(F.col("length"), True).alias("length"),
                       _shown(F.col("weight"), True).alias("weight"),
                       _shown(F.col("ocean"), False).alias("ocean"),
                       _shown(F.col("description"), False).alias("description"))


def weather_codes(spark) -> DataFrame:
    return spark.createDataFrame(sorted(WEATHER_CODES.items()), "weather_code int, description string")


def weather_report(obs: DataFrame) -> DataFrame:
    """``{temperature:0.0f}°C`` and the code description (``Unknown`` when not listed).

    The code table is a fixed 23-row constant, so broadcasting it is bounded."""
    codes = F.broadcast(weather_codes(obs.sparkSession))
    j = obs.join(codes, "weather_code", "left")
    return j.withColumn("temperature_text",
                        F.concat(F.format_string("%.0f", F.bround(F.col("temperature"), 0)), F.lit("°C"))) \
            .withColumn("description", F.coalesce("description", F.lit(WEATHER_UNKNOWN)))


def geocode_first(requests: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """First gazetteer match per place by match order.  ``use_default`` (no geocoder key) always
    gives the fixed default location; otherwise an unmatched place is rejected."""
    first = (gazetteer.groupBy("place")
                      .agg(F.min_by(F.struct("lat", "lng"), "match_order").alias("hit")))
    j = probe_join(requests, first, "place")
    found = F.col("hit").isNotNull()
    lat = F.when(F.col("use_default"), F.lit(DEFAULT_LAT)).when(found, F.col("hit.lat"))
    lng = F.when(F.col("use_default"), F.lit(DEFAULT_LNG)).when(found, F.col("hit.lng"))
    return j.select("place", "use_default", found.alias("found"), lat.alias("lat"), lng.alias("lng"),
                    F.concat(lat.cast("string"), F.lit(","), lng.cast("string")).alias("location"),
                    F.when(~found & ~F.col("use_default"), F.lit("location not found, retry")).alias("reject_reason"))


def sql_text_guard(answers: DataFrame) -> DataFrame:
    """Candidate SQL: drop every backslash, then require the upper-cased text to start with
    SELECT (no trimming).  InvalidRequest answers pass unchanged."""
    cleaned = F.replace(F.col("sql_query"), F.lit("\\"), F.lit(""))
    is_sql = F.col("kind") == "success"
    ok = F.when(is_sql, F.coalesce(F.startswith(F.upper(cleaned), F.lit("SELECT")), F.lit(False))).otherwise(F.lit(True))
    return answers.select("*", F.when(is_sql, cleaned).alias("cleaned_sql"), ok.alias("ok"),
                          F.when(~ok, F.lit("only SELECT statements are run")).alias("error"))


def violations(*rules: tuple[str, Column]) -> Column:
    """array<string> of the names of violated rules (a null test counts as violated)."""
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(None)).otherwise(F.lit(n))
                              for n, c in rules]), lambda x: x.isNotNull())
