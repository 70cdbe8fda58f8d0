"""Typed ingest with constraint checks: valid rows and rejected rows with reasons.

Records arrive as JSON text of a declared kind; each kind is parsed with its
schema and checked with named rules.  A violated (or undecidable, i.e. null)
rule adds its name to ``reasons``; the job never stops on a bad record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .lookups import violations
from .records import LEVELS


def _support_rules(r: Column):
    return [("risk_range", r["risk"].between(0, 10)),
            ("advice_required", r["support_advice"].isNotNull()),
            ("block_card_required", r["block_card"].isNotNull())]


def _whale_rules(r: Column):
    return [("name_required", r["name"].isNotNull()),
            ("length_required", r["length"].isNotNull()),
            ("weight_min_50", r["weight"].isNull() | (r["weight"] >= 50))]


def _answer_rules(r: Column):
    return [("kind_in_domain", r["kind"].isin("success", "invalid_request")),
            ("sql_query_nonempty", (r["kind"] != "success") | (F.length(r["sql_query"]) >= 1)),
            ("error_message_required", (r["kind"] != "invalid_request") | r["error_message"].isNotNull())]


def _record_rules(r: Column):
    return [("level_in_domain", r["level"].isin(*LEVELS))]


# fixed values: limits stated for the research records
QUERY_MAX_CHARS = 100
GAPS_MIN, GAPS_MAX = 3, 5
SUMMARY_MIN_WORDS = 1000


def word_count(c: Column) -> Column:
    """Whitespace-separated words (``len(s.split())``)."""
    return F.size(F.array_remove(F.split(c, r"\s+", -1), ""))


def _query_rules(r: Column):
    return [("query_required", r["query"].isNotNull() & r["aspect"].isNotNull() & r["rationale"].isNotNull()),
            ("query_max_100", F.length(r["query"]) <= QUERY_MAX_CHARS)]


def _reflection_rules(r: Column):
    return [("gaps_3_to_5", F.size(r["knowledge_gaps"]).between(GAPS_MIN, GAPS_MAX)),
            ("covered_required", r["covered_topics"].isNotNull())]


def _summary_rules(r: Column):
    return [("summary_min_1000_words", word_count(r["summary"]) >= SUMMARY_MIN_WORDS)]


# kind -> (schema, rules); the rule names are ours, the constraints are the declared ones
KINDS = {
    "support": (S.SUPPORT_RESULT, _support_rules),
    "whale": (S.WHALE, _whale_rules),
    "sql_answer": (S.SQL_ANSWER, _answer_rules),
    "record": ("level string", _record_rules),
    "search_query": (S.WEB_SEARCH_QUERY, _query_rules),
    "reflection": (S.REFLECTION, _reflection_rules),
    "final_summary": (S.FINAL_SUMMARY, _summary_rules),
}


def validate_records(df: DataFrame, kind_col: str = "record_kind", json_col: str = "json") -> DataFrame:
    """(kind, id, json) -> the same rows plus ``valid`` and ``reasons`` (comma-separated rule names).

    Each row is parsed only with the schema of its own kind (the parse sits inside a CASE, which
    Spark evaluates lazily); rules of other kinds do not apply to it.  JSON that does not parse,
    or an unknown kind, violates ``parse``."""
    kind = F.col(kind_col)
    # from_json is permissive (malformed text gives a struct of nulls), so well-formedness is
    # tested on its own; an unknown kind also fails it
    parse_ok = kind.isin(*KINDS) & F.try_parse_json(F.col(json_col)).isNotNull()
    rules = []
    for k, (schema, make) in KINDS.items():
        parsed = F.when(kind == k, F.from_json(F.col(json_col), schema))
        rules += [(name, (kind != k) | cond) for name, cond in make(parsed)]
    reasons = violations(("parse", parse_ok), *rules)
    return df.withColumn("reasons", reasons).select(
        *df.columns, (F.size("reasons") == 0).alias("valid"), F.array_join("reasons", ",").alias("reasons"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons)."""
    return validated.where("valid").drop("reasons"), validated.where("NOT valid")
