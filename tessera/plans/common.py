"""Shared pieces of the registered queries: table access, the registry, and
DuckDB SQL fragments that restate our column rules for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import text as tx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- DuckDB fragments ---------------------------------------------------------

def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def sql_sentences(e: str) -> str:
    m = tx.SENTENCE_MARK
    a = f"regexp_replace({e}, {q(tx.LATIN_END)}, '\\1{m}', 'g')"
    b = f"regexp_replace({a}, {q(tx.CJK_END)}, '\\1{m}', 'g')"
    return (f"list_filter(list_transform(string_split({b}, '{m}'), lambda s: {sql_strip('s')}), "
            f"lambda s: s <> '')")


def sql_chunks(e: str, n: int) -> str:
    if n < 2:
        return e
    return (f"list_transform(range(0, len({e}), {n}), "
            f"lambda i: array_to_string(list_slice({e}, i + 1, i + {n}), ' '))")


def sql_word_tokens(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {q(tx.WORD_TOKEN)})"


def sql_key_terms_table(src: str, id_col: str, text_col: str, n: int = tx.KEY_TERM_COUNT) -> str:
    """Relation (id, kt LIST) with the key terms of every row of ``src``: tokens filtered, first
    position per distinct token, the first ``n`` by that position.  Relational, so it stays
    O(tokens log tokens) per text (a list_position dedupe would be quadratic)."""
    stop = "[" + ", ".join(q(s) for s in tx.KEY_TERM_STOPWORDS) + "]"
    toks = (f"list_filter({sql_word_tokens(text_col)}, lambda t: regexp_full_match(t, '[a-z]{{3,}}') "
            f"AND NOT list_contains({stop}, t))")
    return f"""
(WITH src AS (SELECT {id_col} AS id, {toks} AS toks FROM ({src})),
 t AS (SELECT id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM src),
 f AS (SELECT id, tok, min(pos) AS p FROM t GROUP BY id, tok),
 r AS (SELECT id, tok, row_number() OVER (PARTITION BY id ORDER BY p) AS rn FROM f),
 k AS (SELECT id, list(tok ORDER BY rn) AS kt FROM r WHERE rn <= {n} GROUP BY id)
 SELECT src.id, coalesce(k.kt, []::VARCHAR[]) AS kt FROM src LEFT JOIN k ON k.id = src.id)"""


def sql_urls(e: str) -> str:
    md = f"regexp_extract_all({e}, {q(tx.MD_LINK_URL)}, 1)"
    bare = f"regexp_extract_all({e}, {q(tx.BARE_URL)}, 1)"
    allu = f"list_concat({md}, {bare})"
    return f"list_filter({allu}, lambda u, i: list_position({allu}, u) = i)"


def sql_slug(e: str) -> str:
    folded = f"regexp_replace(strip_accents({e}), '[^\\x00-\\x7F]', '', 'g')"
    kept = f"regexp_replace({folded}, '[^a-zA-Z0-9_\\s-]', '', 'g')"
    return f"regexp_replace(lower({sql_strip(kept)}), '[-\\s]+', '-', 'g')"


def sql_stem(e: str) -> str:
    return f"regexp_replace(regexp_extract({e}, '([^/]*)$', 1), '\\.[^.]*$', '')"


def sql_html_text(e: str) -> str:
    t = f"regexp_replace({e}, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?s)<!--.*?-->', ' ', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for ent, ch in tx.HTML_ENTITIES:
        t = f"replace({t}, {q(ent)}, {q(ch)})"
    return sql_strip(f"regexp_replace({t}, '\\s+', ' ', 'g')")


def sql_html_title(e: str) -> str:
    return sql_strip(f"regexp_extract({e}, '(?is)<title>(.*?)</title>', 1)")
