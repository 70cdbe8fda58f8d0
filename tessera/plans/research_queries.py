"""Registered queries: research corpus (search results, pages, key terms, registry, citations)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import posexplode_rows
from ..operators import research as rs
from ..session import scratch_dir
from ..sources import files as fs
from .common import (q, register, sql_html_text, sql_html_title, sql_key_terms_table, sql_sentences,
                     sql_urls, sql_word_tokens, table)

NL = "\n"
MAX_RESULTS = 5
UNKNOWN_URL = "https://unknown.example/none"
STOP_SQL = "[" + ", ".join(q(s) for s in tx.KEY_TERM_STOPWORDS) + "]"


# --- search payloads ------------------------------------------------------------

def payloads(spark, sf):
    """pages -> provider payloads (FIXTURES.md: search payloads); search_id = page_id div 10."""
    p = table(spark, sf, "pages")
    title, body, url = tx.html_title(F.col("html")), tx.html_to_text(F.col("html")), F.col("url")
    m = F.col("page_id") % 3
    no_title = F.col("page_id") % 11 == 0
    def obj(t_key, u_key, b_key):
        with_t = F.to_json(F.struct(title.alias("title"), url.alias(u_key), body.alias(b_key)))
        without = F.to_json(F.struct(url.alias(u_key), body.alias(b_key)))
        return F.when(no_title, without).otherwise(with_t)
    payload = (F.when(m == 0, obj("title", "href", "body")).when(m == 1, obj("title", "url", "content"))
                .otherwise(obj("title", "url", "description")))
    # every 13th page is delivered twice (the repeat right after the original), in one pass
    pos = F.col("page_id") * 2
    positions = F.when(F.col("page_id") % 13 == 0, F.array(pos, pos + 1)).otherwise(F.array(pos))
    return p.select((F.col("page_id") / 10).cast("long").alias("search_id"),
                    F.when(m == 0, "A").when(m == 1, "B").otherwise("C").alias("provider"),
                    F.explode(positions).alias("pos"), payload.alias("payload"))


def _sql_obj(u_key, b_key):
    return (f"CASE WHEN page_id % 11 = 0 THEN json_object('{u_key}', url, '{b_key}', body)::VARCHAR "
            f"ELSE json_object('title', title, '{u_key}', url, '{b_key}', body)::VARCHAR END")


SQL_PAYLOADS = f"""
WITH p AS (SELECT page_id, url, {sql_html_title('html')} AS title, {sql_html_text('html')} AS body FROM pages),
b AS (SELECT page_id // 10 AS search_id,
             CASE page_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS provider, page_id * 2 AS pos,
             CASE page_id % 3 WHEN 0 THEN {_sql_obj('href', 'body')} WHEN 1 THEN {_sql_obj('url', 'content')}
                  ELSE {_sql_obj('url', 'description')} END AS payload, page_id FROM p)
SELECT search_id, provider, pos, payload FROM b
UNION ALL SELECT search_id, provider, pos + 1, payload FROM b WHERE page_id % 13 = 0"""


def _sql_pick(i):
    parts = " ".join(f"WHEN '{prov}' THEN json_extract_string(payload, '$.{fields[i]}')"
                     for prov, fields in rs.PROVIDER_FIELDS.items())
    return f"coalesce(CASE provider {parts} END, '')"


SQL_NORMALIZED = f"""
WITH r AS (SELECT search_id, provider, pos, {_sql_pick(0)} AS title, {_sql_pick(1)} AS url,
                  {_sql_pick(2)} AS content, '' AS summary FROM ({SQL_PAYLOADS})),
u AS (SELECT *, row_number() OVER (PARTITION BY search_id, provider, url ORDER BY pos) AS fu FROM r),
k AS (SELECT * FROM u WHERE provider <> 'C' OR fu = 1)
SELECT search_id, provider, title, url, content, summary, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY search_id, provider ORDER BY pos) AS rank FROM k) WHERE rank <= {MAX_RESULTS}"""


@register("normalize_search_results", SQL_NORMALIZED)
def q_normalize_search_results(spark, sf):
    return rs.normalize_search_results(payloads(spark, sf), MAX_RESULTS)


def _sql_xml(tag):
    text = f"replace(replace(replace({tag}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return f"'    <{tag}>' || {text} || '</{tag}>' || chr(10)"


@register("rows_to_xml", f"""
SELECT search_id, '<search_results>' || chr(10) || string_agg(x, chr(10) ORDER BY rank, x) || chr(10) || '</search_results>' AS xml
FROM (SELECT search_id, rank, '<result>' || chr(10) || {" || ".join(map(_sql_xml, ("title", "url", "content", "summary")))} || '</result>' AS x
      FROM ({SQL_NORMALIZED})) GROUP BY search_id""")
def q_rows_to_xml(spark, sf):
    n = rs.normalize_search_results(payloads(spark, sf), MAX_RESULTS)
    return rs.rows_to_xml(n, "search_id", "rank", ["title", "url", "content", "summary"])


@register("fetch_pages", f"""
SELECT r.url, p.url IS NOT NULL AS found, {sql_html_text('p.html')} AS content
FROM (SELECT url FROM pages UNION ALL SELECT '{UNKNOWN_URL}') r LEFT JOIN pages p ON p.url = r.url""")
def q_fetch_pages(spark, sf):
    p = table(spark, sf, "pages")
    reqs = p.select("url").unionByName(spark.createDataFrame([(UNKNOWN_URL,)], "url string"))
    return rs.fetch_pages(reqs, p).select("url", "found", "content")


def _sql_terms(e):
    return (f"list_filter({sql_word_tokens(e)}, lambda t: regexp_full_match(t, '[a-z]{{3,}}') "
            f"AND NOT list_contains({STOP_SQL}, t))")


@register("search_pages", f"""
WITH qt AS (SELECT DISTINCT qkey, token FROM (
              SELECT md5(text) AS qkey, unnest({_sql_terms('text')}) AS token FROM benchmark)),
pt AS (SELECT page_id, url, unnest({_sql_terms(sql_html_text('html'))}) AS token FROM pages),
h AS (SELECT qkey, page_id, url, count(DISTINCT token) AS distinct_hits, count(*) AS total_hits
      FROM pt JOIN qt USING (token) GROUP BY qkey, page_id, url),
top AS (SELECT *, row_number() OVER (PARTITION BY qkey ORDER BY distinct_hits DESC, total_hits DESC, page_id) AS rank
        FROM h)
SELECT b.item_id AS query_id, t.page_id, t.url, coalesce(t.distinct_hits, 0) AS distinct_hits,
       coalesce(t.total_hits, 0) AS total_hits, t.rank
FROM benchmark b LEFT JOIN (SELECT * FROM top WHERE rank <= {MAX_RESULTS}) t ON t.qkey = md5(b.text)""")
def q_search_pages(spark, sf):
    qs = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return rs.search_pages(qs, table(spark, sf, "pages"), MAX_RESULTS) \
        .select("query_id", "page_id", "url", "distinct_hits", "total_hits", "rank")


# --- summaries, key terms, registry ----------------------------------------------

def summaries(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("topic"), F.col("lang").alias("aspect"), F.col("doc_id").alias("pos"),
                    F.col("text").alias("summary"))


SQL_DOC_TERMS = sql_key_terms_table("SELECT doc_id, text FROM documents", "doc_id", "text")
SQL_REGISTRY = f"""
SELECT topic, aspect, arg_max(kt, pos) AS terms, min(pos) AS pos FROM (
  SELECT d.source AS topic, d.lang AS aspect, d.doc_id AS pos, k.kt FROM documents d JOIN {SQL_DOC_TERMS} k
  ON k.id = d.doc_id)
GROUP BY topic, aspect"""


@register("key_terms", f"SELECT id AS doc_id, array_to_string(kt, ',') AS terms FROM {SQL_DOC_TERMS}")
def q_key_terms(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return rs.key_terms(d, "text").select("doc_id", F.array_join("terms", ",").alias("terms"))


@register("aspect_registry", f"SELECT topic, aspect, array_to_string(terms, ',') AS terms, pos FROM ({SQL_REGISTRY})")
def q_aspect_registry(spark, sf):
    r = rs.aspect_registry(summaries(spark, sf))
    return r.select("topic", "aspect", F.array_join("terms", ",").alias("terms"), "pos")


@register("research_context", f"""
SELECT topic, 'Research Context:' || chr(10) ||
       string_agg('- ' || aspect || ': ' || array_to_string(list_slice(terms, 1, 3), ', '), chr(10) ORDER BY pos)
       AS context
FROM ({SQL_REGISTRY}) GROUP BY topic""")
def q_research_context(spark, sf):
    s = summaries(spark, sf)
    return rs.research_context(rs.aspect_registry(s), s)


@register("aspect_already_covered", f"""
WITH reg AS ({SQL_REGISTRY}),
cand AS (SELECT DISTINCT source AS topic, lang AS aspect FROM documents
         UNION SELECT DISTINCT source, 'xx' FROM documents),
keys AS (SELECT topic, string_agg(aspect, ', ' ORDER BY pos) AS keys FROM reg GROUP BY topic)
SELECT c.topic, c.aspect, (r.aspect IS NOT NULL) AS covered, CASE WHEN r.aspect IS NOT NULL THEN k.keys END AS avoid
FROM cand c LEFT JOIN reg r ON r.topic = c.topic AND r.aspect = c.aspect LEFT JOIN keys k ON k.topic = c.topic""")
def q_aspect_already_covered(spark, sf):
    s = summaries(spark, sf)
    cand = (s.select("topic", "aspect").distinct()
             .unionByName(s.select("topic").distinct().withColumn("aspect", F.lit("xx"))))
    return rs.aspect_already_covered(cand, rs.aspect_registry(s)).select("topic", "aspect", "covered", "avoid")


@register("export_report", f"""
SELECT lower(regexp_replace(topic, '[^a-zA-Z0-9]', '_', 'g')) || '.md' AS file_name,
       arg_max('## ' || topic || '{NL}{NL}' || report, pos) AS body
FROM (SELECT source AS topic, arg_max(text, doc_id) AS report, max(doc_id) AS pos FROM documents GROUP BY source)
GROUP BY 1""")
def q_export_report(spark, sf):
    s = summaries(spark, sf)
    reports = s.groupBy("topic").agg(F.max_by("summary", "pos").alias("report"), F.max("pos").alias("pos"))
    folder = scratch_dir(spark, f"reports_{uuid.uuid4().hex}")
    rs.write_reports(rs.export_report(reports), folder)
    return fs.read_text_docs(spark, folder).select(F.col("name").alias("file_name"), F.col("text").alias("body"))


# --- reports and citations ------------------------------------------------------

def reports(spark, sf):
    """One report per page: links to pages i, i+1, i, 3i (a missing page gets a placeholder url), then the
    page as it is."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    p = pages.drop("html")
    p1 = p.select(F.col("page_id").alias("j1"), F.col("url").alias("u1"))
    p3 = p.select(F.col("page_id").alias("j3"), F.col("url").alias("u3"))
    r = (pages.join(p1, F.col("j1") == F.col("page_id") + 1, "left")
          .join(p3, F.col("j3") == F.col("page_id") * 3, "left"))
    u1 = F.coalesce("u1", F.concat(F.lit("https://missing.example/"), (F.col("page_id") + 1).cast("string")))
    u3 = F.coalesce("u3", F.concat(F.lit("https://missing.example/"), (F.col("page_id") * 3).cast("string")))
    i = F.col("page_id").cast("string")
    text = F.concat(F.lit("Report "), i, F.lit(" cites [page "), i, F.lit("]("), F.col("url"), F.lit(") and "), u1,
                    F.lit(" here. Then [again]("), F.col("url"), F.lit(") and finally "), u3, F.lit(" end. "), F.coalesce("html", F.lit("")))
    return r.select(F.col("page_id").alias("report_id"), text.alias("report"))


SQL_REPORTS = """
SELECT p.page_id AS report_id,
       'Report ' || p.page_id || ' cites [page ' || p.page_id || '](' || p.url || ') and ' ||
       coalesce(p1.url, 'https://missing.example/' || (p.page_id + 1)) || ' here. Then [again](' || p.url ||
       ') and finally ' || coalesce(p3.url, 'https://missing.example/' || (p.page_id * 3)) || ' end. ' || coalesce(p.html, '') AS report
FROM pages p LEFT JOIN pages p1 ON p1.page_id = p.page_id + 1 LEFT JOIN pages p3 ON p3.page_id = p.page_id * 3"""
SQL_REPORT_URLS = f"""
SELECT report_id, unnest(range(len(u))) AS pos, unnest(u) AS url FROM (
  SELECT report_id, {sql_urls('report')} AS u FROM ({SQL_REPORTS}))"""


def report_urls(spark, sf):
    r = rs.extract_urls(reports(spark, sf), "report", "urls")
    return posexplode_rows(r, ["report_id"], "urls", "pos", "url").withColumn("pos", F.col("pos").cast("long"))


@register("extract_urls", SQL_REPORT_URLS)
def q_extract_urls(spark, sf):
    return report_urls(spark, sf)


@register("allowed_citations", f"""
SELECT u.report_id, u.pos, u.url FROM ({SQL_REPORT_URLS}) u
WHERE EXISTS (SELECT 1 FROM pages p WHERE p.url = u.url AND p.page_id % 4 <> 3)""")
def q_allowed_citations(spark, sf):
    allowed = table(spark, sf, "pages").where(F.col("page_id") % 4 != 3).select("url")
    return rs.allowed_citations(report_urls(spark, sf), allowed).select("report_id", "pos", "url")


def existing_citations(spark, sf):
    """Even reports already cite page i+1 as [1]."""
    p = table(spark, sf, "pages").select("page_id", "url")
    nxt = p.select(F.col("page_id").alias("j"), F.col("url").alias("next_url"))
    e = p.where(F.col("page_id") % 2 == 0).join(nxt, F.col("j") == F.col("page_id") + 1)
    return e.select(F.col("page_id").alias("report_id"), F.col("next_url").alias("url"),
                    F.lit(1).cast("long").alias("n"))


@register("citation_numbers", f"""
WITH u AS ({SQL_REPORT_URLS}),
ex AS (SELECT p.page_id AS report_id, p1.url, 1::BIGINT AS n FROM pages p JOIN pages p1 ON p1.page_id = p.page_id + 1
       WHERE p.page_id % 2 = 0),
f AS (SELECT report_id, url, min(pos) AS pos FROM u GROUP BY report_id, url),
nw AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.report_id = f.report_id AND ex.url = f.url)),
base AS (SELECT report_id, max(n) AS base FROM ex GROUP BY report_id),
numbered AS (
SELECT report_id, url, n FROM ex
UNION ALL
SELECT nw.report_id, nw.url, coalesce(base.base, 0) + row_number() OVER (PARTITION BY nw.report_id ORDER BY nw.pos) AS n
FROM nw LEFT JOIN base ON base.report_id = nw.report_id),
titles AS (SELECT url, arg_min({sql_html_title('html')}, page_id) AS title FROM pages GROUP BY url)
SELECT c.report_id, c.url, c.n, t.title FROM numbered c LEFT JOIN titles t ON t.url = c.url""")
def q_citation_numbers(spark, sf):
    titles = rs.page_titles(table(spark, sf, "pages"))
    return rs.citation_numbers(report_urls(spark, sf), existing_citations(spark, sf), titles=titles)


def annotated_reports(spark, sf):
    r = reports(spark, sf)
    marks = F.when(F.col("report_id") % 4 == 0, F.lit(" [1][1]")).otherwise(F.lit(" [1]"))
    a = F.concat("report", marks)
    a = F.when(F.col("report_id") % 6 == 5, F.concat(F.lit("r"), F.regexp_replace(a, r"(?s)^.", ""))).otherwise(a)
    return r.withColumn("annotated", a)


@register("citation_integrity", f"""
WITH a AS (SELECT report_id, report,
                  CASE WHEN report_id % 6 = 5 THEN 'r' || substr(ann, 2) ELSE ann END AS annotated
           FROM (SELECT *, report || CASE WHEN report_id % 4 = 0 THEN ' [1][1]' ELSE ' [1]' END AS ann
                 FROM ({SQL_REPORTS})))
SELECT report_id,
       regexp_replace(annotated, '\\[\\d+\\]', '', 'g') = regexp_replace(report, '\\[\\d+\\]', '', 'g') AS accepted,
       coalesce(list_bool_or(list_transform({sql_sentences('annotated')},
         lambda s: len(regexp_extract_all(s, '\\[\\d+\\]')) <> len(list_distinct(regexp_extract_all(s, '\\[\\d+\\]'))))),
         false) AS repeated_marker
FROM a""")
def q_citation_integrity(spark, sf):
    return rs.citation_integrity(annotated_reports(spark, sf)).select("report_id", "accepted", "repeated_marker")


# --- plans ----------------------------------------------------------------------

def plan_subtasks(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("source").alias("plan_id"), F.col("doc_id").alias("pos"), F.col("lang").alias("id"),
                    F.col("text").alias("title"),
                    F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("objective"))


@register("subtask_lookup", """
WITH s AS (SELECT source AS plan_id, doc_id AS pos, lang AS id, text AS title,
                  'doc ' || doc_id AS objective FROM documents),
f AS (SELECT plan_id, id, min(pos) AS pos, arg_min(title, pos) AS title, arg_min(objective, pos) AS objective
      FROM s GROUP BY plan_id, id),
r AS (SELECT DISTINCT source AS plan_id, lang AS request_id FROM documents
      UNION SELECT DISTINCT source, 'xx' FROM documents)
SELECT r.plan_id, r.request_id, f.id IS NOT NULL AS found, f.pos, f.title, f.objective
FROM r LEFT JOIN f ON f.plan_id = r.plan_id AND f.id = r.request_id""")
def q_subtask_lookup(spark, sf):
    s = plan_subtasks(spark, sf)
    reqs = (s.select("plan_id", F.col("id").alias("request_id")).distinct()
             .unionByName(s.select("plan_id").distinct().withColumn("request_id", F.lit("xx"))))
    return rs.subtask_lookup(s, reqs).select("plan_id", "request_id", "found", "pos", "title", "objective")
