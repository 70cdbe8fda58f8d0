"""Research corpus operators: search-result normalising, page fetch and keyword search,
key terms, the aspect registry, citations and report export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import scratch_dir
from ..sinks.named_files import write_named_files
from . import page_index as pi
from .lists import probe_join

# fixed values: field names of the three search providers' payloads
PROVIDER_FIELDS = {
    "A": ("title", "href", "body"),
    "B": ("title", "url", "content"),
    "C": ("title", "url", "description"),
}
UNIQUE_URL_PROVIDERS = ("C",)
NO_CONTEXT = "No research context available yet."
CONTEXT_HEADER = "Research Context:"
CONTEXT_TERMS = 3


def normalize_search_results(payloads: DataFrame, max_results: int = 5, search_col: str = "search_id",
                             pos_col: str = "pos") -> DataFrame:
    """(search_id, provider, pos, payload JSON) -> WebSearchResult rows ranked per search.

    Each provider's keys map onto (title, url, content); a missing key gives "";
    summary is always "".  For providers with unique results the first row per url
    is kept.  At most ``max_results`` rows per search (row_number, planned as a
    WindowGroupLimit so each task keeps only that many per search)."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in
                           sorted({f for fs in PROVIDER_FIELDS.values() for f in fs})])
    p = payloads.withColumn("j", F.from_json("payload", schema))
    def pick(i):
        e = None
        for prov, fields in PROVIDER_FIELDS.items():
            v = F.col(f"j.{fields[i]}")
            e = F.when(F.col("provider") == prov, v) if e is None else e.when(F.col("provider") == prov, v)
        return F.coalesce(e, F.lit(""))
    r = p.select(search_col, "provider", pos_col, pick(0).alias("title"), pick(1).alias("url"),
                 pick(2).alias("content"), F.lit("").alias("summary"))
    # unique-url providers: first row per url; min_by aggregates map-side, so a url repeated
    # across much of the input does not land whole in one task
    uniq = F.col("provider").isin(*UNIQUE_URL_PROVIDERS)
    rest = [c for c in r.columns if c not in (search_col, "provider", "url")]
    firsts = (r.where(uniq).groupBy(search_col, "provider", "url")
               .agg(F.min_by(F.struct(*rest), pos_col).alias("row"))
               .select(search_col, "provider", "url", "row.*"))
    r = r.where(~uniq).unionByName(firsts)
    w = Window.partitionBy(search_col, "provider").orderBy(pos_col)  # each provider has its own limit
    return (r.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= max_results)
             .drop(pos_col))


def fetch_pages(urls: DataFrame, pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Page text for each requested url (left join on url): ``found`` and ``content``."""
    p = pages.select(F.col("url").alias(url_col), F.col("html"))
    j = probe_join(urls, p, url_col)  # the page table is filtered to requested urls before any HTML work
    return (j.withColumn("content", tx.html_to_text(F.col("html"))).drop("html")
             .withColumn("found", F.col("content").isNotNull()))


def search_pages(queries: DataFrame, pages: DataFrame, max_results: int = 5) -> DataFrame:
    """Keyword search of every query over every page's text, by way of a page index that is written
    to the shared folder first (``page_index`` keeps one for further searches)."""
    path = scratch_dir(pages.sparkSession, f"pages_{uuid.uuid4().hex}")
    pi.write_index(pages, path)
    return pi.search_index(queries, pi.read_index(pages.sparkSession, path), max_results)


def key_terms(df: DataFrame, text_col: str = "summary", out_col: str = "terms") -> DataFrame:
    return df.withColumn(out_col, tx.key_terms(F.col(text_col)))


def aspect_registry(summaries: DataFrame, run_col: str = "topic") -> DataFrame:
    """(topic, aspect, summary, pos) -> registry (topic, aspect, terms, pos):
    the last write per aspect wins, the aspect keeps its first position."""
    t = key_terms(summaries, "summary", "terms")
    return (t.groupBy(run_col, "aspect")
             .agg(F.max_by("terms", "pos").alias("terms"), F.min("pos").alias("pos")))


def research_context(registry: DataFrame, runs: DataFrame, run_col: str = "topic") -> DataFrame:
    """One context text per run: header then ``- {aspect}: t1, t2, t3`` per aspect in
    registry order; a run without entries gets the fixed no-context sentence."""
    line = F.concat(F.lit("- "), F.col("aspect"), F.lit(": "),
                    F.array_join(F.slice("terms", 1, CONTEXT_TERMS), ", "))
    per = (registry.groupBy(run_col)
                   .agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("l")))).alias("ls")))
    body = F.concat_ws("\n", F.lit(CONTEXT_HEADER), F.array_join(F.transform("ls", lambda x: x["l"]), "\n"))
    return (runs.select(run_col).distinct().join(per, run_col, "left")
                .select(run_col, F.when(F.col("ls").isNull(), F.lit(NO_CONTEXT)).otherwise(body).alias("context")))


def aspect_already_covered(candidates: DataFrame, registry: DataFrame, run_col: str = "topic") -> DataFrame:
    """For each candidate (topic, aspect): ``covered`` when the aspect is a registry key, and
    ``avoid`` = all registry keys of the topic in order, joined by ", " (only when covered)."""
    keys = (registry.groupBy(run_col)
                    .agg(F.array_sort(F.collect_list(F.struct("pos", "aspect"))).alias("ks"))
                    .select(run_col, F.array_join(F.transform("ks", lambda x: x["aspect"]), ", ").alias("keys")))
    hit = registry.select(run_col, "aspect", F.lit(True).alias("covered"))
    c = candidates.join(hit, [run_col, "aspect"], "left").withColumn("covered", F.coalesce("covered", F.lit(False)))
    return (c.join(keys, run_col, "left")
             .withColumn("avoid", F.when(F.col("covered"), F.col("keys"))).drop("keys"))


def export_report(reports: DataFrame, topic_col: str = "topic", text_col: str = "report",
                  order_col: str = "pos") -> DataFrame:
    """(file_name, body): file name from the topic slug; topics sharing a slug -> last wins."""
    r = reports.select(tx.file_slug(F.col(topic_col)).alias("file_name"),
                       F.concat(F.lit("## "), F.col(topic_col), F.lit("\n\n"), F.col(text_col)).alias("body"),
                       order_col)
    return r.groupBy("file_name").agg(F.max_by("body", order_col).alias("body"))


def write_reports(reports: DataFrame, folder: str) -> None:
    """Each report as the file of its name in ``folder``; reports of that name there are replaced."""
    write_named_files(reports, folder, "file_name", "body")


def extract_urls(df: DataFrame, text_col: str = "text", out_col: str = "urls") -> DataFrame:
    return df.withColumn(out_col, tx.extract_urls(F.col(text_col)))


def allowed_citations(report_urls: DataFrame, allowed: DataFrame) -> DataFrame:
    """Only urls mined from the history may be cited: a semi join on url (the allowed side is
    broadcast by AQE when small, shuffled otherwise)."""
    return report_urls.join(allowed.select("url"), "url", "left_semi")


def page_titles(pages: DataFrame) -> DataFrame:
    """``url, title`` of pages(page_id, url, html): the title of the first page of each url."""
    return (pages.groupBy("url").agg(F.min_by(F.struct("html"), "page_id").alias("p"))
                 .select("url", tx.html_title(F.col("p.html")).alias("title")))


def citation_numbers(report_urls: DataFrame, existing: DataFrame, report_col: str = "report_id",
                     titles: DataFrame | None = None) -> DataFrame:
    """Number the urls of each report in first-use order; urls with an existing number keep it,
    new urls continue after the largest existing number.

    report_urls: (report_id, pos, url); existing: (report_id, url, n).  With ``titles(url, title)`` each
    citation has its title (null: unknown url)."""
    if titles is not None:
        return citation_numbers(report_urls, existing, report_col).join(titles, "url", "left") \
            .select(report_col, "url", "n", "title")
    first = report_urls.groupBy(report_col, "url").agg(F.min("pos").alias("pos"))
    new = first.join(existing.select(report_col, "url"), [report_col, "url"], "left_anti")
    base = existing.groupBy(report_col).agg(F.max("n").alias("base"))
    w = Window.partitionBy(report_col).orderBy("pos")
    numbered = (new.join(base, report_col, "left")
                   .withColumn("n", (F.coalesce("base", F.lit(0)) + F.row_number().over(w)).cast("long"))
                   .select(report_col, "url", "n"))
    return existing.select(report_col, "url", F.col("n").cast("long")).unionByName(numbered)


def citation_integrity(df: DataFrame, report_col: str = "report", annotated_col: str = "annotated") -> DataFrame:
    """``accepted``: the annotated report equals the report once ``[n]`` markers are removed from
    both; ``repeated_marker``: some sentence of the annotated report carries one marker twice."""
    same = tx.strip_citations(F.col(annotated_col)) == tx.strip_citations(F.col(report_col))
    sents = tx.sentences(F.col(annotated_col))
    rep = F.exists(sents, lambda s: F.size(F.regexp_extract_all(s, F.lit(tx.CITATION_MARK), 0)) !=
                   F.size(F.array_distinct(F.regexp_extract_all(s, F.lit(tx.CITATION_MARK), 0))))
    return df.withColumn("accepted", same).withColumn("repeated_marker", rep)


def subtask_lookup(subtasks: DataFrame, requests: DataFrame, plan_col: str = "plan_id") -> DataFrame:
    """First subtask (by position) whose id equals the request, per (plan, request); none -> nulls.

    subtasks: exploded plan (plan_id, pos, id, ...); requests: (plan_id, request_id).
    ``min_by`` aggregates partially map-side, so a plan with very many subtasks is cheap."""
    payload = [c for c in subtasks.columns if c not in (plan_col, "pos", "id")]
    first = (subtasks.groupBy(plan_col, F.col("id").alias("request_id"))
                     .agg(F.min_by(F.struct(*payload), "pos").alias("s"), F.min("pos").alias("pos")))
    return (requests.join(first, [plan_col, "request_id"], "left")
                    .select(plan_col, "request_id", F.col("s").isNotNull().alias("found"), "pos", "s.*"))


def subtask_in_plan(subtasks, request):
    """Array form of the lookup on one plan row: the first subtask whose id equals ``request``
    (null when none)."""
    return F.try_element_at(F.filter(subtasks, lambda s: s["id"] == request), F.lit(1))


def rows_to_xml(df: DataFrame, group_col: str, order_col: str, fields: list[str], row_tag: str = "result",
                root_tag: str = "search_results") -> DataFrame:
    """Per group: the rows rendered as XML elements in order inside a root element
    (``to_xml`` escapes markup)."""
    x = df.select(group_col, order_col,
                  F.to_xml(F.struct(*fields), {"rowTag": row_tag}).alias("x"))
    per = x.groupBy(group_col).agg(F.array_sort(F.collect_list(F.struct(order_col, "x"))).alias("xs"))
    return per.select(group_col, F.concat(F.lit(f"<{root_tag}>\n"),
                                          F.array_join(F.transform("xs", lambda e: e["x"]), "\n"),
                                          F.lit(f"\n</{root_tag}>")).alias("xml"))
