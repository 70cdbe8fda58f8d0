"""Inverted index of pages for keyword search, written once and asked many times.

The index is a Parquet table with one row per block of pages.  A row holds the block's page ids and
urls, its terms, and each term's postings (page in the block, occurrences) back to back, with the
largest count of each term as its bound.  Blocks are built inside the scan of the pages, one or more
per Arrow batch, so building shuffles nothing and holds one batch at a time.

A search scans the blocks.  Pages are ranked by how many of the query's terms they hold, then by how
often, then by id.  Each task keeps the best ``n`` pages of every query so far; their ``n``-th is the
bar that a further page must pass, which says what needs no look (MaxScore):

* a block that holds fewer of the query's terms than the bar, or as many with too small bounds, is
  skipped whole;
* if the bar is ``d`` terms, a page without any of the rarest ``m - d + 1`` of the ``m`` terms in the
  block cannot reach it, so only the postings of those are read; the others are looked up for the
  pages found.

Only the best ``n`` pages per query and task are shuffled.  Queries are sent to the executors in
groups of a checked size, each group's answers written before the next is sent.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import scratch_dir

BLOCK_PAGES = 2048
STOP = pa.array(tx.KEY_TERM_STOPWORDS)
MAX_QUERY_BYTES = 64 * 1024 * 1024
BLOCKS = ("page_id array<long>, url array<string>, terms array<string>, first array<int>, max_tf array<int>, "
          "page array<int>, tf array<int>")
HITS = "qkey string, page_id long, url string, distinct_hits long, total_hits long"


def terms_of(text: Column) -> Column:
    """Key-term tokens with repeats (ASCII, >= 3 letters), stopwords still among them."""
    return F.regexp_extract_all(F.lower(text), F.lit(tx.KEY_TERM_IN_TEXT), 0)


def _one_row(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_PAGES):
            rows = batch.slice(at, BLOCK_PAGES)
            tokens, n = rows.column("tokens"), rows.num_rows
            many = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(pc.list_flatten(tokens))
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            kept = ~pc.is_in(coded.dictionary, value_set=STOP).to_numpy(zero_copy_only=False)[code]
            pair, tf = np.unique((code * n + np.repeat(np.arange(n), many))[kept], return_counts=True)
            term, page = pair // n, pair % n
            first = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
            top = np.zeros(len(first) - 1, np.int64)
            np.maximum.at(top, term, tf)
            words = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
            urls = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column("url"))
            ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column("page_id"))
            yield pa.RecordBatch.from_arrays(
                [ids, urls, words, *(_one_row(x, pa.int32()) for x in (first, top, page, tf))],
                names=["page_id", "url", "terms", "first", "max_tf", "page", "tf"])


def index_blocks(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The blocks of ``pages(page_id, url, html)``; pages without an id are not indexed."""
    tokens = pages.where("page_id IS NOT NULL").select(
        F.col("page_id").cast("long").alias("page_id"), "url", terms_of(tx.html_to_text(F.col(html_col))).alias("tokens"))
    return tokens.mapInArrow(_build, BLOCKS)


def write_index(pages: DataFrame, path: str, mode: str = "error") -> None:
    """Write the index of ``pages``; ``mode="append"`` adds the blocks of further pages."""
    index_blocks(pages).write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


class _Block:
    """One index row as arrays."""

    def __init__(self, row: pa.RecordBatch, wanted: pa.Array):
        get = lambda c: row.column(c).flatten()
        self.page_id, self.url = get("page_id").to_numpy(), get("url")
        self.first, self.max_tf = get("first").to_numpy(), get("max_tf").to_numpy()
        self.page, self.tf = get("page").to_numpy(), get("tf").to_numpy()
        at = pc.index_in(wanted, value_set=get("terms"))
        self.place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False)  # of each wanted term
        # term by term and page by page: one sorted key to look pairs up
        self.n = len(self.page_id)
        self.key = np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), np.diff(self.first)) * self.n + self.page

    def postings(self, terms: np.ndarray) -> np.ndarray:
        """The places of all postings of the terms."""
        start, many = self.first[terms].astype(np.int64), np.diff(self.first)[terms]
        total = int(many.sum())
        return np.arange(total) - np.repeat(np.cumsum(many) - many - start, many)

    def best(self, terms: np.ndarray, n: int, bar: tuple[int, int]):
        """(distinct, total, page) of at most ``n`` pages of the query's ``terms`` that may pass ``bar``."""
        m, (d, t) = len(terms), bar
        if m < max(d, 1) or (m == d and self.max_tf[terms].sum() < t):
            return []
        many = np.diff(self.first)[terms]
        terms = terms[np.argsort(many, kind="stable")]
        rare, rest = terms[:m - max(d, 1) + 1], terms[m - max(d, 1) + 1:]
        at = self.postings(rare)
        hits = np.bincount(self.page[at], minlength=self.n)
        total = np.bincount(self.page[at], self.tf[at], self.n).astype(np.int64)
        pages = np.flatnonzero(hits)
        if len(rest):
            pages = pages[hits[pages] + len(rest) >= d]
            ask = (rest[:, None] * np.int64(self.n) + pages).ravel()
            got = np.searchsorted(self.key, ask)
            ok = np.flatnonzero(self.key[np.minimum(got, len(self.key) - 1)] == ask)
            row = pages[ok % max(len(pages), 1)]
            hits += np.bincount(row, minlength=self.n)
            total += np.bincount(row, self.tf[got[ok]], self.n).astype(np.int64)
        pages = pages[(hits[pages] > d) | ((hits[pages] == d) & (total[pages] >= t))]
        order = np.lexsort((self.page_id[pages], -total[pages], -hits[pages]))[:n]
        return [(int(hits[p]), int(total[p]), int(p)) for p in pages[order]]


def _search(sent, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, bounds, term, words = sent.value
        found: list[list] = [[] for _ in keys]
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Block(batch.slice(i, 1), words)
                for q in range(len(keys)):
                    place = block.place[term[bounds[q]:bounds[q + 1]]]
                    top = found[q]
                    bar = (-top[-1][0], -top[-1][1]) if len(top) == n else (0, 0)
                    more = block.best(place[place >= 0], n, bar)
                    if more:
                        top += [(-d, -t, int(block.page_id[p]), block.url[p].as_py()) for d, t, p in more]
                        top.sort(key=lambda x: x[:3])
                        del top[n:]
        rows = [(keys[q], p, u, -d, -t) for q, top in enumerate(found) for d, t, p, u in top]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["qkey", "page_id", "url", "distinct_hits", "total_hits"])
    return run


def _packed(rows: pa.Table):
    """Query keys, the bounds of their terms, the terms' numbers, and the distinct terms."""
    terms = rows["terms"].combine_chunks()
    coded = pc.dictionary_encode(terms.flatten())
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False))))
    return (rows["qkey"].to_pylist(), bounds, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary)


def search_index(queries: DataFrame, index: DataFrame, max_results: int = 5,
                 max_query_bytes: int = MAX_QUERY_BYTES) -> DataFrame:
    """Keyword search of every ``queries(query_id, text)`` over the blocks of an index.

    Query terms are the distinct key terms of the text; equal texts are searched once.  Returns
    ``query_id, page_id, url, distinct_hits, total_hits, rank``: the ``max_results`` best pages of each
    query, or one row without a page and with 0 hits for a query that no page answers."""
    spark = index.sparkSession
    texts = (queries.select("text").distinct()
             .select(F.md5("text").alias("qkey"), F.array_except(terms_of(F.col("text")), F.array(*map(F.lit, tx.KEY_TERM_STOPWORDS))).alias("terms"))
             .where(F.size("terms") > 0))
    size = texts.agg(F.sum(F.aggregate("terms", F.lit(40).cast("long"), lambda s, t: s + F.length(t) + 20))).first()[0]
    groups = -(-(size or 0) // max_query_bytes)
    path = scratch_dir(spark, f"search_{uuid.uuid4().hex}")
    hits = spark.createDataFrame([], HITS)
    for g in range(groups):
        part = texts if groups == 1 else texts.where(F.pmod(F.xxhash64("qkey"), F.lit(groups)) == g)
        rows = part.toArrow()
        if not rows.num_rows:
            continue
        sent = spark.sparkContext.broadcast(_packed(rows))
        found = index.mapInArrow(_search(sent, max_results), HITS)
        if groups == 1:
            hits = found
        else:
            found.write.mode("append").parquet(path)
            sent.destroy()
            hits = spark.read.schema(HITS).parquet(path)
    w = Window.partitionBy("qkey").orderBy(F.desc("distinct_hits"), F.desc("total_hits"), "page_id")
    top = hits.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= max_results)
    none = F.lit(0).cast("long")
    return (queries.select("query_id", F.md5("text").alias("qkey")).join(top, "qkey", "left")
            .select("query_id", "page_id", "url", F.coalesce("distinct_hits", none).alias("distinct_hits"),
                    F.coalesce("total_hits", none).alias("total_hits"), "rank"))
