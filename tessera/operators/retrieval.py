"""Nearest-neighbour retrieval: exact batch kNN (L2 / cosine) and approximate kNN over written vector
indexes, and rendering hits as a context string.

Ordering is defined as (distance rounded to 6 places, corpus id), so ties are resolved identically
everywhere and results are reproducible.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .vector_index import MAX_GROUP_BYTES, SAMPLE_RECALL, HyperplaneIndex, PivotIndex

DEFAULT_K = 10


def knn_single(corpus: DataFrame, query: list[float], k: int = DEFAULT_K, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
    """Top-k for one query vector: distance as a column expression, ``orderBy(...).limit(k)``,
    which Spark plans as TakeOrderedAndProject (each task keeps k rows; k rows reach the driver)."""
    from ..functions.vectors import l2_distance

    qv = F.array(*[F.lit(float(x)) for x in query])
    d = F.round(l2_distance(F.col(vec_col), qv), 6)
    ranked = corpus.select(F.col(id_col), d.alias("distance")).orderBy("distance", id_col).limit(k)
    return ranked


def knn(corpus: DataFrame, queries: DataFrame, k: int = DEFAULT_K, metric: str = "l2",
        id_col: str = "vec_id", vec_col: str = "embedding",
        query_id_col: str = "query_id", query_vec_col: str = "embedding",
        pivots: int | None = None, max_group_bytes: int = MAX_GROUP_BYTES) -> DataFrame:
    """Exact top-k neighbours of every query, over a ``PivotIndex`` written to the shared folder.

    Returns ``(query_id, rank, <id_col>, distance)``; rank from 1; distance is Euclidean
    (``metric='l2'``) or ``1 - cosine`` (``metric='cosine'``, zero vectors never match), rounded to 6
    places.  To search one corpus many times, build its ``PivotIndex`` once."""
    path = scratch_dir(corpus.sparkSession, f"pivots_{uuid.uuid4().hex}")
    index = PivotIndex.build(corpus, path, id_col, vec_col, metric, pivots)
    return index.search(queries, k, query_id_col, query_vec_col, id_col, max_group_bytes)


def knn_approx(corpus: DataFrame, queries: DataFrame, k: int = DEFAULT_K, planes: int | None = None,
               rows_to_see: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding",
               query_id_col: str = "query_id", query_vec_col: str = "embedding",
               sample_recall: float = SAMPLE_RECALL, max_group_bytes: int = MAX_GROUP_BYTES) -> DataFrame:
    """Approximate L2 top-k over a ``HyperplaneIndex`` written to the shared folder.

    Every query gets min(k, corpus rows) rows, exact within the cells it visits; a neighbour in another
    cell is missed, which is what recall measures.  How many rows are seen is measured on sampled queries
    unless ``rows_to_see`` says it."""
    path = scratch_dir(corpus.sparkSession, f"planes_{uuid.uuid4().hex}")
    index = HyperplaneIndex.build(corpus, path, id_col, vec_col, planes)
    return index.search(queries, k, query_id_col, query_vec_col, id_col, rows_to_see, sample_recall, max_group_bytes)


def format_context(queries: DataFrame, hits: DataFrame, sections: DataFrame,
                   query_id_col: str = "query_id", id_col: str = "uri") -> DataFrame:
    """One context string per query: hits in rank order rendered as
    ``"# {title}\\nURI:{uri}\\n\\n{content}\\n"`` joined by a blank line; no hits -> "".

    ``hits`` is bounded (queries x k rows); sections are joined to it, so the section
    table is scanned once and never shuffled whole when the hit side is small (AQE)."""
    h = hits.join(sections.select(*dict.fromkeys([id_col, "uri", "title", "content"])), id_col)
    piece = F.concat(F.lit("# "), F.col("title"), F.lit("\nURI:"), F.col("uri"), F.lit("\n\n"),
                     F.col("content"), F.lit("\n"))
    per_q = (h.groupBy(F.col("query_id").alias(query_id_col))
              .agg(F.array_sort(F.collect_list(F.struct("rank", piece.alias("p")))).alias("hits")))
    return (queries.select(query_id_col).join(per_q, query_id_col, "left")
                   .select(query_id_col,
                           F.coalesce(F.array_join(F.transform("hits", lambda x: x["p"]), "\n\n"),
                                      F.lit("")).alias("context")))
