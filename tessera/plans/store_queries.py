"""Registered queries: section store loads, anti-join probe, result zipping, fan-out cap."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..operators import retrieval as rt
from ..operators import lists as ls
from ..session import scratch_dir
from ..sinks import store as st
from . import fixtures as fx
from .common import register, table
from .text_queries import COS, DIM, L2, SQL_SECTIONS, _VEC, sql_embed, sql_knn


def emb_sum(vec):
    """Sum of the components rounded to 6 places; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return (F.round(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x), 6) + F.lit(0.0)).alias("emb_sum")


def stored_sections(spark, sf):
    """Sections of even documents: what is stored before the load."""
    return fx.chunk_sections(spark, sf).where(F.col("doc_id") % 2 == 0)


def store_fixture(spark, sf):
    """A store loaded with the sections of even documents."""
    store = st.SectionStore.create(spark, scratch_dir(spark, f"store_{uuid.uuid4().hex}"), dim=DIM)
    store.load(stored_sections(spark, sf).withColumn("pos", F.struct("doc_id", "chunk_idx")))
    return store


def batch_fixture(spark, sf):
    """Every section once (in section order) plus a changed repeat of every section of
    documents with doc_id % 7 = 0, positioned after all originals."""
    s = fx.chunk_sections(spark, sf)
    pos = lambda copy: F.struct(F.lit(copy).alias("copy"), "doc_id", "chunk_idx").alias("pos")
    first = F.struct("content", "embedding_content", pos(0))
    again = F.struct(F.concat("content", F.lit(" (copy)")).alias("content"),
                     F.concat("embedding_content", F.lit(" (copy)")).alias("embedding_content"), pos(1))
    # one pass over the sections: each row yields itself and, for every seventh document, its repeat
    rows = F.when(F.col("doc_id") % 7 == 0, F.array(first, again)).otherwise(F.array(first))
    return s.select("uri", "title", F.inline(rows))


SQL_STORE0 = f"SELECT * FROM ({SQL_SECTIONS}) WHERE doc_id % 2 = 0"
SQL_BATCH = f"""
SELECT 0 AS copy, doc_id, chunk_idx, uri, title, content, embedding_content FROM ({SQL_SECTIONS})
UNION ALL
SELECT 1, doc_id, chunk_idx, uri, title, content || ' (copy)', embedding_content || ' (copy)'
FROM ({SQL_SECTIONS}) WHERE doc_id % 7 = 0"""
SQL_DEDUPED = f"""
SELECT uri, title, content, embedding_content, copies FROM (
  SELECT *, row_number() OVER (PARTITION BY uri ORDER BY copy, doc_id, chunk_idx) AS rn,
         count(*) OVER (PARTITION BY uri) AS copies FROM ({SQL_BATCH})) WHERE rn = 1"""


def sql_store(new: str) -> str:
    """The stored rows after ``new`` rows were added."""
    return f"""
WITH store0 AS ({SQL_STORE0}), newrows AS ({new}),
allrows AS (SELECT uri, title, content, embedding_content FROM store0
            UNION ALL SELECT uri, title, content, embedding_content FROM newrows),
emb AS {sql_embed('SELECT uri, embedding_content FROM allrows', 'uri', 'embedding_content')}
SELECT a.uri, a.title, md5(a.content) AS content_md5, round(list_sum(e.emb), 6) + 0.0 AS emb_sum
FROM allrows a JOIN emb e ON e.id = a.uri"""


SQL_FINAL_STORE = sql_store(
    f"SELECT * FROM ({SQL_DEDUPED}) d WHERE NOT EXISTS (SELECT 1 FROM store0 s WHERE s.uri = d.uri)")
SQL_COLLECTION = f"""
SELECT d.*, (s.uri IS NOT NULL) AS "exists",
       CASE WHEN d.copies > 1 THEN 'reject_duplicate' WHEN s.uri IS NOT NULL THEN 'skip_existing'
            ELSE 'insert' END AS action
FROM ({SQL_DEDUPED}) d LEFT JOIN ({SQL_STORE0}) s ON s.uri = d.uri"""


def stored_rows(sections):
    return sections.select("uri", "title", F.md5("content").alias("content_md5"), emb_sum(F.col("embedding")))


@register("load_sections", SQL_FINAL_STORE)
def q_load_sections(spark, sf):
    store = store_fixture(spark, sf)
    st.load_sections(spark, store.path, batch_fixture(spark, sf), dim=DIM)
    return stored_rows(store.sections())


@register("load_collection", f"""
WITH c AS ({SQL_COLLECTION}), stored AS ({sql_store(f"SELECT * FROM ({SQL_COLLECTION}) WHERE action = 'insert'")})
SELECT c.uri, c.copies, c."exists", c.action, s.content_md5, s.emb_sum FROM c LEFT JOIN stored s ON s.uri = c.uri""")
def q_load_collection(spark, sf):
    """The strict load's report, with what the store holds of each uri after it."""
    store = store_fixture(spark, sf)
    report = store.load_collection(batch_fixture(spark, sf))
    return report.join(stored_rows(store.sections()).drop("title"), "uri", "left")


@register("new_sections_only", f"""
SELECT b.uri, b.copy, b.doc_id, b.chunk_idx, md5(b.content) AS content_md5 FROM ({SQL_BATCH}) b
WHERE NOT EXISTS (SELECT 1 FROM ({SQL_STORE0}) s WHERE s.uri = b.uri)""")
def q_new_sections_only(spark, sf):
    b = st.new_sections_only(batch_fixture(spark, sf), store_fixture(spark, sf))
    return b.select("uri", "pos.copy", "pos.doc_id", "pos.chunk_idx", F.md5("content").alias("content_md5"))


@register("search_store", f"""
WITH stored AS (SELECT uri, title, content, embedding_content FROM ({SQL_STORE0})
                UNION ALL SELECT uri, title, content, embedding_content FROM ({SQL_DEDUPED}) d
                WHERE NOT EXISTS (SELECT 1 FROM ({SQL_STORE0}) s WHERE s.uri = d.uri)),
hits AS ({sql_knn(sql_embed('SELECT item_id, text FROM benchmark', 'item_id', 'text'),
                  sql_embed('SELECT uri, embedding_content FROM stored', 'uri', 'embedding_content'),
                  COS, id_name='uri')})
SELECT h.query_id, h.rank, h.uri, h.distance, s.title, md5(s.content) AS content_md5
FROM hits h JOIN stored s ON s.uri = h.uri""")
def q_search_store(spark, sf):
    """Two loads by uri, then the cosine top-10 sections of every benchmark text."""
    store = store_fixture(spark, sf)
    store.load(batch_fixture(spark, sf))
    qs = vx.embed_text(fx.text_queries(spark, sf), "text", "embedding", DIM)
    hits = store.index("cosine").search(qs, rt.DEFAULT_K, id_col="uri")
    return hits.join(store.sections().select("uri", "title", F.md5("content").alias("content_md5")), "uri")


@register("zip_results", f"""
WITH h AS ({sql_knn(_VEC, _VEC, L2)})
SELECT h.query_id, h.rank - 1 AS pos, 'vec ' || h.vec_id AS title, 'label ' || e.label AS document
FROM h JOIN embeddings e ON e.vec_id = h.vec_id
WHERE h.rank <= (SELECT max(rank) FROM h h2 WHERE h2.query_id = h.query_id) - (h.query_id % 2)""")
def q_zip_results(spark, sf):
    e = table(spark, sf, "embeddings")
    hits = rt.knn(e, e.withColumnRenamed("vec_id", "query_id"), k=rt.DEFAULT_K)
    h = hits.join(e.select("vec_id", "label"), "vec_id")
    per_q = (h.groupBy("query_id")
              .agg(F.array_sort(F.collect_list(F.struct("rank", F.concat(F.lit("vec "), F.col("vec_id")).alias("t"),
                                                        F.concat(F.lit("label "), F.col("label")).alias("d"))))
                   .alias("hits")))
    per_q = per_q.select("query_id", F.transform("hits", lambda x: x["t"]).alias("titles"),
                         F.transform("hits", lambda x: x["d"]).alias("docs"))
    per_q = per_q.withColumn("docs", F.when(F.col("query_id") % 2 == 1,
                                            F.slice("docs", 1, F.size("docs") - 1)).otherwise(F.col("docs")))
    z = ls.zip_shortest(per_q, "titles", "docs", "title", "document", keep=["query_id"])
    return z


@register("fan_out_cap", """
SELECT run, pos, prompt FROM (
  SELECT source AS run, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos,
         text AS prompt FROM documents) WHERE pos <= 10""")
def q_fan_out_cap(spark, sf):
    d = table(spark, sf, "documents")
    p = d.select(F.col("source").alias("run"), "doc_id", F.col("text").alias("prompt"))
    return ls.fan_out_cap(p, "run", "doc_id", cap=10).select("run", "pos", "prompt")
