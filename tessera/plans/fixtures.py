"""Inputs derived from the driver tables (FIXTURES.md part 2), in Spark.

Each builder takes (spark, sf_dir) and returns a DataFrame whose size grows
with the tables.  The DuckDB oracle restates the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import sections as sec
from .common import table

CHUNK_SENTENCES = 10


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def doc_sentences(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, lang, sentences)"""
    d = (docs if docs is not None else documents(spark, sf)).select("doc_id", "source", "lang", "text")
    return sec.split_sentences(d).drop("text")


def doc_chunks(spark: SparkSession, sf: str, batch_size: int = CHUNK_SENTENCES,
               docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, path, chunk_idx, chunk) with path ``books/{source}/{doc_id}.pdf``."""
    s = sec.chunk_text(doc_sentences(spark, sf, docs), batch_size=batch_size)
    s = s.withColumn("path", F.concat(F.lit("books/"), F.col("source"), F.lit("/"),
                                      F.col("doc_id").cast("string"), F.lit(".pdf")))
    return sec.explode_indexed(s, "chunks", "chunk_idx", "chunk", ["doc_id", "source", "path"])


def chunk_sections(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """Book sections of every document chunk, with the chunk they come from."""
    c = doc_chunks(spark, sf, docs=docs)
    s = sec.book_sections(c)
    return s.select("doc_id", "chunk_idx", "uri", "title", "content", "embedding_content")


def text_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Every ``benchmark`` text as a retrieval query."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def doc_section_rows(spark: SparkSession, sf: str) -> DataFrame:
    """DocSection-shaped rows from documents."""
    d = documents(spark, sf)
    return d.select(
        F.col("doc_id").cast("int").alias("id"),
        F.when(F.col("doc_id") % 10 == 0, F.lit(None)).otherwise(F.col("doc_id") - 1).cast("int").alias("parent"),
        F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit(".md")).alias("path"),
        (F.col("doc_id") % 3 + 1).cast("int").alias("level"),
        F.col("text").alias("title"),
        F.col("text").alias("content"))


def marked_text(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences joined by the split marker; an extra blank piece for even doc ids."""
    s = doc_sentences(spark, sf)
    joined = F.array_join("sentences", tx.SPLIT_MARK)
    return s.select("doc_id", F.when(F.col("doc_id") % 2 == 0,
                                     F.concat(joined, F.lit(tx.SPLIT_MARK + "   " + tx.SPLIT_MARK)))
                    .otherwise(joined).alias("text"))


def scaled_vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    f = (1 + F.col("vec_id") % 5).cast("double")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * f).alias("embedding"))
