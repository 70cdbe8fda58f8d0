"""A corpus pipeline of five stages, each calling one operator of ``tessera.llm``.

``run(spark, sf_dir)`` applies ``STAGES`` to ``documents``: each stage's result is written as
Parquet to the shared folder and reread as the next one's ``docs``.  All stages but the last
return the columns of ``documents``; the last returns the packed pieces.

Rows with a null text go in the first stage, as they have no language; a null doc_id stays a
document without a name: it counts nowhere in line and near-duplicate counts.  Columns beyond
``doc_id`` and ``text`` are carried along whatever their names; ``n_chars``, where it is there,
follows the text.  Empty tables give empty results.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, language_id, line_dedup, near_dup, packing, tokens
from tessera.llm.shared import fresh_path
from tessera.session import configure, scratch_dir


def stage(fn):
    """A stage sets the session up as the registered queries do."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return fn(configure(spark), docs, sf_dir)
    return run_stage


@stage
def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know; the profiles learn from ``docs`` itself."""
    return language_id.keep_recognised(docs, language_id.fit(docs))


@stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that stand in five or more are left in one of them."""
    out = line_dedup.dedup_lines(spark, docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


@stage
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.keep_first(spark, docs)


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate."""
    return decontam.keep_clean(spark, docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokens.vocabulary("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language", recognised), ("lines", without_repeated_lines), ("near_duplicates", without_near_duplicates),
          ("benchmark", without_benchmark), ("packing", packed)]

#: no SQL: the learned language profiles and the tokenizer are beyond it; tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base = fresh_path(scratch_dir(spark, "pipeline"))
    for i, (name, apply) in enumerate(STAGES):
        out = apply(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{i}_{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{i}_{name}")
    return docs
