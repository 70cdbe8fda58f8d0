"""The README usage example, end to end on the smallest tables."""

import uuid

from pyspark.sql import functions as F

from tessera.functions import vectors as vx
from tessera.operators import retrieval as rt
from tessera.operators import sections as sec
from tessera.session import configure, scratch_dir
from tessera.sinks import store as st


def test_readme_usage(spark, sf_small):
    configure(spark)
    shared = scratch_dir(spark, f"usage_{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    chunks = sec.chunk_text(sec.split_sentences(docs), batch_size=10)
    rows = sec.explode_indexed(chunks.withColumn("path", F.concat_ws("/", "source", "doc_id")),
                               "chunks", "chunk_idx", "chunk", ["doc_id", "path"])
    sections = sec.book_sections(rows).withColumn("pos", F.struct("doc_id", "chunk_idx"))
    store = st.SectionStore.create(spark, f"{shared}/store")
    store.load(sections.select("uri", "title", "content", "embedding_content", "pos"))
    questions = vx.embed_text(spark.read.parquet(f"{sf_small}/benchmark.parquet")
                              .withColumnRenamed("item_id", "query_id"), "text", "embedding")
    hits = store.index().search(questions, k=10, id_col="uri")
    context = rt.format_context(questions, hits, store.sections()).collect()
    assert len(context) == questions.count() and all(r["context"].startswith("# ") for r in context)
    assert store.sections().count() == sections.count()
