"""Strict JSON sources and the streaming forms (idempotence, batch equivalence)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tessera.plans import stream_queries as sq
from tessera.sources import files as fs


def test_doc_sections_array_file(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-json-")
    rows = [{"id": 1, "parent": None, "path": "a/b.md", "level": 1, "title": "T", "content": "C"},
            {"id": 2, "parent": 1, "path": "a/c.md", "level": 2, "title": "U", "content": "D"}]
    with open(os.path.join(d, "docs.json"), "w") as f:
        json.dump(rows, f)
    got = fs.read_doc_sections(spark, d, multi_line=True).orderBy("id").collect()
    assert [(r["id"], r["parent"], r["title"]) for r in got] == [(1, None, "T"), (2, 1, "U")]


def test_doc_sections_missing_key_fails(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-json-")
    with open(os.path.join(d, "docs.json"), "w") as f:
        json.dump([{"id": 1, "path": "a.md", "level": 1, "title": "T"}], f)  # no content
    with pytest.raises(Exception):
        fs.read_doc_sections(spark, d, multi_line=True).collect()


def test_doc_sections_bad_type_fails(spark):
    d = tempfile.mkdtemp(prefix="tessera-test-json-")
    with open(os.path.join(d, "docs.json"), "w") as f:
        json.dump([{"id": "x", "path": "a.md", "level": 1, "title": "T", "content": "C"}], f)
    with pytest.raises(Exception):
        fs.read_doc_sections(spark, d, multi_line=True).collect()


def test_list_files(spark, sf_small):
    names = sorted(r["name"] for r in fs.list_files(spark, sf_small, ".PARQUET").collect())
    assert "documents.parquet" in names and len(names) == 14


def test_stream_load_is_idempotent(spark, sf_small):
    from tessera.plans import store_queries as stq
    from tessera.session import scratch_dir
    from tessera.streaming import streams as ss
    import uuid

    base = scratch_dir(spark, f"test_stream_{uuid.uuid4().hex}")
    src, store = f"{base}/src", f"{base}/store"
    batch = stq.batch_fixture(spark, sf_small)
    batch.write.parquet(src)
    schema = batch.schema
    n1 = ss.run_stream_load(spark, src, schema, store, f"{base}/ck1").count()
    # a second query with a fresh checkpoint replays every file: nothing new is stored
    n2 = ss.run_stream_load(spark, src, schema, store, f"{base}/ck2").count()
    assert n1 == n2 == stq.fx.chunk_sections(spark, sf_small).count()


def test_upsert_keeps_last_content(spark, sf_small):
    out = sq.q_stream_message_upsert(spark, sf_small)
    conv = sq.table(spark, sf_small, "conversations").where(F.col("role") == "assistant")
    joined = out.where(F.col("role") == "model").join(
        conv.select("conv_id", F.md5("text").alias("content_md5")), ["conv_id", "content_md5"])
    assert joined.count() == conv.count()


def _write_in_time_order(df, folder, order_col, parts):
    """Write ``parts`` files one after another, each holding a later slice of ``order_col``,
    so the file source (oldest file first) sees the data arrive in event-time order."""
    bounds = df.approxQuantile(order_col, [i / parts for i in range(1, parts)], 0.0)
    edges = [None] + bounds + [None]
    for lo, hi in zip(edges, edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(order_col) > lo)
        if hi is not None:
            cond = cond & (F.col(order_col) <= hi)
        df.where(cond).coalesce(1).write.mode("append").parquet(folder)


def test_debounce_many_micro_batches_equals_one(spark, sf_small):
    """The same stream processed file by file (state carried across micro-batches, watermark
    advancing) gives the result of a single micro-batch."""
    import uuid
    from tessera.session import scratch_dir
    from tessera.streaming import streams as ss

    base = scratch_dir(spark, f"test_debounce_{uuid.uuid4().hex}")
    chunks = sq.chunk_stream(spark, sf_small).withColumn("t", F.col("event_time").cast("double"))
    _write_in_time_order(chunks, f"{base}/src", "t", 4)
    schema = "conv_id long, turn long, seq long, event_time timestamp, text_so_far string, t double"
    many = ss.run_debounce(spark, f"{base}/src", schema, f"{base}/log1", f"{base}/ck1", max_files=1)
    one = ss.run_debounce(spark, f"{base}/src", schema, f"{base}/log2", f"{base}/ck2")
    a = sorted(tuple(r) for r in many.collect())
    b = sorted(tuple(r) for r in one.collect())
    assert a == b and len(a) > 0


def _write_latest_first(df, folder, order_col, parts):
    """Files of falling event time, so all but the first hold rows hours behind the newest seen."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) / parts
    n = F.least(F.floor((F.col(order_col) - lo) / step), F.lit(parts - 1))
    for k in reversed(range(parts)):
        df.where(n == k).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_kept(spark, sf_small):
    import uuid
    from tessera.session import scratch_dir
    from tessera.streaming import streams as ss

    base = scratch_dir(spark, f"test_late_{uuid.uuid4().hex}")
    chunks = sq.chunk_stream(spark, sf_small).withColumn("t", F.col("event_time").cast("double"))
    _write_latest_first(chunks, f"{base}/chunks", "t", 5)
    schema = "conv_id long, turn long, seq long, event_time timestamp, text_so_far string, t double"
    runs = [sorted(tuple(r) for r in ss.run_debounce(spark, f"{base}/chunks", schema, f"{base}/d{n}", f"{base}/dc{n}",
                                                     max_files=n).collect()) for n in (1, None)]
    assert runs[0] == runs[1] and len(runs[0]) > 0

    lines = sq.chat_line_stream(spark, sf_small).withColumn("t", F.col("conv_id") * 1_000_000_000.0 + F.col("seq"))
    _write_latest_first(lines, f"{base}/lines", "t", 5)
    schema = "conv_id long, seq long, line string, t double"
    runs = [sorted(tuple(r) for r in ss.run_message_upsert(spark, f"{base}/lines", schema, f"{base}/u{n}",
                                                           f"{base}/uc{n}", max_files=n).collect()) for n in (1, None)]
    assert runs[0] == runs[1] and len(runs[0]) > 0


def test_upsert_many_micro_batches_equals_one(spark, sf_small):
    import uuid
    from tessera.session import scratch_dir
    from tessera.streaming import streams as ss

    base = scratch_dir(spark, f"test_upsert_{uuid.uuid4().hex}")
    lines = sq.chat_line_stream(spark, sf_small)
    _write_in_time_order(lines.withColumn("t", F.col("conv_id").cast("double")), f"{base}/src", "t", 4)
    schema = "conv_id long, seq long, line string, t double"
    many = ss.run_message_upsert(spark, f"{base}/src", schema, f"{base}/log1", f"{base}/ck1", max_files=1)
    one = ss.run_message_upsert(spark, f"{base}/src", schema, f"{base}/log2", f"{base}/ck2")
    a = sorted(tuple(r) for r in many.collect())
    b = sorted(tuple(r) for r in one.collect())
    assert a == b and len(a) > 0
