"""Registered streaming queries.

Each one writes its input stream as files (derived from the driver tables)
into a fresh folder under the shared checkpoint directory, runs the
Structured Streaming query with an ``availableNow`` trigger, and returns
the sink's read-back view, which must equal the batch equivalent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import messages as mg
from ..session import scratch_dir
from ..streaming import streams as ss
from . import store_queries as sq
from .common import register, table
from .message_queries import EPOCH_2024, ISO_SQL, PIECE

SEQ_STRIDE = 1_000_000
BLANK_SEQ = 999_999
STEP_MS = 4
LIST_PIECE = 50
MICRO_BATCHES = 4


def _fresh(spark, name):
    base = scratch_dir(spark, f"{name}_{uuid.uuid4().hex}")
    return base, f"{base}/source", f"{base}/checkpoint"


def _files_per_batch(spark, src):
    """Files a trigger takes so that the stream comes in about ``MICRO_BATCHES`` micro-batches."""
    return -(-len(spark.read.parquet(src).inputFiles()) // MICRO_BATCHES)


def _msg_sec():
    return F.lit(EPOCH_2024) + F.col("conv_id") * 3600 + F.col("turn")


def chat_line_stream(spark, sf):
    """(conv_id, seq, line): user prompts once, model answers as growing cumulative lines
    (20-character steps), plus one blank line per answer."""
    c = table(spark, sf, "conversations")
    iso = mg.iso_timestamp(F.timestamp_seconds(_msg_sec()))
    users = c.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") * SEQ_STRIDE).alias("seq"),
        F.to_json(F.struct(F.lit("user").alias("role"), iso.alias("timestamp"), F.col("text").alias("content")))
         .alias("line"))
    a = c.where(F.col("role") == "assistant").withColumn("iso", iso)
    p = mg.pieces(a, "text", PIECE, ["conv_id", "turn", "iso"], prefix_col="so_far")
    answers = p.select("conv_id", (F.col("turn") * SEQ_STRIDE + F.col("seq")).alias("seq"),
                       F.to_json(F.struct(F.lit("model").alias("role"), F.col("iso").alias("timestamp"),
                                          F.col("so_far").alias("content")))
                        .alias("line"))
    blanks = a.select("conv_id", (F.col("turn") * SEQ_STRIDE + BLANK_SEQ).alias("seq"), F.lit("").alias("line"))
    return users.unionByName(answers).unionByName(blanks)


@register("stream_message_upsert", f"""
SELECT conv_id, strftime(make_timestamp(({EPOCH_2024} + conv_id * 3600 + turn) * 1000000), {ISO_SQL}) AS timestamp,
       CASE role WHEN 'user' THEN 'user' ELSE 'model' END AS role, md5(text) AS content_md5,
       length(text) AS content_chars, turn * {SEQ_STRIDE} AS first_seq
FROM conversations WHERE role IN ('user', 'assistant') AND (role = 'user' OR length(text) > 0)""")
def q_stream_message_upsert(spark, sf):
    base, src, ckpt = _fresh(spark, "upsert")
    chat_line_stream(spark, sf).repartition(MICRO_BATCHES * 2, F.xxhash64("conv_id", "seq")).write.parquet(src)
    out = ss.run_message_upsert(spark, src, "conv_id long, seq long, line string", f"{base}/log", ckpt,
                                max_files=_files_per_batch(spark, src), fold_after=2)
    return out.select("conv_id", "timestamp", "role", F.md5("content").alias("content_md5"),
                      F.length("content").cast("long").alias("content_chars"), "first_seq")


def chunk_stream(spark, sf):
    """(conv_id, turn, seq, event_time, text_so_far): answers in 20-character steps, 4 ms apart."""
    c = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    p = mg.pieces(c, "text", PIECE, ["conv_id", "turn"], prefix_col="text_so_far")
    et = F.timestamp_micros(_msg_sec() * 1_000_000 + F.col("seq") * STEP_MS * 1000)
    return p.select("conv_id", "turn", "seq", et.alias("event_time"), "text_so_far")


@register("stream_debounce", f"""
SELECT conv_id, turn, window_start, arg_max(seq, seq) AS seq, md5(arg_max(so_far, seq)) AS text_md5
FROM (SELECT conv_id, turn, seq, substr(text, 1, (seq + 1) * {PIECE}) AS so_far,
             ((({EPOCH_2024} + conv_id * 3600 + turn) * 1000 + seq * {STEP_MS}) // 10) * 10 AS window_start
      FROM (SELECT conv_id, turn, text, unnest(range(0, (length(text) + {PIECE - 1}) // {PIECE})) AS seq
            FROM conversations WHERE role = 'assistant'))
GROUP BY conv_id, turn, window_start""")
def q_stream_debounce(spark, sf):
    base, src, ckpt = _fresh(spark, "debounce")
    chunk_stream(spark, sf).repartition(MICRO_BATCHES * 2, F.xxhash64("conv_id", "turn", "seq")).write.parquet(src)
    out = ss.run_debounce(spark, src, "conv_id long, turn long, seq long, event_time timestamp, text_so_far string",
                          f"{base}/log", ckpt, max_files=_files_per_batch(spark, src), fold_after=2)
    return out.select("conv_id", "turn", F.unix_millis("window_start").alias("window_start"), "seq",
                      F.md5("text").alias("text_md5"))


def _json_num(c):
    return F.when(c.isNull(), F.lit("null")).otherwise(F.format_string("%.1f", c))


def _json_str(c):
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def whale_lists(spark, sf):
    """Lists of up to ten whales (part_key div 10) as JSON array text."""
    w = sq_whales(spark, sf)
    obj = F.concat(F.lit('{"name":'), _json_str(F.col("name")), F.lit(',"length":'), _json_num(F.col("length")),
                   F.lit(',"weight":'), _json_num(F.col("weight")), F.lit(',"ocean":'), _json_str(F.col("ocean")),
                   F.lit(',"description":'), _json_str(F.col("description")), F.lit("}"))
    g = (w.select((F.col("part_key") / 10).cast("long").alias("list_id"), "part_key", obj.alias("o"))
          .groupBy("list_id").agg(F.array_sort(F.collect_list(F.struct("part_key", "o"))).alias("os")))
    return g.select("list_id", F.concat(F.lit("["), F.array_join(F.transform("os", lambda x: x["o"]), ","),
                                        F.lit("]")).alias("text"))


def sq_whales(spark, sf):
    from .lookup_queries import whales
    return whales(spark, sf)


def list_chunks(spark, sf):
    lists = whale_lists(spark, sf).withColumn("n", F.ceil(F.length("text") / LIST_PIECE).cast("long"))
    p = mg.pieces(lists, "text", LIST_PIECE, ["list_id", "n"])
    return p.select("list_id", "seq", "delta", (F.col("seq") == F.col("n") - 1).alias("is_last"))


def _sql_json_num(c):
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE printf('%.1f', {c}) END"


def _sql_json_str(c):
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || {c} || '\"' END"


def _sql_partial():
    from .lookup_queries import SQL_WHALES
    obj = ("'{\"name\":' || " + _sql_json_str("name") + " || ',\"length\":' || " + _sql_json_num("length") +
           " || ',\"weight\":' || " + _sql_json_num("weight") + " || ',\"ocean\":' || " + _sql_json_str("ocean") +
           " || ',\"description\":' || " + _sql_json_str("description") + " || '}'")
    return f"""
WITH l AS (SELECT part_key // 10 AS list_id, '[' || string_agg({obj}, ',' ORDER BY part_key) || ']' AS text
           FROM {SQL_WHALES} GROUP BY 1),
c AS (SELECT list_id, text, unnest(range(0, (length(text) + {LIST_PIECE - 1}) // {LIST_PIECE})) AS seq,
             (length(text) + {LIST_PIECE - 1}) // {LIST_PIECE} AS n FROM l),
s AS (SELECT list_id, seq, seq = n - 1 AS is_last, substr(text, 1, (seq + 1) * {LIST_PIECE}) AS so_far FROM c),
o AS (SELECT *, regexp_extract_all(so_far, '\\{{[^{{}}]*\\}}') AS objs FROM s)
SELECT list_id, seq, is_last, n_complete, n_valid,
       CASE WHEN is_last THEN coalesce(json_valid(so_far) AND json_type(so_far) = 'ARRAY', false) AND n_valid = n_complete
       END AS strict_ok
FROM (SELECT *, len(objs) AS n_complete,
       len(list_filter(objs, lambda x: json_extract_string(x, '$.name') IS NOT NULL
                                    AND json_extract_string(x, '$.length') IS NOT NULL
                                    AND (json_extract_string(x, '$.weight') IS NULL
                                         OR json_extract_string(x, '$.weight')::DOUBLE >= 50))) AS n_valid FROM o)"""


@register("stream_partial_records", _sql_partial())
def q_stream_partial_records(spark, sf):
    base, src, ckpt = _fresh(spark, "partial")
    # dealt by a hash of list and position: pieces of one list arrive in any order
    list_chunks(spark, sf).repartition(MICRO_BATCHES * 2, F.xxhash64("list_id", "seq")).write.parquet(src)
    out = ss.run_partial_records(spark, src, "list_id long, seq long, delta string, is_last boolean", base, ckpt,
                                 max_files=_files_per_batch(spark, src))
    return out.select("list_id", "seq", "is_last", "n_complete", "n_valid", "strict_ok")


@register("stream_load_sections", sq.SQL_FINAL_STORE)
def q_stream_load_sections(spark, sf):
    base, src, ckpt = _fresh(spark, "stream_store")
    batch = sq.batch_fixture(spark, sf)
    batch.where("pos.copy = 0").write.parquet(src)
    batch.where("pos.copy = 1").write.mode("append").parquet(src)  # repeats arrive after every original
    store = sq.store_fixture(spark, sf)
    return sq.stored_rows(ss.run_stream_load(spark, src, batch.schema, store.path, ckpt, max_files=3))
