"""Registered queries: message log, chat lines, text views, fetched pages, usage, running text."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import messages as mg
from ..session import scratch_dir
from .common import register, table

EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z
BATCH_STRIDE = 1_000_000
TOOL_BATCH = 999_999
PIECE = 20
ISO_SQL = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

# Tool-use messages added to every fifth conversation (FIXTURES.md: tool parts).  The placeholders
# are, in order: timestamp, id, url a, url b, timestamp, url a, id, id, url b, id, id, url a.
TOOL_TEMPLATE = (
    '[{"kind":"response","timestamp":"%s","parts":['
    '{"part_kind":"tool-call","tool_name":"web_search","args":null},'
    '{"part_kind":"tool-call","tool_name":"web_search","args":"query %s"},'
    '{"part_kind":"tool-call","tool_name":"web_fetch","args":{"urls":["%s","%s"]}},'
    '{"part_kind":"text","content":"Searching the web"}]},'
    '{"kind":"request","timestamp":"%s","parts":['
    '{"part_kind":"tool-return","tool_name":"web_fetch","content":['
    '{"url":"%s","content":"page a of conversation %s"},{"url":%s,"content":"numeric url"},"junk item",'
    '{"url":"%s","content":"page b of conversation %s"}]},'
    '{"part_kind":"tool-return","tool_name":"web_search","content":[{"title":"result %s","url":"%s"}]}]}]')


def _url(conv, tag):
    return F.concat(F.lit("https://conv.example/"), conv.cast("string"), F.lit("/" + tag))


def message_batches(spark, sf):
    """conversations -> (batch_id, message_list): one batch per (conv_id, turn div 2), plus a
    tool-use batch for every fifth conversation."""
    c = table(spark, sf, "conversations")
    sec = F.lit(EPOCH_2024) + F.col("conv_id") * 3600 + F.col("turn")
    ts = F.timestamp_seconds(sec)
    part_ts = F.timestamp_micros(sec * 1_000_000 + 500_000)
    role = F.col("role")
    msg = F.struct(
        F.when(role == "assistant", "response").otherwise("request").alias("kind"),
        mg.iso_timestamp(ts).alias("timestamp"),
        F.array(F.struct(
            F.when(role == "user", "user-prompt").when(role == "system", "system-prompt").otherwise("text")
             .alias("part_kind"),
            F.col("text").alias("content"),
            F.when(role == "assistant", F.lit(None)).otherwise(mg.iso_timestamp(part_ts)).alias("timestamp")))
        .alias("parts"))
    m = c.select((F.col("conv_id") * BATCH_STRIDE + (F.col("turn") / 2).cast("long")).alias("batch_id"),
                 "turn", msg.alias("msg"))
    b = mg.append_batches(m, ["batch_id"], "turn")
    conv = c.select("conv_id").distinct().where(F.col("conv_id") % 5 == 0)
    cid = F.col("conv_id")
    tts = mg.iso_timestamp(F.timestamp_seconds(F.lit(EPOCH_2024) + cid * 3600 + 3000))
    ua, ub, sid = _url(cid, "a"), _url(cid, "b"), cid.cast("string")
    tools = conv.select((cid * BATCH_STRIDE + TOOL_BATCH).alias("batch_id"),
                        F.format_string(TOOL_TEMPLATE, tts, sid, ua, ub, tts, ua, sid, sid, ub, sid, sid, ua)
                        .alias("message_list"))
    return b.unionByName(tools)


SQL_BATCHES = f"""
(WITH c AS (SELECT conv_id, turn, role, text, EPOCH + conv_id * 3600 + turn AS sec FROM conversations,
            (SELECT {EPOCH_2024} AS EPOCH)),
m AS (SELECT conv_id * {BATCH_STRIDE} + turn // 2 AS batch_id, turn,
        {{'kind': CASE WHEN role = 'assistant' THEN 'response' ELSE 'request' END,
          'timestamp': strftime(make_timestamp(sec * 1000000), {ISO_SQL}),
          'parts': [{{'part_kind': CASE role WHEN 'user' THEN 'user-prompt' WHEN 'system' THEN 'system-prompt'
                                             ELSE 'text' END,
                      'content': text,
                      'timestamp': CASE WHEN role = 'assistant' THEN NULL
                                        ELSE strftime(make_timestamp(sec * 1000000 + 500000), {ISO_SQL}) END}}]}} AS msg
      FROM c)
SELECT batch_id, to_json(list(msg ORDER BY turn))::VARCHAR AS message_list FROM m GROUP BY batch_id
UNION ALL
SELECT conv_id * {BATCH_STRIDE} + {TOOL_BATCH},
       printf('{TOOL_TEMPLATE}', ts, conv_id::VARCHAR, ua, ub, ts, ua, conv_id::VARCHAR, conv_id::VARCHAR, ub,
              conv_id::VARCHAR, conv_id::VARCHAR, ua)
FROM (SELECT conv_id, strftime(make_timestamp(({EPOCH_2024} + conv_id * 3600 + 3000) * 1000000), {ISO_SQL}) AS ts,
             'https://conv.example/' || conv_id || '/a' AS ua, 'https://conv.example/' || conv_id || '/b' AS ub
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 5 = 0)))"""

SQL_MSGS = f"""
(SELECT batch_id, unnest(range(len(arr))) AS pos, unnest(arr) AS m
 FROM (SELECT batch_id, json_extract(message_list, '$[*]') AS arr FROM {SQL_BATCHES}))"""
SQL_PARTS = f"""
(SELECT batch_id, pos, unnest(range(len(ps))) AS part_pos, unnest(ps) AS p
 FROM (SELECT batch_id, pos, json_extract(m, '$.parts[*]') AS ps FROM {SQL_MSGS}))"""


@register("message_log", f"""
SELECT batch_id, pos, json_extract_string(m, '$.kind') AS kind, json_extract_string(m, '$.timestamp') AS timestamp,
       json_array_length(m, '$.parts') AS n_parts, json_extract_string(m, '$.parts[0].part_kind') AS first_part_kind
FROM {SQL_MSGS}""")
def q_message_log(spark, sf):
    path = scratch_dir(spark, f"messages_{uuid.uuid4().hex}")
    batches = message_batches(spark, sf)
    mg.append_message_log(batches.where("batch_id % 2 = 0"), path)
    mg.append_message_log(batches.where("batch_id % 2 = 1"), path)
    m = mg.message_log(mg.read_message_log(spark, path))
    return m.select("batch_id", "pos", "kind", "timestamp", F.size("parts").cast("long").alias("n_parts"),
                    F.try_element_at("parts", F.lit(1))["part_kind"].alias("first_part_kind"))


SQL_CHAT = f"""
(SELECT batch_id, pos,
        CASE WHEN is_user THEN 'user' WHEN is_model THEN 'model' END AS role,
        CASE WHEN is_user THEN json_extract_string(m, '$.parts[0].timestamp')
             WHEN is_model THEN json_extract_string(m, '$.timestamp') END AS timestamp,
        CASE WHEN is_user OR is_model THEN json_extract_string(m, '$.parts[0].content') END AS content,
        CASE WHEN is_user OR is_model THEN NULL ELSE '{mg.UNEXPECTED}' END AS reject_reason
 FROM (SELECT *, coalesce(json_extract_string(m, '$.kind') = 'request'
                          AND json_extract_string(m, '$.parts[0].part_kind') = 'user-prompt', false) AS is_user,
                 coalesce(json_extract_string(m, '$.kind') = 'response'
                          AND json_extract_string(m, '$.parts[0].part_kind') = 'text', false) AS is_model
       FROM {SQL_MSGS}))"""


@register("chat_messages", f"SELECT * FROM {SQL_CHAT}")
def q_chat_messages(spark, sf):
    return mg.chat_messages(mg.message_log(message_batches(spark, sf)))


@register("ndjson_export", f"""
SELECT batch_id, row_number() OVER (PARTITION BY batch_id ORDER BY pos) - 1 AS line_no,
       json_object('role', role, 'timestamp', timestamp, 'content', content)::VARCHAR AS line
FROM {SQL_CHAT} WHERE reject_reason IS NULL""")
def q_ndjson_export(spark, sf):
    """A file per batch, written and read back."""
    folder = scratch_dir(spark, f"ndjson_{uuid.uuid4().hex}")
    mg.write_ndjson(mg.ndjson_lines(mg.chat_messages(mg.message_log(message_batches(spark, sf)))), folder)
    return mg.read_ndjson(spark, folder).select(F.col("name").cast("long").alias("batch_id"), "line_no", "line")


@register("fetched_pages_filter", f"""
SELECT batch_id, pos, part_pos, item_pos, json_extract_string(it, '$.url') AS url,
       json_extract_string(it, '$.content') AS content
FROM (SELECT batch_id, pos, part_pos, unnest(range(len(items))) AS item_pos, unnest(items) AS it
      FROM (SELECT batch_id, pos, part_pos, json_extract(p, '$.content[*]') AS items FROM {SQL_PARTS}
            WHERE json_extract_string(p, '$.part_kind') = 'tool-return'
              AND json_extract_string(p, '$.tool_name') = 'web_fetch'
              AND json_type(p, '$.content') = 'ARRAY'))
WHERE coalesce(json_type(it, '$.url') = 'VARCHAR', false) AND coalesce(json_type(it, '$.content') = 'VARCHAR', false)""")
def q_fetched_pages_filter(spark, sf):
    return mg.fetched_pages(mg.message_log(message_batches(spark, sf), variant=True))


SQL_LINES = f"""
(SELECT batch_id, pos, part_pos,
   CASE WHEN kind = 'text' AND json_type(p, '$.content') = 'VARCHAR' THEN json_extract_string(p, '$.content')
        WHEN kind = 'tool-call' THEN '[tool_call:' || coalesce(json_extract_string(p, '$.tool_name'), '') || '] args=' ||
             CASE WHEN json_type(p, '$.args') IS NULL OR json_type(p, '$.args') = 'NULL' THEN '{{}}'
                  ELSE json_extract(p, '$.args')::VARCHAR END
        WHEN kind = 'tool-return' THEN '[tool_result:' || coalesce(json_extract_string(p, '$.tool_name'), '') || '] ' ||
             CASE WHEN json_type(p, '$.content') IN ('OBJECT', 'ARRAY') THEN json_extract(p, '$.content')::VARCHAR
                  WHEN json_type(p, '$.content') IS NULL OR json_type(p, '$.content') = 'NULL' THEN 'None'
                  ELSE json_extract_string(p, '$.content') END
   END AS line
 FROM (SELECT *, json_extract_string(p, '$.part_kind') AS kind FROM {SQL_PARTS}))"""


@register("messages_to_text", f"""
SELECT batch_id // {BATCH_STRIDE} AS conv_id, string_agg(line, chr(10) ORDER BY batch_id, pos, part_pos) AS text
FROM {SQL_LINES} WHERE line IS NOT NULL GROUP BY 1""")
def q_messages_to_text(spark, sf):
    lines = mg.message_lines(message_batches(spark, sf), include_tools=True)
    return mg.messages_to_text(lines, F.floor(F.col("batch_id") / BATCH_STRIDE).cast("long"))


@register("usage_rollup", """
SELECT 'm' || (conv_id % 3) AS model, count(*) AS runs, sum(req)::BIGINT AS request_tokens,
       sum(resp)::BIGINT AS response_tokens
FROM (SELECT conv_id, sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END) AS req,
             sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS resp
      FROM conversations GROUP BY conv_id) GROUP BY 1""")
def q_usage_rollup(spark, sf):
    c = table(spark, sf, "conversations")
    per_run = c.groupBy("conv_id").agg(
        F.sum(F.when(F.col("role") == "user", F.length("text")).otherwise(0)).alias("request_tokens"),
        F.sum(F.when(F.col("role") == "assistant", F.length("text")).otherwise(0)).alias("response_tokens"))
    per_run = per_run.withColumn("model", F.concat(F.lit("m"), (F.col("conv_id") % 3).cast("string")))
    return mg.usage_rollup(per_run, "model")


def run_tree(spark, sf):
    """Every turn is a run: turn t of a conversation was started by turn (t - 1) div 2, and a conversation's
    first turn by the first of conversation (conv_id - 1) div 3."""
    c = table(spark, sf, "conversations")
    name = lambda conv, turn: F.concat(conv.cast("string"), F.lit(":"), turn.cast("string"))
    conv, turn = F.col("conv_id"), F.col("turn")
    up = F.when(turn > 0, name(conv, F.floor((turn - 1) / 2).cast("long"))).when(
        conv > 0, name(F.floor((conv - 1) / 3).cast("long"), F.lit(0)))
    tokens = lambda role: F.when(F.col("role") == role, F.length("text")).otherwise(0)
    return c.select(name(conv, turn).alias("run_id"), up.alias("parent"),
                    F.concat(F.lit("m"), ((conv + turn) % 3).cast("string")).alias("model"),
                    tokens("user").alias("request_tokens"), tokens("assistant").alias("response_tokens"))


@register("usage_by_run", """
WITH RECURSIVE r AS (
  SELECT conv_id || ':' || turn AS run_id, 'm' || ((conv_id + turn) % 3) AS model,
         CASE WHEN turn > 0 THEN conv_id || ':' || ((turn - 1) // 2)
              WHEN conv_id > 0 THEN ((conv_id - 1) // 3) || ':0' END AS parent,
         CASE WHEN role = 'user' THEN length(text) ELSE 0 END AS req,
         CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END AS resp FROM conversations),
up AS (
  SELECT run_id AS run, run_id AS at FROM r
  UNION ALL SELECT up.run, p.run_id FROM up JOIN r ON r.run_id = up.at JOIN r p ON p.run_id = r.parent)
SELECT up.at AS run_id, r.model, count(*) AS runs, sum(req)::BIGINT AS request_tokens, sum(resp)::BIGINT AS response_tokens
FROM up JOIN r ON r.run_id = up.run GROUP BY 1, 2""")
def q_usage_by_run(spark, sf):
    return mg.usage_by_run(run_tree(spark, sf))


def assistant_pieces(spark, sf):
    c = table(spark, sf, "conversations").where(F.col("role") == "assistant")
    return mg.pieces(c, "text", PIECE, ["conv_id", "turn"])


SQL_PIECES = f"""
(SELECT conv_id, turn, unnest(range(len(ps))) AS seq, unnest(ps) AS delta
 FROM (SELECT conv_id, turn, list_transform(range(0, length(text), {PIECE}), lambda i: substr(text, i + 1, {PIECE})) AS ps
       FROM conversations WHERE role = 'assistant'))"""


@register("running_text", f"""
SELECT conv_id, turn, seq, delta, length(so_far) AS so_far_chars, md5(so_far) AS so_far_md5
FROM (SELECT *, string_agg(delta, '' ORDER BY seq) OVER (PARTITION BY conv_id, turn ORDER BY seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM {SQL_PIECES})""")
def q_running_text(spark, sf):
    r = mg.running_text(assistant_pieces(spark, sf), ["conv_id", "turn"])
    return r.select("conv_id", "turn", "seq", "delta", F.length("text_so_far").cast("long").alias("so_far_chars"),
                    F.md5("text_so_far").alias("so_far_md5"))
