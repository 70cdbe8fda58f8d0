"""Message log operators: JSON message batches -> ordered messages, chat lines,
text views, fetched-page extraction, usage roll-ups and running text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import posexplode_rows
from ..session import scratch_dir
from ..sinks.named_files import read_named_files, write_named_files

PART_FIELDS = "part_kind:string, content:{c}, tool_name:string, args:{a}, timestamp:string"
MESSAGE_SCHEMA = f"array<struct<kind:string, timestamp:string, parts:array<struct<{PART_FIELDS.format(c='string', a='string')}>>>>"
MESSAGE_SCHEMA_VARIANT = (f"array<struct<kind:string, timestamp:string, "
                          f"parts:array<struct<{PART_FIELDS.format(c='variant', a='variant')}>>>>")
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
UNEXPECTED = "unexpected message type for chat"


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a +00:00 offset (session time zone UTC)."""
    return F.date_format(ts, ISO_FORMAT)


def message_log(batches: DataFrame, variant: bool = False) -> DataFrame:
    """(batch_id, message_list JSON) -> one row per message: (batch_id, pos, kind, timestamp, parts).

    Order is (batch_id, pos): batch ids are assigned on append, so the log reads back in
    insertion order.  ``variant=True`` keeps ``content``/``args`` as VARIANT for type tests."""
    schema = MESSAGE_SCHEMA_VARIANT if variant else MESSAGE_SCHEMA
    m = posexplode_rows(batches, ["batch_id"], F.from_json("message_list", schema), "pos", "m")
    return m.select("batch_id", F.col("pos").cast("long"), "m.kind", "m.timestamp", "m.parts")


def append_batches(messages: DataFrame, batch_cols: list[str], order_col: str) -> DataFrame:
    """Messages (one struct column ``msg``) -> one JSON array text per batch, in order."""
    g = messages.groupBy(*batch_cols).agg(F.array_sort(F.collect_list(F.struct(order_col, "msg"))).alias("ms"))
    return g.select(*batch_cols, F.to_json(F.transform("ms", lambda x: x["msg"])).alias("message_list"))


def append_message_log(batches: DataFrame, path: str) -> None:
    """Append (batch_id, message_list) rows to the log table; batch ids are assigned by the
    writer and define the read-back order."""
    batches.select("batch_id", "message_list").write.mode("append").parquet(path)


def read_message_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch_id long, message_list string").parquet(path)


def chat_messages(messages: DataFrame) -> DataFrame:
    """Dispatch on message kind and first part: request + user-prompt -> role ``user`` with the
    part's timestamp; response + text -> role ``model`` with the message timestamp; anything else
    gets ``reject_reason`` (the reference raises)."""
    first = F.try_element_at("parts", F.lit(1))
    # a null test (no first part, no kind) is not met
    is_user = (F.col("kind") == "request") & (first["part_kind"] == "user-prompt")
    is_model = (F.col("kind") == "response") & (first["part_kind"] == "text")
    return messages.select(
        "batch_id", "pos",
        F.when(is_user, "user").when(is_model, "model").alias("role"),
        F.when(is_user, first["timestamp"]).when(is_model, F.col("timestamp")).alias("timestamp"),
        F.when(is_user | is_model, first["content"]).alias("content"),
        F.when(~F.coalesce(is_user | is_model, F.lit(False)), F.lit(UNEXPECTED)).alias("reject_reason"))


def ndjson_lines(chat: DataFrame) -> DataFrame:
    """Accepted chat messages -> one compact JSON object per line (role, timestamp, content)."""
    ok = chat.where(F.col("reject_reason").isNull())
    return ok.select("batch_id", "pos", F.to_json(F.struct("role", "timestamp", "content")).alias("line"))


def write_ndjson(lines: DataFrame, folder: str, key: str = "batch_id") -> None:
    """One file ``<key>.ndjson`` per key in ``folder``: its lines in order, each ended by a line feed."""
    per = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("ls"))
    text = F.array_join(F.transform("ls", lambda x: F.concat(x["line"], F.lit("\n"))), "")
    write_named_files(per.select(F.concat(F.col(key).cast("string"), F.lit(".ndjson")).alias("name"), text.alias("text")),
                      folder)


def read_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    """``name, line_no, line`` of the files that ``write_ndjson`` wrote (line_no from 0)."""
    named = read_named_files(spark, folder, "*.ndjson").select(
        F.regexp_extract("name", r"^(.*)\.ndjson$", 1).alias("name"),
        F.split(F.regexp_replace("text", r"\n\z", ""), "\n", -1).alias("lines"))
    return posexplode_rows(named, ["name"], "lines", "line_no", "line").withColumn("line_no", F.col("line_no").cast("long"))


def parts_of(messages: DataFrame) -> DataFrame:
    return posexplode_rows(messages, ["batch_id", "pos"], "parts", "part_pos", "p") \
        .withColumn("part_pos", F.col("part_pos").cast("long"))


def _is_json_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def fetched_pages(messages_v: DataFrame, tool: str = "web_fetch") -> DataFrame:
    """From VARIANT-typed messages keep the items of ``tool`` returns whose url and content are
    both JSON strings: (batch_id, pos, part_pos, item_pos, url, content).  Non-list contents
    and non-object items give nothing."""
    p = parts_of(messages_v).where((F.col("p.part_kind") == "tool-return") & (F.col("p.tool_name") == tool))
    p = p.where(F.schema_of_variant("p.content").startswith("ARRAY"))
    items = posexplode_rows(p, ["batch_id", "pos", "part_pos"], F.variant_get("p.content", "$", "array<variant>"),
                            "item_pos", "it")
    url = F.try_variant_get("it", "$.url", "variant")
    body = F.try_variant_get("it", "$.content", "variant")
    ok = items.where(_is_json_string(url) & _is_json_string(body))
    return ok.select("batch_id", "pos", "part_pos", F.col("item_pos").cast("long"),
                     F.variant_get(url, "$", "string").alias("url"), F.variant_get(body, "$", "string").alias("content"))


def message_lines(batches: DataFrame, include_tools: bool = True) -> DataFrame:
    """One text line per renderable part of a (batch_id, message_list) log: text parts give
    their content; with ``include_tools`` tool calls give ``[tool_call:{name}] args={json}``
    (null args -> ``{}``, string args stay a JSON string) and tool returns
    ``[tool_result:{name}] {json or text}``.  Other parts give nothing.

    The log is parsed twice in one projection (string view keeps the original JSON text,
    VARIANT view tells the JSON types) and the two are zipped positionally: no join."""
    ms = F.from_json("message_list", MESSAGE_SCHEMA)
    mv = F.from_json("message_list", MESSAGE_SCHEMA_VARIANT)
    m = posexplode_rows(batches, ["batch_id"], F.arrays_zip(ms.alias("s"), mv.alias("v")), "pos", "m")
    p = posexplode_rows(m, ["batch_id", F.col("pos").cast("long").alias("pos")],
                        F.arrays_zip(F.col("m.s.parts").alias("s"), F.col("m.v.parts").alias("v")), "part_pos", "p")
    kind, name = F.col("p.s.part_kind"), F.coalesce(F.col("p.s.tool_name"), F.lit(""))
    va, vc = F.col("p.v.args"), F.col("p.v.content")
    args_txt = (F.when(va.isNull() | (F.schema_of_variant(va) == "VOID"), F.lit("{}"))
                 .when(_is_json_string(va), F.to_json(va))
                 .otherwise(F.col("p.s.args")))
    line = F.when((kind == "text") & _is_json_string(vc), F.col("p.s.content"))
    if include_tools:
        line = (line.when(kind == "tool-call", F.concat(F.lit("[tool_call:"), name, F.lit("] args="), args_txt))
                    .when(kind == "tool-return", F.concat(F.lit("[tool_result:"), name, F.lit("] "),
                                                          F.coalesce(F.col("p.s.content"), F.lit("None")))))
    return (p.select("batch_id", "pos", F.col("part_pos").cast("long"), line.alias("line"))
             .where(F.col("line").isNotNull()))


def messages_to_text(lines: DataFrame, group: Column, group_name: str = "conv_id") -> DataFrame:
    """Join lines per conversation in (batch_id, pos, part_pos) order with newlines."""
    g = lines.groupBy(group.alias(group_name)).agg(
        F.array_sort(F.collect_list(F.struct("batch_id", "pos", "part_pos", "line"))).alias("ls"))
    return g.select(group_name, F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("text"))


def usage_rollup(usage: DataFrame, by: str = "model") -> DataFrame:
    """Per run (or model): number of runs and summed request/response tokens."""
    return usage.groupBy(by).agg(F.count("*").alias("runs"),
                                 F.sum("request_tokens").cast("long").alias("request_tokens"),
                                 F.sum("response_tokens").cast("long").alias("response_tokens"))


def pieces(df: DataFrame, text_col: str, size: int, keep: list[str], prefix_col: str | None = None) -> DataFrame:
    """Cut a text into consecutive ``size``-character pieces: (keep..., seq, delta[, prefix]).

    With ``prefix_col`` each row also carries the text up to and including its piece (what a
    cumulative stream shows at that step), computed from the same row: no join back."""
    n = F.length(text_col)
    idx = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    out = [*keep, F.col("seq").cast("long"),
           F.substring(F.col(text_col), F.col("i") * size + 1, F.lit(size)).alias("delta")]
    if prefix_col:
        out.append(F.substring(F.col(text_col), F.lit(1), (F.col("i") + 1) * size).alias(prefix_col))
    return posexplode_rows(df, [*keep, text_col], idx, "seq", "i").select(*out)


def running_text(chunks: DataFrame, key_cols: list[str], seq_col: str = "seq", delta_col: str = "delta") -> DataFrame:
    """Cumulative text per message: the concatenation of all deltas up to and including ``seq``.

    A message's text is joined once; each row takes its prefix, whose length is a running sum."""
    rest = [c for c in chunks.columns if c not in (*key_cols, seq_col, delta_col)]
    parts = F.array_sort(F.collect_list(F.struct(seq_col, delta_col, *rest)))
    whole = (chunks.groupBy(*key_cols).agg(parts.alias("__parts"))
             .select(*key_cols, F.array_join(F.col(f"__parts.{delta_col}"), "").alias("__text"), F.inline("__parts")))
    w = Window.partitionBy(*key_cols).orderBy(seq_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum(F.coalesce(F.length(delta_col), F.lit(0))).over(w).cast("int")
    return whole.withColumn("text_so_far", F.substring("__text", F.lit(1), upto)).select(*chunks.columns, "text_so_far")


def usage_by_run(runs: DataFrame, by: str = "model") -> DataFrame:
    """Usage of every run with its sub-runs: ``run_id, <by>, runs, request_tokens, response_tokens``.

    ``runs`` has one row per run: ``run_id, parent, <by>, request_tokens, response_tokens``; a run whose
    parent is null or unknown is a root.  Pointer jumping: after round k each run knows its 2^k-th ancestor
    and the sums of its descendants less than 2^k below it, so a tree takes as many rounds as the logarithm
    of its depth.  Sums are grouped before they are joined, so a run with very many sub-runs costs no more
    than others.  Parents in a circle raise an error."""
    base = scratch_dir(runs.sparkSession, f"usage_{uuid.uuid4().hex}")

    def kept(df, name):
        df.write.parquet(f"{base}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")
    one = F.lit(1).cast("long")
    rows = kept(runs.select("run_id", "parent", by, one.alias("runs"), F.col("request_tokens").cast("long").alias("request_tokens"),
                            F.col("response_tokens").cast("long").alias("response_tokens")), "runs")
    sums = rows.drop("parent")
    known = rows.select(F.col("run_id").alias("up"))
    up = kept(rows.select("run_id", F.col("parent").alias("up")).where("up IS NOT NULL").join(known, "up", "left_semi"), "up0")
    limit, k = rows.count().bit_length() + 1, 0
    while not up.isEmpty():
        k += 1
        if k > limit:
            raise ValueError("runs are each other's parents")
        further = sums.join(up, "run_id").groupBy(F.col("up").alias("run_id"), by).agg(
            *[F.sum(c).alias(c) for c in ("runs", "request_tokens", "response_tokens")])
        sums = kept(sums.unionByName(further).groupBy("run_id", by).agg(
            *[F.sum(c).alias(c) for c in ("runs", "request_tokens", "response_tokens")]), f"sums{k}")
        up = kept(up.join(up.select(F.col("run_id").alias("up"), F.col("up").alias("top")), "up")
                  .select("run_id", F.col("top").alias("up")), f"up{k}")
    return sums
