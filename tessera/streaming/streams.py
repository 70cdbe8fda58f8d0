"""Structured Streaming forms of the message and store operators.

The upsert and window sinks aggregate inside each micro-batch and append to a keyed log, whose view
merges in any order (``keyed_log``), so no row is too late; lists that arrive in pieces are scanned with
keyed state (``partial``); the store sink is an anti-join insert.  All are idempotent: a micro-batch that
is replayed after an executor loss does not change the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import vectors as vx
from ..sinks import store as st
from .keyed_log import FOLD_AFTER, KeyedLog
from .partial import RESULT, scan_lists

CHAT_LINE_SCHEMA = S.CHAT_MESSAGE


def _run(writer, checkpoint: str, available_now: bool = True):
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


# --- last-wins message upsert ---------------------------------------------------

def message_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """NDJSON chat lines (conv_id, seq, line) -> (messages, rejects).  Lines of one character or less are
    skipped; a line that is no message, or whose timestamp is none, is rejected with its reason."""
    p = (lines.where(F.length("line") > 1)
              .select("conv_id", "seq", "line", F.from_json("line", CHAT_LINE_SCHEMA).alias("m")))
    reason = (F.when(F.col("m").isNull() | F.col("m.timestamp").isNull(), F.lit("no message"))
               .when(F.try_to_timestamp("m.timestamp").isNull(), F.lit("bad timestamp")))
    p = p.withColumn("reason", reason)
    return (p.where("reason IS NULL").select("conv_id", "m.timestamp", F.struct("seq", "m.role", "m.content").alias("last"),
                                             F.col("seq").alias("first_seq")),
            p.where("reason IS NOT NULL").select("conv_id", "seq", "line", "reason"))


def _by_message(rows: DataFrame, *key: str) -> DataFrame:
    """Rows dealt by message before they are grouped.  The growing texts of a message stand next to each other,
    which shrinks what is shuffled and written, and no task has to sort all that it read."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def merge_messages(rows: DataFrame) -> DataFrame:
    """Per message (keyed by its timestamp) the latest content and the first position seen."""
    return _by_message(rows, "conv_id", "timestamp").groupBy("conv_id", "timestamp").agg(F.max_by("last", F.col("last.seq")).alias("last"),
                                                    F.min("first_seq").alias("first_seq"))


def message_log(spark: SparkSession, path: str, fold_after: int = FOLD_AFTER) -> KeyedLog:
    return KeyedLog(spark, f"{path}/messages", merge_messages, fold_after)


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """``conv_id, seq, line, reason`` of the lines that made no message."""
    return spark.read.schema("conv_id long, seq long, line string, reason string, epoch long").parquet(f"{path}/rejects") \
        .drop("epoch")


def _source(spark: SparkSession, source: str, schema: str, max_files: int | None):
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(source)


def run_message_upsert(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str,
                       max_files: int | None = None, fold_after: int = FOLD_AFTER) -> DataFrame:
    log = message_log(spark, out, fold_after)

    def write(df: DataFrame, epoch: int):
        messages, rejects = message_lines(df)
        rejects.write.mode("overwrite").parquet(f"{out}/rejects/epoch={epoch}")
        log.append(messages, epoch)

    _run(_source(spark, source, schema, max_files).writeStream.foreachBatch(write), checkpoint)
    return log.read().select("conv_id", "timestamp", "last.role", "last.content", "first_seq")


# --- debounce -------------------------------------------------------------------

def windowed(chunks: DataFrame, interval: str = "10 milliseconds") -> DataFrame:
    """Chunks with their aligned ``interval`` window.  Windows are aligned to the epoch, not to the first
    arrival (documented deviation)."""
    return (chunks.withColumn("w", F.window("event_time", interval))
                  .select("conv_id", "turn", F.col("w.start").alias("window_start"),
                          F.struct("seq", "text_so_far").alias("last")))


def merge_windows(rows: DataFrame) -> DataFrame:
    """Per message and window the latest cumulative text (by seq)."""
    return _by_message(rows, "conv_id", "turn").groupBy("conv_id", "turn", "window_start").agg(F.max_by("last", F.col("last.seq")).alias("last"))


def run_debounce(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str,
                 interval: str = "10 milliseconds", max_files: int | None = None,
                 fold_after: int = FOLD_AFTER) -> DataFrame:
    log = KeyedLog(spark, out, merge_windows, fold_after)
    s = _source(spark, source, schema, max_files)
    _run(s.writeStream.foreachBatch(lambda df, epoch: log.append(windowed(df, interval), epoch)), checkpoint)
    return log.read().select("conv_id", "turn", "window_start", F.col("last.seq").alias("seq"),
                             F.col("last.text_so_far").alias("text"))


# --- partial list validation --------------------------------------------------------

def run_partial_records(spark: SparkSession, source: str, schema: str, base: str, checkpoint: str,
                        max_files: int | None = None) -> DataFrame:
    """Answers of ``partial.scan_lists`` over the files of ``source``; a replayed micro-batch writes its own
    rows anew."""
    def write(df: DataFrame, epoch: int):
        df.write.mode("overwrite").parquet(f"{base}/out/epoch={epoch}")

    found = scan_lists(_source(spark, source, schema, max_files))
    _run(found.writeStream.outputMode("append").foreachBatch(write), checkpoint)
    return spark.read.schema(f"{RESULT}, epoch long").parquet(f"{base}/out").drop("epoch")


# --- streaming section loads --------------------------------------------------------

def run_stream_load(spark: SparkSession, source: str, schema, store_path: str, checkpoint: str,
                    dim: int = vx.DEFAULT_DIM, max_files: int | None = None) -> DataFrame:
    """Sections arriving as files are loaded into the store by uri, insert-only; a replayed or
    repeated batch adds nothing (anti join against the store)."""
    s = _source(spark, source, schema, max_files)

    store = st.SectionStore.open_or_create(spark, store_path, dim=dim)

    def write(df: DataFrame, epoch: int):
        store.load(df)

    _run(s.writeStream.foreachBatch(write), checkpoint)
    return store.sections()
