"""Abbreviations learned from a corpus without labels, and sentences that do not end at them.

A full stop belongs to an abbreviation if it follows the word nearly always.  For every word of the corpus
(lower case, as it stands before white space) the number of times with and without a full stop is counted,
and Dunning's log-likelihood ratio weighs two guesses: the stop follows with the share that stops have
after words at large, or it follows with ``CERTAIN``.  The ratio is scaled by the word's length (long words
are seldom abbreviations), by the stops inside it, and by how often it stands without one.  Words that
score ``SCORE`` or more are abbreviations.

Only sums over the whole corpus enter, so counts are two narrow aggregates with a map-side partial step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import explode_rows
from ..session import scratch_dir

# fixed values: the published constants of the statistic
CERTAIN, SCORE = 0.99, 0.3
WORD = r"^[\p{L}]+(\.[\p{L}]+)*\.?$"


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n, n_stop``: how often each word occurs, and how often with a full stop right after it.
    Words are runs without white space that hold letters and inner stops only; the last run of a text is
    left out, as nothing follows it."""
    runs = F.array_remove(F.split(F.lower(F.col(text_col)), r"\s+", -1), "")
    runs = F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0)))
    words = explode_rows(docs, [], runs, "run").where(F.col("run").rlike(WORD))
    stop = F.col("run").endswith(".")
    return (words.select(F.when(stop, F.expr("left(run, length(run) - 1)")).otherwise(F.col("run")).alias("word"), stop.alias("stop"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("stop"), 1)).alias("n_stop")))


def _log_likelihood(k, n, p):
    """ln(p^k (1 - p)^(n - k)), 0 ln 0 being 0."""
    part = lambda c, q: F.when(c == 0, F.lit(0.0)).otherwise(c * F.log(q))
    return part(k, p) + part(n - k, 1 - p)


def abbreviations(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n, n_stop, score, abbreviation`` of every word that stands before a stop somewhere."""
    spark = docs.sparkSession
    path = scratch_dir(spark, f"words_{uuid.uuid4().hex}")
    word_counts(docs, text_col).write.parquet(path)
    counts = spark.read.schema("word string, n long, n_stop long").parquet(path)
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_stop").alias("n_stop")).first()
    share = (total["n_stop"] or 0) / total["n"] if total["n"] else 0.0
    n, k = F.col("n").cast("double"), F.col("n_stop").cast("double")
    ratio = -2 * (_log_likelihood(k, n, F.lit(share)) - _log_likelihood(k, n, F.lit(CERTAIN)))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    inner = F.length("word") - letters + 1
    score = F.round(ratio * F.exp(-letters) * inner * F.pow(letters, k - n), 6)
    return (counts.where("n_stop > 0").select("word", "n", "n_stop", score.alias("score"))
            .withColumn("abbreviation", F.col("score") >= SCORE))


def _stopped(sentence):
    """The lower-case word before a sentence's last full stop (null: it ends otherwise)."""
    word = F.element_at(F.split(F.lower(sentence), r"\s+", -1), -1)
    return F.when(F.endswith(sentence, F.lit(".")), F.substring(word, F.lit(1), F.length(word) - 1))


def learned_splitter(known: DataFrame):
    """A ``splitter`` for ``sections.split_sentences``: the built-in rule, but a sentence that ends in one of
    the abbreviations ``known(word)`` goes on with the next one.

    Only the distinct stopped words of a text are looked up, so no text is shuffled unless it holds one."""
    def split(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_dir(spark, f"sentences_{uuid.uuid4().hex}")
        numbered = df.withColumns({"__id": F.monotonically_increasing_id(), "__s": tx.sentences(F.col(text_col))})
        numbered.write.parquet(path)  # the numbers must be the same in both uses
        s = spark.read.schema(numbered.schema).parquet(path)
        words = s.select("__id", F.array_distinct(F.transform("__s", _stopped)).alias("w"))
        held = (explode_rows(words, ["__id"], "w", "word").join(known.select("word").distinct(), "word")
                .groupBy("__id").agg(F.collect_set("word").alias("__known")))
        # a mark after each real end, a blank after an abbreviation, then cut at the marks
        ends = lambda x: F.coalesce(F.array_contains("__known", _stopped(x)), F.lit(False))
        marked = F.array_join(F.transform("__s", lambda x: F.concat(x, F.when(ends(x), " ").otherwise(tx.SENTENCE_MARK))), "")
        cut = F.array_remove(F.transform(F.split(marked, tx.SENTENCE_MARK, -1), tx.strip_ws), "")
        return (s.join(held, "__id", "left")
                .withColumn(out_col, F.when(F.col("__known").isNull(), F.col("__s")).otherwise(cut)).drop("__id", "__s", "__known"))
    return split
