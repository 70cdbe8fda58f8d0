"""Small helpers of the operators: fresh shared folders, checked read-back, remainders of crc32."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fresh_path(base: str) -> str:
    """A new folder name under the shared folder; nothing is reused between runs."""
    return f"{base}/{uuid.uuid4().hex}"


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A written table with its declared schema (also right when it has no rows)."""
    return spark.read.schema(schema).parquet(path)


def stored(df: DataFrame, base: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a new folder and read it back."""
    path = fresh_path(base)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (upper and lower case are one)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold_of(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds`` (null id: null)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str)
                          else doc_id.cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``label, text`` of at most ``per_class`` labelled documents of each class (0 and 1): those
    with the smallest hash of their id, so the sample is the same on every run."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
           .where("label IN (0, 1) AND doc_id IS NOT NULL"))
    chosen = None
    for y in (0, 1):
        part = lab.where(F.col("label") == y).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # two rows per label and id at most take part, so the ids to look for are bounded by per_class
    return text.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("label", "text")
