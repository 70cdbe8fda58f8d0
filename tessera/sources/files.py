"""File sources: directory listing, whole-text documents, DocSection JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.named_files import read_named_files

DOC_SECTION_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("path", T.StringType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
])
DOC_SECTION_REQUIRED = ["id", "path", "level", "title", "content"]


def list_files(spark: SparkSession, parent: str, ext: str) -> DataFrame:
    """Files directly inside ``parent`` whose lower-cased suffix equals ``ext``.

    Uses the binaryFile source for the listing only (``content`` is never read:
    column pruning drops it).  Sub-directories are not entered."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(parent)
          .select("path", "length", "modificationTime"))
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return (df.where(suffix == ext.lower())
              .withColumn("name", F.regexp_extract("path", r"([^/]+)$", 1)))


def read_text_docs(spark: SparkSession, folder: str, glob: str = "*.md") -> DataFrame:
    """One row per matching file directly inside ``folder``: (path, name, text), the whole file as text.
    Spark's own file sources leave out empty files; this one does not."""
    r = read_named_files(spark, folder, glob)
    return r.select(F.concat(F.lit(folder.rstrip("/") + "/"), "name").alias("path"), "name", "text")


def _unique(folder: str) -> str:
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def write_json_lines(df: DataFrame, folder: str) -> str:
    out = _unique(folder)
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(out)
    return out


def read_doc_sections(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Strictly validated DocSection rows.

    FAILFAST rejects malformed JSON and type mismatches; it does not reject an
    absent key, so required fields are checked explicitly and the job fails on
    the first violation.  ``multi_line=True`` reads a file holding one JSON array."""
    df = (spark.read.schema(DOC_SECTION_SCHEMA).option("mode", "FAILFAST")
          .option("multiLine", multi_line).json(path))
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in DOC_SECTION_REQUIRED])
    # a filter: unlike a check inside a column, it runs whatever columns are read
    return df.where(F.when(missing == "", F.lit(True))
                    .otherwise(F.raise_error(F.concat(F.lit("DocSection missing: "), missing)).cast("boolean")))
