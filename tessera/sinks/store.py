"""Keyed section store: insert-only loads by uri, search over what is stored.

A store is a folder of Parquet tables:

* ``sections`` ``(uri, title, content, embedding)`` with uri unique, partitioned by ``part``, a hash of
  the uri;
* ``filters`` ``(part, bucket, bits)``: blocked Bloom filters.  A uri's hash names one of the part's
  buckets and ``PROBES`` of its 32,768 bits; each load appends the bits of its uris, and a probe takes
  all rows of a bucket together;
* ``about``: the number of parts and of buckets per part, fixed when the store is made.

A load

1. writes the batch once, with part, bucket and bits of every uri;
2. finds, per uri, the first row by position (an aggregate of narrow rows with a map-side partial step);
3. probes the filters: a uri with a bit unset is new, without any look at the sections;
4. looks up the others in ``sections``, reading only the parts that hold one of them (partition filters);
5. appends the bits of all uris, then embeds and appends the new rows.  Bits come first: whatever is cut
   off in between, the filters never miss a stored uri, and a load that is run again appends what is
   missing and nothing else.

The filters only save reading.  A store that outgrows them reads more parts and stays exact.  Changed
content under an existing uri is ignored (insert-only).  Rows with a null uri are not loaded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..operators.vector_index import PivotIndex
from ..session import scratch_dir

SECTION_COLS = ["uri", "title", "content"]
SECTIONS = "uri string, title string, content string, embedding array<double>"
FILTERS = "bucket int, bits binary, part int"
PARTS, EXPECTED = 32, 1_000_000
BUCKET_BITS, BITS_PER_KEY, PROBES = 1 << 15, 10, 4


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so it is computed once."""
    path = f"{scratch_dir(df.sparkSession, 'load')}/{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class SectionStore:
    """See the module."""

    def __init__(self, spark: SparkSession, path: str, parts: int, buckets: int, dim: int):
        self.spark, self.path, self.parts, self.buckets, self.dim = spark, path.rstrip("/"), parts, buckets, dim

    @classmethod
    def create(cls, spark: SparkSession, path: str, parts: int = PARTS, expected: int = EXPECTED,
               dim: int = vx.DEFAULT_DIM) -> SectionStore:
        """A new store for about ``expected`` sections; more are held as well."""
        buckets = max(1, -(-expected * BITS_PER_KEY // (parts * BUCKET_BITS)))
        about = spark.createDataFrame([(parts, buckets, dim)], "parts int, buckets int, dim int").coalesce(1)
        about.write.parquet(f"{path.rstrip('/')}/about")
        self = cls(spark, path, parts, buckets, dim)
        # empty tables: a missing folder is then always a damaged store
        spark.createDataFrame([], f"{SECTIONS}, part int").write.parquet(f"{self.path}/sections")
        spark.createDataFrame([], FILTERS).write.parquet(f"{self.path}/filters")
        return self

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SectionStore:
        about = spark.read.schema("parts int, buckets int, dim int").parquet(f"{path.rstrip('/')}/about").first()
        return cls(spark, path, about["parts"], about["buckets"], about["dim"])

    @classmethod
    def open_or_create(cls, spark: SparkSession, path: str, **options) -> SectionStore:
        from pyspark.errors import AnalysisException

        try:
            return cls.open(spark, path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return cls.create(spark, path, **options)

    def sections(self) -> DataFrame:
        return self.spark.read.schema(f"{SECTIONS}, part int").parquet(f"{self.path}/sections")

    # --- keys -------------------------------------------------------------------

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("uri"), F.lit(self.parts)).cast("int")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), "uri"), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _bits() -> Column:
        """The uri's bit positions in its bucket."""
        return F.array(*[F.pmod(F.xxhash64(F.lit(f"bit {i}"), "uri"), F.lit(BUCKET_BITS)).cast("int")
                         for i in range(PROBES)])

    def _filters(self) -> DataFrame:
        """Each bucket's bits, all loads together."""
        rows = self.spark.read.schema(FILTERS).parquet(f"{self.path}/filters")
        return rows.groupBy("part", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))

    def maybe_stored(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys(uri, ...)`` whose bits are all set: every stored uri, and few others."""
        k = keys.withColumns({"__part": self._part(), "__bucket": self._bucket()})
        f = self._filters().select(F.col("part").alias("__part"), F.col("bucket").alias("__bucket"),
                                   F.col("bits").alias("__bits"))
        byte = lambda p: F.ascii(F.decode(F.substring("__bits", (p / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
        is_set = F.forall(self._bits(), lambda p: F.getbit(byte(p), p % 8) == 1)
        return k.join(f, ["__part", "__bucket"]).where(is_set).drop("__part", "__bucket", "__bits")

    def stored(self, keys: DataFrame) -> DataFrame:
        """``uri`` of the rows of ``keys(uri)`` that are stored."""
        maybe = _kept(self.maybe_stored(keys.select("uri").distinct()).withColumn("part", self._part()), "maybe")
        parts = [r["part"] for r in maybe.select("part").distinct().collect()]  # at most ``parts`` rows
        return self.sections().where(F.col("part").isin(parts)).select("uri", "part").join(maybe, ["part", "uri"]) \
            .select("uri")

    # --- loads ------------------------------------------------------------------

    def plan(self, batch: DataFrame, pos_col: str = "pos") -> tuple[DataFrame, DataFrame]:
        """``(rows, report)``: the batch's new rows, and ``uri, copies, exists`` of every uri in it."""
        rows = _kept(batch.where("uri IS NOT NULL").withColumn("__row", F.monotonically_increasing_id()), "batch")
        keys = _kept(rows.groupBy("uri").agg(F.min(F.struct(F.col(pos_col), "__row"))["__row"].alias("__row"),
                                             F.count(F.lit(1)).alias("copies")), "keys")
        found = _kept(self.stored(keys), "found").withColumn("exists", F.lit(True))
        report = _kept(keys.join(found, "uri", "left").withColumn("exists", F.coalesce("exists", F.lit(False))), "report")
        first = report.where("NOT exists").select("__row")
        return rows.join(first, "__row", "left_semi").drop("__row"), report.drop("__row")

    def append(self, rows: DataFrame, text_col: str = "embedding_content", embedder=None) -> None:
        """Store rows whose uris are known to be new and distinct; embeds ``text_col``."""
        # dealt by part first: one file per part, whatever the number of tasks
        dealt = rows.withColumn("part", self._part()).repartition(self.parts, "part")
        e = vx.embed_text(dealt, text_col, "embedding", self.dim, embedder)
        e = vx.check_dim(e, "embedding", self.dim).select(*SECTION_COLS, "embedding", "part")
        e.write.mode("append").partitionBy("part").parquet(f"{self.path}/sections")

    def _note(self, uris: DataFrame) -> None:
        """Add the uris' bits to the filters."""
        at = uris.select(self._part().alias("part"), self._bucket().alias("bucket"), F.explode(self._bits()).alias("bit"))
        (at.groupBy("part", "bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).coalesce(1)
         .write.mode("append").partitionBy("part").parquet(f"{self.path}/filters"))

    def load(self, batch: DataFrame, text_col: str = "embedding_content", embedder=None, pos_col: str = "pos") -> DataFrame:
        """Append the new sections of ``batch``; returns ``uri, copies, exists`` as they were before."""
        rows, report = self.plan(batch, pos_col)
        self._note(report.select("uri"))
        self.append(rows, text_col, embedder)
        return report

    def load_collection(self, batch: DataFrame, text_col: str = "embedding_content", embedder=None,
                        pos_col: str = "pos") -> DataFrame:
        """Strict load: a uri that is repeated in the batch is rejected whole.  Appends the uris that are
        neither repeated nor stored; returns ``uri, copies, exists, action``."""
        rows, report = self.plan(batch, pos_col)
        report = report.withColumn("action", F.when(F.col("copies") > 1, "reject_duplicate")
                                   .when(F.col("exists"), "skip_existing").otherwise("insert"))
        taken = report.where("action = 'insert'").select("uri")
        self._note(taken)
        self.append(rows.join(taken, "uri", "left_semi"), text_col, embedder)
        return report

    # --- search -----------------------------------------------------------------

    def index(self, metric: str = "l2") -> PivotIndex:
        """A vector index, by uri, of the sections stored now, in the store's folder."""
        return PivotIndex.build(self.sections(), f"{self.path}/index_{uuid.uuid4().hex}", "uri", "embedding", metric)


def new_sections_only(batch: DataFrame, store: SectionStore) -> DataFrame:
    """Batch rows whose uri is not in the store (existence probe before insert)."""
    batch = _kept(batch, "batch")
    return batch.join(store.stored(batch), "uri", "left_anti")


def load_sections(spark: SparkSession, path: str, batch: DataFrame, text_col: str = "embedding_content",
                  dim: int = vx.DEFAULT_DIM, embedder=None, pos_col: str = "pos") -> DataFrame:
    """Load ``batch`` into the store at ``path``, made if there is none; returns ``uri, dropped`` of the uris
    that stand in the batch more than once.

    Re-running a load (or a replayed streaming micro-batch) appends nothing: every uri it would
    write is already stored."""
    store = SectionStore.open_or_create(spark, path, dim=dim)
    report = store.load(batch, text_col, embedder, pos_col)
    return report.where(F.col("copies") > 1).select("uri", (F.col("copies") - 1).alias("dropped"))
