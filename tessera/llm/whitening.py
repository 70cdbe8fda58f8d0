"""Whitening of embeddings with distributed block matrices.

Rows are numbered and their centred vectors dealt into the blocks of an MLlib ``BlockMatrix``.  The
transposed matrix times itself is the scatter, whose small result is decomposed on the driver; a
second multiplication, by the eigenvectors over the roots of their eigenvalues, projects all rows.
Both run block by block on the executors: the scatter's blocks are multiplied each in a partition of
its own and added up in pairs, and what reaches the driver is one square of the vectors' size and the
numbers of the blocks.  Rows per block grow with the table so that these stay few.

Entries are turned to whole numbers (``floor(scale * c) + shift``), whose sums are exact, and centred
before anything is multiplied; a large shift therefore costs no digits.

Vectors that are null or hold null or non-finite entries take no part, and neither do empty vectors
or vectors of another length than the most frequent one (ties: the shortest).  Entries beyond
+-2^52 / scale count as that bound.  Rows with equal or null ids each count.  Components without
variance (eigenvalue at most 1e-12 of the trace: repeated or too few rows) give null in ``whitened``,
and ``identity_error`` covers the others (null if there is none).  A deviation that no long can hold is null.
An empty table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .shared import stored

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
MIN_BLOCK, MAX_BLOCK, BLOCKS = 1024, 1 << 16, 4096
ROOT = 3_037_000_499  # of the largest long
FLAT = 1e-12  # share of the trace at which an eigenvalue counts as 0


def prepare(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x`` (array of long) of the rows that take part, except that lengths may still differ."""
    bound = 1 << 52
    kept = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    clip = lambda c: F.greatest(F.least(c * float(scale), F.lit(float(bound))), F.lit(-float(bound)))
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(clip(c)) + F.lit(shift)).alias("x"))


def numbered(rows: DataFrame, base: str) -> DataFrame:
    """The rows with ``row``: 0, 1, ... without gaps.  Each partition's number and the place in it are
    stored with the rows; the partitions' starts (one number each) are added on reading."""
    at = stored(rows.withColumn("__at", F.monotonically_increasing_id()), base)
    part = F.shiftright("__at", 33)
    sizes = sorted(at.groupBy(part.alias("part")).count().collect())
    start, starts = 0, []
    for p, n in sizes:
        starts.append((p, start))
        start += n
    first = rows.sparkSession.createDataFrame(starts, "part long, first long")
    return (at.withColumn("part", part).join(F.broadcast(first), "part")
            .withColumn("row", F.col("first") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "first", "__at"))


def block_matrix(rows: DataFrame, n: int, dim: int, per_block: int) -> BlockMatrix:
    """``row, v`` (array of double) as blocks of ``per_block`` rows."""
    ml = rows.select(F.col("row").alias("index"), array_to_vector("v").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(ml, "vector"), n, dim).toBlockMatrix(per_block, dim)


def array_rows(matrix: BlockMatrix) -> DataFrame:
    """``row, v`` of a block matrix, without leaving the JVM."""
    m = matrix.toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", m._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("v"))


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product; the blocks along the inner dimension are dealt over ``splits`` partitions."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def covariance(matrix: BlockMatrix, n: int) -> np.ndarray:
    """Transposed centred matrix times itself, over ``n``."""
    return _times(matrix.transpose(), matrix, matrix.numRowBlocks).toLocalMatrix().toArray() / n


def _per_block(n: int) -> int:
    return min(MAX_BLOCK, max(MIN_BLOCK, -(-n // BLOCKS)))


def whiten(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, n, deviation, whitened (array, by component), explained (array), identity_error`` per row."""
    base = scratch_dir(spark, "whitening")
    x = prepare(vectors, id_col, vector_col, scale, shift)
    sizes = x.groupBy(F.size("x").alias("dim")).count().collect()
    out = "vec_id {}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    kind = vectors.schema[id_col].dataType.simpleString()
    if not sizes:
        return spark.createDataFrame([], out.format(kind))
    dim, n = max(sizes, key=lambda r: (r[1], -r[0]))
    x = numbered(x.where(F.size("x") == dim), base)

    # exact sums and ranges of every dimension
    at = lambda f: [f(F.col("x")[i]) for i in range(dim)]
    got = x.agg(F.array(*at(lambda c: F.sum(c.cast("decimal(38,0)")))), F.array(*at(F.min)), F.array(*at(F.max))).first()
    sums = [int(s) for s in got[0]]
    widest = max(max(n * hi - s, s - n * lo) for s, lo, hi in zip(sums, got[1], got[2], strict=True))
    number = "long" if dim * widest * widest < 1 << 63 else "decimal(38,0)"
    total = F.array(*[F.lit(s).cast("decimal(38,0)").cast(number) for s in sums])
    mean = F.array(*[F.lit(float(s / n)) for s in sums])

    off = F.zip_with("x", total, lambda c, s: (F.lit(n).cast(number) * c.cast(number) - s).cast(number))
    deviation = F.aggregate(off, F.lit(0).cast(number), lambda acc, d: (acc + d * d).cast(number))
    if number != "long":  # a difference whose square is beyond a long makes the sum so
        deviation = F.when(~F.exists(off, lambda d: F.abs(d) > ROOT), deviation.try_cast("long"))
    centred = x.select("row", F.zip_with("x", mean, lambda c, m: c.cast("double") - m).alias("v"))

    per_block = _per_block(n)
    matrix = block_matrix(centred, n, dim, per_block).persist(StorageLevel.MEMORY_AND_DISK)
    values, vecs = np.linalg.eigh(covariance(matrix, n))
    order = np.argsort(-values, kind="stable")[:min(components, dim)]
    trace, values, vecs = float(values.sum()), values[order], vecs[:, order]
    sound = values > FLAT * trace
    weights = np.where(sound, vecs / np.sqrt(np.where(sound, values, 1)), 0)
    k = len(order)
    small = Matrices.dense(dim, k, weights.flatten(order="F").tolist())
    layer = BlockMatrix(spark.sparkContext.parallelize([((0, 0), small)], 1), dim, k)
    white = stored(array_rows(_times(matrix, layer, 1)), base)
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)

    error = None
    if sound.any():
        means = white.agg(*[F.avg(F.col("v")[i]) for i in range(k)]).first()
        again = white.select("row", F.zip_with("v", F.array(*[F.lit(m) for m in means]), lambda c, m: c - m).alias("v"))
        got = covariance(block_matrix(again, n, k, per_block), n)[np.ix_(sound, sound)]
        error = float(np.abs(got - np.eye(len(got))).max())
    shares = [float(e) / trace if trace > 0 else 0.0 for e in values]
    kept = F.array(*[F.col("v")[i] if ok else F.lit(None).cast("double") for i, ok in enumerate(sound)])
    return (x.select("row", "vec_id", deviation.alias("deviation")).join(white.select("row", kept.alias("whitened")), "row")
            .select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.array(*map(F.lit, shares)).alias("explained"), F.lit(error).cast("double").alias("identity_error")))
