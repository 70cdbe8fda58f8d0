"""Exact top-k search by inner product with vector-approximation files.

``build`` cuts the vectors into blocks and writes, for each block, one byte per component (its cell
in a grid of 256 equal cells between the block's smallest and largest value of that component)
beside the exact integer vectors.  A query is answered in two passes over the blocks:

1. scan the cells only: each gives a lower and an upper bound of the score; a query's k-th largest
   lower bound over all blocks is a score that k candidates are sure to reach;
2. in every block, candidates whose upper bound reaches that score are read exactly, in the order
   of their bounds (the largest possible score, that is the smallest possible distance, first),
   until the k-th best exact score passes all bounds that are left.

Components are ``floor(scale * x)``, x as double; scores are exact integers, ties go to the smaller
id.  Queries are taken in batches of at most ``BATCH_BYTES``, which bounds what is broadcast; a
batch's broadcast is released when its answers are written.

Vectors that are null or empty, or hold a null or non-finite component, take no part, nor do rows
with a null id.  A query is compared with vectors of its own length.  Rows with the query's id are
not its candidates; each row that repeats a query id is answered by itself.  Scores beyond 64 bits
are held at the ends of that range.  Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import fresh_path, read_back

K, SCALE, BLOCK_ROWS, CELLS = 10, 1024, 8192, 256
BATCH_BYTES = 8 << 20
EXACT = float(1 << 53)

INDEX = "dim int, n int, ids binary, low binary, width binary, cells binary, exact binary"
PACKED = "dim int, ids binary, exact binary"
FOUND = "query_row long, query_id long, vec_id long, score long"
BOUNDS = "query_row long, bound double"


def _vectors(batch: pa.RecordBatch, scale: int):
    """{length: (ids, components as whole doubles)} of the rows that take part."""
    ids, vec = batch.column(0), batch.column(1)
    if not len(ids):
        return {}
    size = pc.fill_null(pc.list_value_length(vec), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    use = (size > 0) & pc.is_valid(ids).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(vec).cast(pa.float64())
    x = np.floor(pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False) * scale)
    first = np.cumsum(size) - size
    out = {}
    for d in np.unique(size[use]):
        at = np.flatnonzero(use & (size == d))
        v = x[first[at][:, None] + np.arange(d)]
        fine = np.isfinite(v).all(1)
        if fine.any():
            number = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            out[int(d)] = (number[at[fine]], v[fine])
    return out


def _packed(scale: int, max_rows: int, column):
    """A mapInArrow function: rows gathered by length, ``column(ids, v)`` for every ``max_rows``."""
    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for d, (ids, v) in _vectors(batch, scale).items():
                held.setdefault(d, []).append((ids, v))
                if sum(len(i) for i, _ in held[d]) >= max_rows:
                    ids, v = (np.concatenate(p) for p in zip(*held.pop(d), strict=True))
                    whole = len(ids) // max_rows * max_rows
                    for a in range(0, whole, max_rows):
                        yield column(d, ids[a:a + max_rows], v[a:a + max_rows])
                    if whole < len(ids):
                        held[d] = [(ids[whole:], v[whole:])]
        for d, parts in held.items():
            yield column(d, *(np.concatenate(p) for p in zip(*parts, strict=True)))
    return run


def _index_row(d, ids, v):
    low = v.min(0)
    width = np.maximum((v.max(0) - low) / CELLS, 1e-9)
    cells = np.minimum((v - low) / width, CELLS - 1).astype(np.uint8)
    # a cell's edges must hold for its values whatever the rounding was
    cells[(v < low + cells * width) & (cells > 0)] -= 1
    blob = pa.schema([("dim", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in
                                                              ("ids", "low", "width", "cells", "exact"))])
    return B.batch_of(blob, [d], [len(ids)], *([x.tobytes()] for x in (ids, low, width, cells, v)))


def _query_row(d, ids, v):
    return B.batch_of(pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("exact", pa.binary())]),
                      [d], [ids.tobytes()], [v.tobytes()])


def _two(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))


def build(vectors: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """Write the approximation file of ``vectors`` to ``path`` and return it."""
    (_two(vectors, id_col, vec_col).mapInArrow(_packed(scale, BLOCK_ROWS, _index_row), INDEX)
     .write.option("parquet.block.size", 32 << 20).parquet(path))
    return read_back(vectors.sparkSession, path, INDEX)


def _cell_bounds(row: dict, queries: np.ndarray):
    """(lower, upper) bounds of the scores of queries (rows) with a block's vectors (columns)."""
    d, n = row["dim"], row["n"]
    low, width = np.frombuffer(row["low"]), np.frombuffer(row["width"])
    cells = np.frombuffer(row["cells"], np.uint8).reshape(n, d)
    q = queries * width
    base = queries @ low
    mid = q @ cells.T.astype(np.float64) + base[:, None]
    # rounding of the sums: far below this share of the summed sizes
    size = np.abs(queries) @ (np.abs(low) + CELLS * width)
    slip = (size * 1e-12 + 1)[:, None]
    return mid + np.minimum(q, 0).sum(1)[:, None] - slip, mid + np.maximum(q, 0).sum(1)[:, None] + slip


def _scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``v`` with ``q``."""
    if np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * len(q) < EXACT:
        return (v @ q).astype(np.int64)
    lo, hi = -(1 << 63), (1 << 63) - 1
    w = [int(y) for y in q]
    return np.array([min(hi, max(lo, sum(int(x) * y for x, y in zip(r, w, strict=True)))) for r in v], np.int64)


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k largest values of each row."""
    return values if values.shape[1] <= k else np.partition(values, values.shape[1] - k, 1)[:, -k:]


class _Batch:
    """Queries of one length: their running numbers, ids and vectors."""

    def __init__(self, rows, ids, v):
        self.rows, self.ids, self.v = rows, ids, v

    def chunks(self, n: int):
        """Runs of queries for which a matrix against ``n`` vectors stays small."""
        step = max(1, (4 << 20) // max(n, 1))
        for a in range(0, len(self.ids), step):
            yield slice(a, a + step)


def _scan(sent, k: int):
    """Pass 1: per query the k largest lower bounds that the partition's blocks give."""
    schema = pa.schema([("query_row", pa.int64()), ("bound", pa.float64())])

    def run(batches):
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                b = sent.value.get(row["dim"])
                if b is None:
                    continue
                ids = np.frombuffer(row["ids"], np.int64)
                held = best.setdefault(row["dim"], np.full((len(b.ids), k), -np.inf))
                for s in b.chunks(len(ids)):
                    lower, _ = _cell_bounds(row, b.v[s])
                    lower[b.ids[s][:, None] == ids] = -np.inf
                    held[s] = _largest(np.concatenate([held[s], _largest(lower, k)], 1), k)
        for d, held in best.items():
            numbers = np.repeat(sent.value[d].rows, k)
            has = np.isfinite(held.ravel())
            yield B.batch_of(schema, numbers[has], held.ravel()[has])
    return run


def _read(sent, reach, k: int):
    """Pass 2: per query and partition the k best exact scores among candidates that can matter."""
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                        ("score", pa.int64())])
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def run(batches):
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                b = sent.value.get(row["dim"])
                if b is None:
                    continue
                ids = np.frombuffer(row["ids"], np.int64)
                exact = np.frombuffer(row["exact"]).reshape(len(ids), row["dim"])
                for s in b.chunks(len(ids)):
                    _, upper = _cell_bounds(row, b.v[s])
                    upper[b.ids[s][:, None] == ids] = -np.inf
                    floor = np.array([reach.value.get(int(r), -np.inf) for r in b.rows[s]])
                    may = (upper >= floor[:, None]) & (upper > -np.inf)
                    for i in np.flatnonzero(may.any(1)):
                        at = (row["dim"], s.start + int(i))
                        best[at] = _read_block(best.get(at, none), ids, exact, b.v[at[1]],
                                               upper[i], np.flatnonzero(may[i]), k)
        for (d, i), (score, ids) in best.items():
            b = sent.value[d]
            yield B.batch_of(schema, np.full(len(ids), b.rows[i]), np.full(len(ids), b.ids[i]), ids, score)
    return run


def _read_block(best, ids, exact, q, upper, which, k: int):
    """``best`` (scores, ids) after reading the candidates ``which`` in the order of their bounds."""
    order = which[np.argsort(-upper[which], kind="stable")]
    at, step = 0, 4 * k
    while at < len(order):
        if len(best[0]) == k and upper[order[at]] < best[0][-1]:
            break  # the k-th result is certain; an equal bound may still win by its id
        part = order[at:at + step]
        score = np.concatenate([best[0], _scores(exact[part], q)])
        number = np.concatenate([best[1], ids[part]])
        keep = np.lexsort((number, -score.astype(object) if score.min() == -(1 << 63) else -score))[:k]
        best = (score[keep], number[keep])
        at, step = at + step, step * 2
    return best


def _batches(queries: DataFrame, scale: int):
    """The queries in batches of at most about ``BATCH_BYTES``, each as {length: _Batch}."""
    held, size, number = {}, 0, 0
    for r in queries.mapInArrow(_packed(scale, 1024, _query_row), PACKED).toLocalIterator():
        ids = np.frombuffer(bytes(r["ids"]), np.int64)
        held.setdefault(r["dim"], []).append((np.arange(number, number + len(ids)), ids,
                                              np.frombuffer(bytes(r["exact"])).reshape(len(ids), r["dim"])))
        number, size = number + len(ids), size + len(r["exact"])
        if size >= BATCH_BYTES:
            yield {d: _Batch(*(np.concatenate(x) for x in zip(*p, strict=True))) for d, p in held.items()}
            held, size = {}, 0
    if held:
        yield {d: _Batch(*(np.concatenate(x) for x in zip(*p, strict=True))) for d, p in held.items()}


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of every query row over ``vectors``."""
    base = scratch_dir(spark, "vector_search")
    index = build(vectors, fresh_path(base), id_col, vec_col, scale)
    answers = fresh_path(base)
    spark.createDataFrame([], FOUND).write.parquet(answers)
    first = Window.partitionBy("query_row").orderBy(F.desc("bound"))
    for batch in _batches(_two(queries, id_col, vec_col), scale):
        sent = spark.sparkContext.broadcast(batch)
        bounds = (index.select("dim", "n", "ids", "low", "width", "cells").mapInArrow(_scan(sent, k), BOUNDS)
                  .withColumn("place", F.row_number().over(first)).where(F.col("place") == k)
                  .select("query_row", "bound").toArrow())  # one number for each query of the batch
        reach = spark.sparkContext.broadcast(dict(zip(bounds["query_row"].to_pylist(), bounds["bound"].to_pylist(),
                                                      strict=True)))
        index.mapInArrow(_read(sent, reach, k), FOUND).write.mode("append").parquet(answers)
        sent.unpersist()
        reach.unpersist()
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (read_back(spark, answers, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
