"""Vector indexes for nearest-neighbour search, written once and asked many times.

Both indexes are Parquet tables of blocks, partitioned by ``cell``.  A block holds the ids and vectors
of at most one Arrow batch of rows of one cell.  Rows are dealt to blocks by ranges of (cell, distance,
hash of the id), so a cell that holds a third of all rows, or one vector repeated any number of times,
is spread over many blocks and tasks.

A search never gathers queries.  Each query's visits are one row: its vector and one bit per cell.  Queries
are dealt by a hash to shares, cells in their order to stripes of about as many rows each, and a task meets
one share with one stripe: it holds the share's queries and reads the stripe's blocks one after the other.
So a query is sent to at most one task per stripe and a block to one per share, and both numbers are fixed
as long as a share stays within ``HELD_BYTES``: what is shuffled grows with the vectors, not with vectors
times cells.  Only blocks of visited cells are read.  A task answers with the rows within the k-th distance
that it has seen for the query so far, at most k per query and block.

``PivotIndex`` is exact.  A cell holds the rows whose nearest pivot it is, and knows the smallest and
largest distance to the pivot.  Each query first visits its nearest cells until they hold k rows; the k-th
distance found bounds all others, and by the triangle inequality only cells and blocks whose interval of
distances comes that near are visited next.

``HyperplaneIndex`` is approximate.  A cell is the pattern of signs of a vector's products with planes
whose components are +1 or -1 by md5, on vectors in whole numbers, so the cell of a vector is the same
everywhere.  A query visits cells by rising cost (the sum of its distances to the planes it crosses).

Distances are computed twice: by one matrix product for the choice, then from the differences of the
chosen pairs, so large norms lose no digits.  Order is (distance rounded to 6 places, id); ids and query
ids may be of any type that Spark can sort.  Vectors that are null, empty or hold null or non-finite
components take no part; all others need one length.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

MAX_GROUP_BYTES, HELD_BYTES = 2 * 1024 * 1024, 64 * 1024 * 1024
SHARES, TASKS = 8, 64  # shares of queries and tasks of a search whose queries pass MAX_GROUP_BYTES
FAR = int(np.iinfo(np.int64).max >> 12)  # the bound, in steps, of a query that has none yet
CELL_ROWS, MAX_PIVOTS = 2048, 1024
PLANE_ROWS, MAX_PLANES, PLANE_SEED, UNIT = 64, 12, 7, float(1 << 20)
RECALL_QUERIES, SAMPLE_RECALL = 256, 0.95  # the sample's recall leaves room for its error above 0.9
STEP = 1e-6  # distances are rounded to this
_PAIRS = 4_000_000  # rows x queries of one matrix product


def usable(df: DataFrame, id_col: str, vec_col: str, metric: str) -> DataFrame:
    """``id, v`` of the vectors that take part."""
    out = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return out.where(F.exists("v", lambda x: x != 0)) if metric == "cosine" else out


def _matrix(lists: pa.ListArray) -> np.ndarray:
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n and len(flat) % n or (n and (np.diff(lists.offsets.to_numpy()) != len(flat) // n).any()):
        raise ValueError("vectors have different lengths")
    return flat.reshape(n, -1)


def _unit(x: np.ndarray, metric: str) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True) if metric == "cosine" else x


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``x`` to all rows of ``y``, for bounds only."""
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d2, 0))


def _ranked(x: np.ndarray, q: np.ndarray, k: int, metric: str, limit: np.ndarray, row: np.ndarray, query: np.ndarray):
    """Of the pairs ``(row, query)`` the k nearest of each query within ``limit``: (query, row, distance in steps)."""
    exact = np.empty(len(row))
    for s in range(0, len(row), 1 << 16):
        a, b = x[row[s:s + (1 << 16)]], q[query[s:s + (1 << 16)]]
        if metric == "cosine":
            exact[s:s + (1 << 16)] = 1.0 - (a * b).sum(1) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
        else:
            exact[s:s + (1 << 16)] = np.sqrt(((a - b) ** 2).sum(1))
    r = np.rint(exact / STEP).astype(np.int64)
    ok = r <= limit[query]
    row, query, r = row[ok], query[ok], r[ok]
    order = np.lexsort((row, r, query))
    row, query, r = row[order], query[order], r[order]
    near = np.arange(len(query)) - np.searchsorted(query, np.arange(len(q)))[query] < k
    return query[near], row[near], r[near]


def _chosen(x: np.ndarray, q: np.ndarray, k: int, metric: str, limit: np.ndarray):
    """(query, row, distance in steps) of the k nearest rows of ``x`` to each of ``q``, ties by row."""
    if metric == "cosine":
        d = 1.0 - (x @ q.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)[None, :])
        slack = np.full(d.shape, 1e-12)
    else:
        sx, sq = (x * x).sum(1)[:, None], (q * q).sum(1)[None, :]
        d2 = sx + sq - 2.0 * (x @ q.T)
        error = 64 * np.finfo(float).eps * (sx + sq)
        d = np.sqrt(np.maximum(d2, 0))
        slack = np.sqrt(np.maximum(d2, 0) + error) - np.sqrt(np.maximum(d2 - error, 0))
    # every row that may round into the k nearest
    high = d + slack
    top = np.partition(high, k - 1, axis=0)[k - 1] if len(x) > k else np.full(len(q), np.inf)
    row, query = np.nonzero(d - slack <= top + STEP)
    return _ranked(x, q, k, metric, limit, row, query)


def _within(x: np.ndarray, q: np.ndarray, k: int, metric: str, limit: np.ndarray):
    """What ``_chosen`` gives where every query has a limit: only rows that may be within it are looked at."""
    far = (limit + 1) * STEP
    if metric == "cosine":
        query, row = np.nonzero(_unit(q, metric) @ _unit(x, metric).T >= (1.0 - far - 1e-12)[:, None])
    else:
        sx, sq = (x * x).sum(1), (q * q).sum(1)
        part = (q * -2.0) @ x.T
        part += sx[None, :]
        error = 64 * np.finfo(float).eps * (sx.max() + sq + far * far)
        query, row = np.nonzero(part <= (far * far + error - sq)[:, None])
    return _ranked(x, q, k, metric, limit, row, query)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``cell, d, id, v`` in the order of cells -> one block per cell and batch, its rows by id."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column("cell").to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            rows = batch.slice(a, b - a)
            rows = rows.take(pc.sort_indices(rows.column("id")))
            d = rows.column("d").to_numpy(zero_copy_only=False)
            ids = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), rows.column("id"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([cell[a]], pa.int32()), pa.array([d.min()]), pa.array([d.max()]), ids,
                 pa.array([_matrix(rows.column("v")).tobytes()], pa.binary())], names=["cell", "low", "high", "ids", "v"])


def write_blocks(rows: DataFrame, path: str) -> None:
    """``cell, d, id, v`` rows as blocks, partitioned by cell."""
    kind = rows.schema["id"].dataType.simpleString()
    (rows.select("cell", "d", "id", "v").repartitionByRange("cell", "d", F.xxhash64("id")).sortWithinPartitions("cell", "d")
     .mapInArrow(_to_blocks, f"cell int, low double, high double, ids array<{kind}>, v binary")
     .write.partitionBy("cell").parquet(path))


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of an array as binary values."""
    flat = np.ascontiguousarray(rows)
    width = flat.dtype.itemsize * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(np.arange(len(flat) + 1, dtype=np.int32) * width),
                                                          pa.py_buffer(flat)])


def _unbinary(column: pa.Array, kind) -> np.ndarray:
    """Binary values of one length as rows of an array."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def spans(many: np.ndarray, stripes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last stripe of each cell when cells of ``many`` rows are laid along stripes of equal length."""
    upto, total = np.cumsum(many), max(1, int(many.sum()))
    return (upto - many) * stripes // total, np.maximum(upto - 1, 0) * stripes // total


def _in_stripes(many: np.ndarray, stripes: int) -> np.ndarray:
    """1 where a cell lies in a stripe."""
    first, last = spans(many, stripes)
    return ((np.arange(stripes) >= first[:, None]) & (np.arange(stripes) <= last[:, None])).astype(np.float32)


def _visit_rows(part: pa.RecordBatch, v: np.ndarray, go: np.ndarray, reach: np.ndarray, bound: np.ndarray,
                span: np.ndarray) -> pa.RecordBatch:
    """Rows of ``VISITS`` of the queries that visit a cell: ``go`` says which, ``span`` each cell's stripes."""
    some = np.flatnonzero(go.any(1))
    go = go[some]
    hit = go.astype(np.float32) @ span > 0
    stripes = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(hit.sum(1)))).astype(np.int32)),
                                       pa.array(np.nonzero(hit)[1].astype(np.int32)))
    return pa.RecordBatch.from_arrays(
        [part.column("qno").take(pa.array(some)), _binary(v[some]), pa.array(reach[some]), pa.array(bound[some]),
         _binary(np.packbits(go, axis=1)), pa.array(go.sum(1).astype(np.int32)), stripes],
        names=["qno", "v", "reach", "bound", "bits", "cells", "stripes"])


class _Share:
    """The queries of one share in a task, with the k smallest distances that each has met so far."""

    def __init__(self, parts: list[pa.RecordBatch], k: int, metric: str):
        self.k, self.metric = k, metric
        self.qno, self.reach, bound = (np.concatenate([p.column(c).to_numpy(zero_copy_only=False) for p in parts])
                                       for c in ("qno", "reach", "bound"))
        self.q = np.concatenate([_unbinary(p.column("v"), np.float64) for p in parts])
        self.bits = np.concatenate([_unbinary(p.column("bits"), np.uint8) for p in parts])
        self.best = np.repeat(bound[:, None], k, axis=1)
        self.limit = bound.copy()

    def visitors(self, at: int, low: float, high: float, centres: np.ndarray | None) -> np.ndarray:
        """The queries that visit cell number ``at`` and come near enough to a block with this interval."""
        near = np.flatnonzero(self.bits[:, at >> 3] >> (7 - (at & 7)) & 1)
        if centres is None or not len(near):
            return near
        dq = _apart(_unit(self.q[near], self.metric), centres[at:at + 1])[:, 0]
        return near[(dq - self.reach[near] <= high) & (dq + self.reach[near] >= low)]

    def meet(self, x: np.ndarray, visitors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(qno, row of ``x``, distance in steps): the k nearest of ``x`` within what each visitor has met."""
        step = max(1, _PAIRS // len(x))
        known = self.limit[visitors] < FAR
        for choose, some in ((_within, visitors[known]), (_chosen, visitors[~known])):
            for s in range(0, len(some), step):
                part = some[s:s + step]
                query, row, r = choose(x, self.q[part], self.k, self.metric, self.limit[part])
                if not len(query):
                    continue
                new = np.full((len(part), self.k), FAR)
                new[query, np.arange(len(query)) - np.searchsorted(query, query)] = r
                met = np.unique(query)
                best = np.partition(np.concatenate([self.best[part[met]], new[met]], axis=1), self.k - 1, axis=1)
                self.best[part[met]], self.limit[part[met]] = best[:, :self.k], best[:, self.k - 1]
                yield self.qno[part[query]], row, r


def _match(k: int, metric: str, sent):
    """Rows by key, a share's queries (``cell`` -1) before a stripe's blocks -> the answers of each block.  ``sent``
    has the numbers of the cells and, of an index with pivots, these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, centres = sent.value
        now, parts, share = None, [], None
        for batch in batches:
            key, cell = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell"))
            kind = key.astype(np.int64) * 2 + (cell >= 0)
            edge = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1], [True]))) if len(key) else []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if key[a] != now:
                    now, parts, share = key[a], [], None
                if cell[a] < 0:
                    parts.append(batch.slice(a, b - a))
                    continue
                if share is None:
                    share, parts = _Share(parts, k, metric), []
                for i in range(a, b):
                    one = batch.slice(i, 1)
                    visitors = share.visitors(int(np.searchsorted(number, cell[i])), one.column("low")[0].as_py(),
                                              one.column("high")[0].as_py(), centres)
                    if not len(visitors):
                        continue
                    ids = one.column("ids").flatten()
                    x = np.frombuffer(one.column("v")[0].as_buffer(), np.float64).reshape(len(ids), -1)
                    for qno, row, r in share.meet(x, visitors):
                        yield pa.RecordBatch.from_arrays([pa.array(qno), ids.take(pa.array(row)), pa.array(r)],
                                                         names=["qno", "id", "r"])
    return run


CELLS = "cell int, n long, low double, high double, v array<double>"
ABOUT = "metric string, n long, dim int, planes int, ids string"
# a query's visits: its vector, a bit for each cell, how many of these are set, and the stripes of those cells
VISITS = "qno long, v binary, reach double, bound long, bits binary, cells int, stripes array<int>"


class _Index:
    """What both indexes share: blocks, numbered queries, visits and their answers."""

    def __init__(self, spark: SparkSession, path: str, metric: str):
        if metric not in ("l2", "cosine"):
            raise ValueError(f"unknown metric {metric}")
        self.spark, self.path, self.metric = spark, path, metric
        self.n, self.dim, self.planes, self.ids = 0, 0, 0, "long"
        self.base = scratch_dir(spark, f"knn_{uuid.uuid4().hex}")

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(f"low double, high double, ids array<{self.ids}>, v binary, cell int") \
            .parquet(f"{self.path}/blocks")

    def _about(self) -> None:
        """Write what a later ``open`` has to know."""
        row = (self.metric, self.n, self.dim, self.planes, self.ids)
        self.spark.createDataFrame([row], ABOUT).coalesce(1).write.parquet(f"{self.path}/about")

    @classmethod
    def open(cls, spark: SparkSession, path: str):
        about = spark.read.schema(ABOUT).parquet(f"{path}/about").first()
        self = cls(spark, path, about["metric"])
        self.n, self.dim, self.planes, self.ids = about["n"], about["dim"], about["planes"], about["ids"]
        return self

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def _numbered(self, queries: DataFrame, id_col: str, vec_col: str) -> DataFrame:
        """``qno, id, v``: written once, so an embedder behind the queries runs once."""
        q = usable(queries, id_col, vec_col, self.metric)
        return self._kept(q.withColumn("qno", F.monotonically_increasing_id()), "queries")

    def _layout(self, queries: DataFrame, max_group_bytes: int) -> tuple[int, int]:
        """Shares of the queries and stripes of the cells."""
        size = 8 * (self.dim + 4)
        asked = queries.count() * size
        shares = max(SHARES if asked > max_group_bytes else 1, -(-asked // HELD_BYTES))
        return shares, max(SHARES, TASKS // shares) if self.n * size > max_group_bytes else 1

    def _answers(self, visits: DataFrame, name: str, k: int, layout: tuple[int, int], number: np.ndarray,
                 many: np.ndarray, centres: np.ndarray | None = None) -> DataFrame:
        """``qno, id, r``: of each block that a query of ``visits`` meets its nearest rows, at most k; ``reach`` is in
        the index's distances, ``bound`` in steps of the result's."""
        shares, stripes = layout
        visits = self._kept(visits.withColumn("share", F.pmod(F.xxhash64("qno"), F.lit(shares)).cast("int")), f"{name}_visits")
        first, last = spans(many, stripes)
        wide = (len(number) + 7) // 8

        def wanted(batches):
            """The cells that each share visits."""
            seen = np.zeros((shares, wide), np.uint8)
            for batch in batches:
                if batch.num_rows:
                    share = batch.column("share").to_numpy(zero_copy_only=False)
                    np.bitwise_or.at(seen, share, _unbinary(batch.column("bits"), np.uint8))
            share, at = np.nonzero(np.unpackbits(seen, axis=1)[:, :len(number)])
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)) for a in (share, number[at], first[at], last[at])],
                                             names=["share", "cell", "first", "last"])
        # at most shares * cells rows
        some = visits.select("share", "bits").mapInArrow(wanted, "share int, cell int, first int, last int").distinct()
        key = lambda stripe: (F.col("share") * stripes + stripe).cast("int").alias("key")
        at = F.col("first") + F.pmod(F.xxhash64("ids"), F.col("last") - F.col("first") + 1)
        asked = visits.select("*", F.explode("stripes").alias("stripe")).select(
            key(F.col("stripe")), F.lit(-1).alias("cell"), "v", "qno", "reach", "bound", "bits")
        met = self.blocks().join(F.broadcast(some), "cell").select(key(at), "cell", "v", "low", "high", "ids")
        return asked.unionByName(met, allowMissingColumns=True).repartitionById(shares * stripes, F.col("key")) \
            .sortWithinPartitions("key", "cell") \
            .mapInArrow(_match(k, self.metric, self.spark.sparkContext.broadcast((number, centres))),
                        f"qno long, id {self.ids}, r long")

    @staticmethod
    def _best(answers: DataFrame, k: int) -> DataFrame:
        w = Window.partitionBy("qno").orderBy("r", "id")
        return answers.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)

    def _named(self, best: DataFrame, queries: DataFrame, id_col: str) -> DataFrame:
        return (queries.select("qno", F.col("id").alias("query_id")).join(best, "qno")
                .select("query_id", "rank", F.col("id").alias(id_col), (F.col("r") / F.lit(1e6)).alias("distance")))

    def _empty(self, queries: DataFrame, query_id_col: str, id_col: str) -> DataFrame:
        kind = queries.schema[query_id_col].dataType.simpleString()
        return self.spark.createDataFrame([], f"query_id {kind}, rank long, {id_col} {self.ids}, distance double")


class PivotIndex(_Index):
    """Exact search by pivots; see the module."""

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding", metric: str = "l2",
              pivots: int | None = None) -> PivotIndex:
        """Write the index of ``vectors`` to ``path``.  Pivots are the vectors of smallest id hash, about one per
        ``CELL_ROWS`` rows unless a number is given, at most ``MAX_PIVOTS``."""
        self = cls(vectors.sparkSession, path, metric)
        rows = self._kept(usable(vectors, id_col, vec_col, metric), "rows")
        self.ids, self.n = rows.schema["id"].dataType.simpleString(), rows.count()
        if not self.n:
            self._about()
            return self
        many = min(MAX_PIVOTS, pivots or -(-self.n // CELL_ROWS))
        some = rows.orderBy(F.xxhash64("id"), "id").limit(many).select("v").toArrow()["v"].combine_chunks()
        centres = np.unique(_unit(_matrix(some), metric), axis=0)
        sent = self.spark.sparkContext.broadcast(centres)
        self.dim = centres.shape[1]
        self._about()

        def assign(batches):
            for batch in batches:
                x = _unit(_matrix(batch.column("v")), metric)
                cell, d = np.empty(len(x), np.int32), np.empty(len(x))
                step = max(1, _PAIRS // len(sent.value))
                for s in range(0, len(x), step):
                    apart = _apart(x[s:s + step], sent.value)
                    cell[s:s + step] = apart.argmin(1)
                diff = x - sent.value[cell]
                d = np.sqrt((diff * diff).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(d), batch.column("id"), batch.column("v")],
                                                 names=["cell", "d", "id", "v"])
        dealt = self._kept(rows.select("id", "v").mapInArrow(assign, f"cell int, d double, id {self.ids}, v array<double>"),
                           "dealt")
        (dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high"))
         .join(self.spark.createDataFrame(list(enumerate(centres.tolist())), "cell int, v array<double>"), "cell")
         .coalesce(1).write.parquet(f"{path}/cells"))
        write_blocks(dealt, f"{path}/blocks")
        return self

    def search(self, queries: DataFrame, k: int = 10, query_id_col: str = "query_id", query_vec_col: str = "embedding",
               id_col: str = "vec_id", max_group_bytes: int = MAX_GROUP_BYTES) -> DataFrame:
        """``query_id, rank, <id_col>, distance`` of the k nearest vectors of every query."""
        spark, metric = self.spark, self.metric
        if not self.n:
            return self._empty(queries, query_id_col, id_col)
        q = self._numbered(queries, query_id_col, query_vec_col)
        cells = spark.read.schema(CELLS).parquet(f"{self.path}/cells").orderBy("cell").toArrow()  # at most MAX_PIVOTS rows
        centres = _matrix(cells["v"].combine_chunks())
        number, many = cells["cell"].to_numpy(), cells["n"].to_numpy()
        layout = self._layout(q, max_group_bytes)
        sent = spark.sparkContext.broadcast((many, cells["low"].to_numpy(), cells["high"].to_numpy(), centres,
                                             _in_stripes(many, layout[1])))

        def visits(first: bool):
            """The first visits: nearest cells until they hold k rows.  The second: all others within reach."""
            def run(batches):
                many, low, high, c, span = sent.value
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    v = _matrix(batch.column("v"))
                    step = max(1, _PAIRS // len(c))
                    for s in range(0, len(v), step):
                        part = batch.slice(s, step)
                        d = _apart(_unit(v[s:s + step], metric), c)
                        order = np.argsort(d, axis=1, kind="stable")
                        before = np.cumsum(many[order], axis=1) - many[order]
                        go = np.zeros(d.shape, bool)
                        np.put_along_axis(go, order, before < k, axis=1)
                        bound = np.full(len(d), FAR) if first \
                            else part.column("bound").to_numpy(zero_copy_only=False)
                        far = bound.astype(np.float64) + 1  # in steps: rounding may go either way
                        reach = np.sqrt(2 * far * STEP) if metric == "cosine" else far * STEP
                        reach = reach + 1e-7 * (1 + reach + d.max(1, initial=0))
                        if not first:
                            go = ~go & (d - reach[:, None] <= high) & (d + reach[:, None] >= low)
                        yield _visit_rows(part, v[s:s + step], go, reach, bound, span)
            return run
        answers = lambda rows, name: self._answers(rows, name, k, layout, number, many, centres)
        near = self._best(answers(q.select("qno", "v").mapInArrow(visits(True), VISITS), "first"), k)
        if len(centres) == 1:
            return self._named(near, q, id_col)
        near = self._kept(near.select("qno", "id", "r", "rank"), "near")
        # fewer than k rows in all: every cell was visited
        bound = near.where(F.col("rank") == k).select("qno", F.col("r").alias("bound"))
        more = answers(q.select("qno", "v").join(bound, "qno").mapInArrow(visits(False), VISITS), "second")
        return self._named(self._best(near.drop("rank").unionByName(more), k), q, id_col)


def plane_signs(planes: int, dim: int, seed: int = PLANE_SEED) -> np.ndarray:
    """The components of the planes: +1 where the first hex digit of md5(``seed:plane:component``) is even."""
    return np.array([[1 - 2 * (int(hashlib.md5(f"{seed}:{j}:{i}".encode()).hexdigest()[0], 16) & 1)
                      for i in range(dim)] for j in range(planes)], np.int64).reshape(planes, dim)


def _margins(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Exact products of vectors in whole numbers (components beyond 2^40 units count as that) with the planes."""
    return np.clip(np.floor(x * UNIT), -float(1 << 40), float(1 << 40)).astype(np.int64) @ signs.T


class HyperplaneIndex(_Index):
    """Approximate L2 search by sign patterns; see the module."""

    @classmethod
    def build(cls, vectors: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding",
              planes: int | None = None) -> HyperplaneIndex:
        """Write the index of ``vectors``: 2^planes cells, about ``PLANE_ROWS`` to twice as many rows each
        unless a number is given, at most 2^``MAX_PLANES`` cells."""
        self = cls(vectors.sparkSession, path, "l2")
        rows = self._kept(usable(vectors, id_col, vec_col, "l2"), "rows")
        got = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
        self.n, self.dim, self.ids = got["n"], got["dim"] or 0, rows.schema["id"].dataType.simpleString()
        self.planes = planes if planes is not None else min(MAX_PLANES, max(0, (self.n // PLANE_ROWS).bit_length() - 1))
        self._about()
        signs = plane_signs(self.planes, self.dim)

        def assign(batches):
            power = 1 << np.arange(len(signs))
            for batch in batches:
                if batch.num_rows:
                    cell = (_margins(_matrix(batch.column("v")), signs) >= 0) @ power
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell.astype(np.int32)), pa.array(np.zeros(len(cell))), batch.column("id"),
                         batch.column("v")], names=["cell", "d", "id", "v"])
        dealt = self._kept(rows.select("id", "v").mapInArrow(assign, f"cell int, d double, id {self.ids}, v array<double>"),
                           "dealt")
        dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/cells")
        if self.n:
            write_blocks(dealt, f"{path}/blocks")
        return self

    def search(self, queries: DataFrame, k: int = 10, query_id_col: str = "query_id", query_vec_col: str = "embedding",
               id_col: str = "vec_id", rows_to_see: int | None = None, sample_recall: float = SAMPLE_RECALL,
               max_group_bytes: int = MAX_GROUP_BYTES) -> DataFrame:
        """``query_id, rank, <id_col>, distance``: the k nearest of the vectors in the visited cells.

        A query visits cells by rising cost until they hold ``rows_to_see`` rows, at least k.  By default that
        number is measured: so many rows that ``RECALL_QUERIES`` sampled queries (those of smallest md5 of
        their id) would have found ``sample_recall`` of their exact neighbours."""
        spark = self.spark
        if not self.n:
            return self._empty(queries, query_id_col, id_col)
        q = self._numbered(queries, query_id_col, query_vec_col)
        signs = plane_signs(self.planes, self.dim)
        many = np.zeros(1 << self.planes, np.int64)
        for r in spark.read.schema("cell int, n long").parquet(f"{self.path}/cells").collect():  # at most 2^MAX_PLANES rows
            many[r["cell"]] = r["n"]
        number = np.flatnonzero(many).astype(np.int32)
        many = many[number]
        bits = (number[:, None] >> np.arange(len(signs))) & 1
        sent = spark.sparkContext.broadcast((signs, many, bits))

        def order(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Cells by rising cost, and the rows seen before each."""
            signs, many, bits = sent.value
            m = _margins(v, signs)
            # exact while the sum of margins stays below 2^53 units
            cost = np.abs(m) * (m >= 0) @ (1 - bits).T + np.abs(m) * (m < 0) @ bits.T
            by = np.argsort(cost, axis=1, kind="stable")
            return by, np.cumsum(many[by], axis=1) - many[by]

        def visits(need: int, layout: tuple[int, int]):
            """The cells that each query visits until they hold ``need`` rows."""
            span = spark.sparkContext.broadcast(_in_stripes(many, layout[1]))

            def run(batches):
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    v = _matrix(batch.column("v"))
                    step = max(1, _PAIRS // len(number))
                    for s in range(0, len(v), step):
                        by, seen = order(v[s:s + step])
                        go = np.zeros(by.shape, bool)
                        np.put_along_axis(go, by, seen < need, axis=1)
                        yield _visit_rows(batch.slice(s, step), v[s:s + step], go, np.full(len(go), np.inf),
                                          np.full(len(go), FAR), span.value)
            return run

        def seen_before(batches):
            """Every cell with the rows that a query sees before it."""
            for batch in batches:
                if batch.num_rows:
                    by, seen = order(_matrix(batch.column("v")))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("qno").take(pa.array(np.repeat(np.arange(len(by)), by.shape[1]))),
                         pa.array(number[by].ravel()), pa.array(seen.ravel())], names=["qno", "cell", "seen"])

        def ask(rows: DataFrame, name: str, need: int) -> DataFrame:
            layout = self._layout(rows, max_group_bytes)
            found = rows.select("qno", "v").mapInArrow(visits(need, layout), VISITS)
            return self._best(self._answers(found, name, k, layout, number, many), k)
        if rows_to_see is None:
            rows_to_see = self._measured(q, ask, seen_before, sample_recall)
        return self._named(ask(q, "found", max(k, min(rows_to_see, self.n))), q, id_col)

    def _measured(self, q: DataFrame, ask, seen_before, recall: float) -> int:
        """The rows that sampled queries have to see for ``recall`` of their exact neighbours."""
        sample = self._kept(q.orderBy(F.md5(F.col("id").cast("string")), "qno").limit(RECALL_QUERIES).select("qno", "v"),
                            "sample")
        exact = ask(sample, "exact", self.n).select("qno", "id")  # all rows: every cell is visited
        ids = self.blocks().select("cell", F.explode("ids").alias("id"))
        # at most RECALL_QUERIES rows times 2^MAX_PLANES cells
        seen = sample.mapInArrow(seen_before, "qno long, cell int, seen long")
        # at most RECALL_QUERIES * k rows
        needed = np.sort(exact.join(ids, "id").join(seen, ["qno", "cell"]).select("seen").toArrow()["seen"].to_numpy())
        return int(needed[max(0, math.ceil(recall * len(needed)) - 1)]) + 1 if len(needed) else 0
