import math

import numpy as np
import pytest

from tessera.llm import vector_search as V


def brute(rows, query_ids, k):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in fine:
        if q in query_ids:
            got = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in fine if i != q and len(v) == len(qv))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(got[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [16, 8192])
def test_same_as_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(V, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 8).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(400, None), (401, []), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
             (405, [1.0, 2.0, 3.0]), (406, [2.0, 2.0, 2.0]), (None, [1.0] * 8), (407, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "vec_id", "embedding", "1 AS score", "'x' AS bound", "vec_id AS query_row").repartition(4)
    got = V.top_k(spark, df, df.where("vec_id % 10 = 0 OR vec_id IN (405, 406, 407, 400)"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    wanted = {i for i in range(0, 400, 10)} | {405, 406, 407, 400}
    assert sorted(map(tuple, got.collect())) == brute(rows, wanted, 10)


def test_large_components_are_exact(spark):
    rows = [(i, [1e5 + i, -3e5, 7.5]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, V.top_k(spark, df, df.where("vec_id = 0")).collect()))
    assert got == brute(rows, {0}, 10)


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert V.top_k(spark, df, df).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, V.top_k(spark, two, two.where("vec_id = 0")).collect()))
    assert got == [(0, 1, 1, 1024 * 2048)] * 2  # each repeated query row is answered; its own id is no candidate


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(0, 100, (4000, 16)))
    batch = V._index_row(16, np.arange(4000), v)
    row = batch.to_pylist()[0]
    lower, upper = V._cell_bounds(row, v[:5])
    exact = v[:5] @ v.T
    assert (lower <= exact).all() and (exact <= upper).all()
    floor = V._largest(lower, 10).min(1)
    assert (upper >= floor[:, None]).sum(1).max() < 200
