"""Written vector indexes against comparing every pair."""
import uuid

import numpy as np
import pytest

from tessera.operators import vector_index as vi
from tessera.operators.vector_index import HyperplaneIndex, PivotIndex


def frame(spark, name, ids, x):
    return spark.createDataFrame(list(zip(ids, x.tolist(), strict=True)),
                                 f"{name} {'string' if isinstance(ids[0], str) else 'long'}, embedding array<double>")


def brute(qids, q, ids, x, k, metric="l2"):
    out = set()
    for i, v in zip(qids, q, strict=True):
        if metric == "cosine":
            n = np.linalg.norm(x, axis=1) * np.linalg.norm(v)
            d = 1 - np.divide(x @ v, n, out=np.full(len(x), -np.inf), where=n > 0)
        else:
            d = np.sqrt(((x - v) ** 2).sum(1))
        rows = sorted((round(a, 6), b) for a, b in zip(d.tolist(), ids, strict=True) if a < np.inf)[:k]
        out |= {(i, r, b, a) for r, (a, b) in enumerate(rows, 1)}
    return out


def clustered(seed, n, dim=8, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 6
    return (centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim))) * scale


def answers(found, id_col="vec_id"):
    return {(r.query_id, r["rank"], r[id_col], r.distance) for r in found.collect()}


@pytest.mark.parametrize("metric, scale", [("l2", 1.0), ("cosine", 1.0), ("l2", 8000.0)])
def test_pivots_equal_all_pairs(spark, tmp_path, metric, scale):
    x = clustered(1, 600, scale=scale)
    x[50:90] = x[50]  # one vector many times: ties by id
    q = np.concatenate([x[::20], clustered(2, 20, scale=scale)])
    ids, qids = [f"u{(i * 7919) % 600:04d}" for i in range(600)], list(range(len(q)))
    index = PivotIndex.build(frame(spark, "vec_id", ids, x), f"{tmp_path}/{uuid.uuid4().hex}", metric=metric, pivots=24)
    got = answers(PivotIndex.open(spark, index.path).search(frame(spark, "query_id", qids, q), k=7, max_group_bytes=2000))
    assert got == brute(qids, q, ids, x, 7, metric)


def test_cells_out_of_reach_are_not_visited(spark, tmp_path):
    x = clustered(3, 600)
    index = PivotIndex.build(frame(spark, "vec_id", list(range(600)), x), f"{tmp_path}/i", pivots=24)
    q = frame(spark, "query_id", list(range(30)), x[:30])
    index.search(q, k=3).collect()
    visits = sum(spark.read.parquet(f"{index.base}/{s}_visits").count() for s in ("first", "second"))
    assert visits < 30 * 24 / 3
    plan = index.blocks().where("cell = 3")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


def test_rows_that_take_no_part(spark, tmp_path):
    rows = [(1, [0.0, 1.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 0.0]), (6, [float("inf"), 0.0]),
            (7, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = v.withColumnRenamed("vec_id", "query_id")
    for metric, ids in (("l2", {1, 7}), ("cosine", {1})):
        got = PivotIndex.build(v, f"{tmp_path}/{metric}", metric=metric).search(q, k=5).collect()
        assert {(r.query_id, r.vec_id) for r in got} == {(a, b) for a in ids for b in ids}
    for n, kind in enumerate((PivotIndex, HyperplaneIndex)):
        assert kind.build(v.limit(0), f"{tmp_path}/e{n}").search(q).collect() == []
        assert kind.build(v, f"{tmp_path}/f{n}").search(q.limit(0)).collect() == []


def test_hyperplanes_visit_all_when_asked_and_only_some_else(spark, tmp_path):
    x = clustered(4, 800)
    ids = list(range(800))
    index = HyperplaneIndex.build(frame(spark, "vec_id", ids, x), f"{tmp_path}/h", planes=5)
    q = frame(spark, "query_id", ids[:40], x[:40])
    want = brute(ids[:40], x[:40], ids, x, 5)
    assert answers(HyperplaneIndex.open(spark, index.path).search(q, k=5, rows_to_see=800)) == want
    some = answers(index.search(q, k=5))
    assert len(some) == len(want) and len({r[::2] for r in some} & {r[::2] for r in want}) >= 0.9 * len(want)
    seen = spark.read.parquet(f"{index.base}/found_visits").groupBy("qno").count().toPandas()["count"]
    assert seen.mean() < 32 / 2
    one = answers(HyperplaneIndex.build(frame(spark, "vec_id", ids, x), f"{tmp_path}/g", planes=9)
                  .search(q, k=50, rows_to_see=1))
    assert len(one) == 40 * 50  # cells of a row or two: visited until they hold k


def test_plane_signs_are_those_of_md5():
    import hashlib
    s = vi.plane_signs(3, 4)
    for j in range(3):
        for i in range(4):
            assert s[j, i] == (1 if int(hashlib.md5(f"7:{j}:{i}".encode()).hexdigest()[0], 16) % 2 == 0 else -1)


def test_queries_that_visit_every_cell_are_kept_once(spark, tmp_path):
    """Vectors without clusters: all cells are within reach, and a query's vector is still written once."""
    x = np.random.default_rng(5).normal(size=(400, 48))
    v, q = frame(spark, "vec_id", list(range(400)), x), frame(spark, "query_id", list(range(60)), x[:60])
    want = brute(range(60), x[:60], range(400), x, 5)
    exact = PivotIndex.build(v, f"{tmp_path}/p", pivots=20)
    assert answers(exact.search(q, k=5, max_group_bytes=2000)) == want
    signs = HyperplaneIndex.build(v, f"{tmp_path}/h", planes=5)
    assert answers(signs.search(q, k=5, rows_to_see=400, max_group_bytes=2000)) == want
    for base, name in ((exact.base, "second"), (signs.base, "found")):
        visits = spark.read.parquet(f"{base}/{name}_visits")
        assert visits.count() == visits.select("qno").distinct().count() == 60
        assert visits.agg({"cells": "sum"}).first()[0] > 60 * 15
        # a query is sent to each stripe at most once
        assert all(len(set(r.stripes)) == len(r.stripes) <= vi.SHARES for r in visits.select("stripes").collect())


def test_cells_are_laid_along_stripes():
    first, last = vi.spans(np.array([1, 1, 94, 2, 2]), 4)
    assert first.tolist() == [0, 0, 0, 3, 3] and last.tolist() == [0, 0, 3, 3, 3]
