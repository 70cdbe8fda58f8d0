import numpy as np
import pytest

from tessera.llm import whitening as W


def rows_of(spark, frame, **options):
    return W.whiten(spark, frame, **options).orderBy("vec_id").collect()


def brute(vectors, k):
    x = np.floor(64 * np.array(vectors, float)) + 1_000_000
    xi = x.astype(object).astype(object)
    n, s = len(x), [sum(int(v) for v in c) for c in x.T]
    dev = [sum((n * int(v) - t) ** 2 for v, t in zip(r, s, strict=True)) for r in xi]
    c = x - np.array([float(t) / n for t in s])
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    order = np.argsort(-e, kind="stable")[:k]
    return dev, c @ u[:, order] / np.sqrt(e[order]), e[order] / np.trace(cov)


@pytest.mark.parametrize("block", [7, 64])
def test_equals_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(W, "MIN_BLOCK", block)
    monkeypatch.setattr(W, "BLOCKS", 100)
    rng = np.random.default_rng(2)
    data = rng.normal(size=(150, 6)) @ np.diag([9, 6, 4, 2, 1, 0.5])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    got = rows_of(spark, frame.repartition(5), components=4)
    dev, white, share = brute(data, 4)
    assert [r.deviation for r in got] == dev
    have = np.array([r.whitened for r in got])
    sign = np.sign((have * white).sum(0))
    assert np.abs(have - sign * white).max() < 1e-9
    assert np.abs(np.array(got[0].explained) - share).max() < 1e-12
    assert got[0].identity_error < 1e-9 and got[0].n == 150


def test_rows_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0], 5, "a"), (2, [2.0, 1.0], 5, "a"), (2, [2.0, 1.0], 5, "a"), (None, [-1.0, 0.5], None, None),
            (3, None, 1, "b"), (4, [], 1, "b"), (5, [1.0], 1, "b"), (6, [None, 1.0], 1, "b"),
            (7, [float("nan"), 1.0], 1, "b"), (8, [float("inf"), 1.0], 1, "b"), (9, [0.0, -3.0], 1, "b")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row long, x string")
    got = rows_of(spark, frame)
    assert [r.vec_id for r in got] == [None, 1, 2, 2, 9]
    assert {r.n for r in got} == {5} and len(got[0].whitened) == 2
    assert rows_of(spark, frame.limit(0)) == []


def test_flat_components_and_huge_entries(spark):
    frame = spark.createDataFrame([(i, [float(i), 3.0]) for i in range(8)], "vec_id long, embedding array<double>")
    got = rows_of(spark, frame)
    assert all(r.whitened[1] is None and r.whitened[0] is not None for r in got) and got[0].identity_error < 1e-9
    one = rows_of(spark, frame.limit(1))
    assert one[0].whitened == [None, None] and one[0].identity_error is None and one[0].deviation == 0
    huge = spark.createDataFrame([(1, [3e300, 0.0]), (2, [0.0, 1.0]), (3, [0.0, -1.0])],
                                 "vec_id long, embedding array<double>")
    assert [r.deviation for r in rows_of(spark, huge)] == [None, None, None]
