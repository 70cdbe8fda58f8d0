"""The hashing embedder's memory."""

import hashlib

import numpy as np
import pytest

from tessera.functions import vectors as vx


def test_token_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(vx, "_TOKEN_CACHE", {})
    for n in (0, 1):
        words = [f"w{n}_{i}" for i in range(300_000)]
        bucket, sign = vx._token_hashes(np.asarray(words, dtype=object), 64)
        assert len(vx._TOKEN_CACHE) <= 100_000
        for i in (0, 150_000, 299_999):
            h = hashlib.md5(words[i].encode()).hexdigest()
            assert (bucket[i], sign[i]) == (int(h[:7], 16) % 64, -1 if int(h[7], 16) % 2 else 1)


@pytest.mark.parametrize("many", [1, 4, 1000])
def test_rows_taken_some_at_a_time_embed_as_one(spark, monkeypatch, many):
    texts = ["a b b", "", None, "c " * 9, "a", "d e f g h"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").coalesce(1)
    want = {r.id: r.v for r in df.select("id", vx.hashed_embedding("text", 8).alias("v")).collect()}
    monkeypatch.setattr(vx, "_TOKENS", many)
    import pyarrow as pa
    tokens = pa.array([None if t is None else t.split() for t in texts])
    got = vx._hashed_vector_udf(8).func(tokens).to_pylist()
    assert got == [want[i] for i in range(len(texts))]
