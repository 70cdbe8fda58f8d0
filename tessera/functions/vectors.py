"""Vector helpers: the built-in hashed-token embedder and distance expressions.

The embedder is a pluggable function ``DataFrame -> DataFrame`` adding an
``array<double>`` column.  The default is feature hashing: each lower-cased
word token goes to bucket ``int(md5(token)[:7], 16) % dim`` with sign
``+1`` when the 8th hex digit is even, ``-1`` otherwise; counts are summed
exactly as integers and the vector is L2-normalised.  It is computed per row
in an Arrow UDF working on whole Arrow batches (the tokeniser itself runs in the JVM), so
an embedding never needs a shuffle of token-level rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import posexplode_rows
from .text import word_tokens

DEFAULT_DIM = 64


_TOKEN_CACHE: dict[tuple[str, int], tuple[int, int]] = {}
_TOKENS = 1 << 18
_CACHE_LIMIT = 1 << 16  # a corpus has more distinct tokens the larger it is; frequent ones come back soon


def _token_hashes(uniq: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, sign) of each distinct token; up to ``_CACHE_LIMIT`` of them are kept in a worker."""
    if len(_TOKEN_CACHE) >= _CACHE_LIMIT:
        _TOKEN_CACHE.clear()
    b = np.empty(len(uniq), dtype=np.int64)
    s = np.empty(len(uniq), dtype=np.float64)
    for j, t in enumerate(uniq):
        hs = _TOKEN_CACHE.get((t, dim))
        if hs is None:
            h = hashlib.md5(t.encode("utf-8")).hexdigest()
            hs = (int(h[:7], 16) % dim, -1 if int(h[7], 16) & 1 else 1)
            if len(_TOKEN_CACHE) < _CACHE_LIMIT:
                _TOKEN_CACHE[(t, dim)] = hs
        b[j], s[j] = hs
    return b, s


def _hashed_vector_udf(dim: int):
    def sums(tokens: pa.Array, lens: np.ndarray) -> np.ndarray:
        # no per-row Python: flatten the token lists, dictionary-encode them so each distinct token is
        # hashed once, and sum signed counts into a (rows x dim) matrix with a single bincount
        n = len(tokens)
        enc = pc.dictionary_encode(pc.list_flatten(tokens))
        codes = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        bucket, sign = _token_hashes(np.asarray(enc.dictionary.to_pylist(), dtype=object), dim)
        rows = np.repeat(np.arange(n, dtype=np.int64), lens)
        m = np.bincount(rows * dim + bucket[codes], weights=sign[codes], minlength=n * dim).reshape(n, dim)
        nrm = np.sqrt((m * m).sum(1))
        return np.divide(m, nrm[:, None], out=np.zeros_like(m), where=nrm[:, None] > 0)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def embed(tokens: pa.Array) -> pa.Array:
        # rows of about _TOKENS tokens at a time; the result goes back as one list array
        n = len(tokens)
        lens = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, m, start = np.cumsum(lens), np.zeros((n, dim), dtype=np.float64), 0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(upto, upto[start] - lens[start] + _TOKENS, "right")))
            if upto[stop - 1] > upto[start] - lens[start]:
                m[start:stop] = sums(tokens.slice(start, stop - start), lens[start:stop])
            start = stop
        offsets = pa.array(np.arange(0, n * dim + 1, dim, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(m.reshape(-1)))

    return embed


def hashed_embedding(text: Column, dim: int = DEFAULT_DIM) -> Column:
    """array<double>(dim) feature-hashed, L2-normalised embedding of a text column."""
    return _hashed_vector_udf(dim)(word_tokens(text))


def embed_text(df: DataFrame, text_col: str = "text", out_col: str = "embedding",
               dim: int = DEFAULT_DIM, embedder=None) -> DataFrame:
    """Add an embedding column.  ``embedder(df, text_col, out_col, dim)`` may replace the default
    (for a model, typically a ``mapInPandas`` that loads the model once per worker)."""
    if embedder is not None:
        out = embedder(df, text_col, out_col, dim)
    else:
        out = df.withColumn(out_col, hashed_embedding(F.col(text_col), dim))
    return out


def check_dim(df: DataFrame, col: str, dim: int) -> DataFrame:
    """Fail the job on a vector whose length is not ``dim`` (fixed-length vector contract)."""
    return df.withColumn(col, F.when(F.size(col) == dim, F.col(col))
                         .otherwise(F.raise_error(F.format_string(f"vector length %d != {dim}", F.size(col)))))


def sparse_components(df: DataFrame, id_col: str, vec_col: str = "embedding") -> DataFrame:
    """(id, dim_idx, value) for the non-zero components, value rounded to 6 places."""
    return (posexplode_rows(df, [id_col], vec_col, "dim_idx", "value")
              .where(F.col("value") != 0)
              .select(id_col, F.col("dim_idx").cast("long"), F.round("value", 6).alias("value")))


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equal-length arrays, in double (for single-query use)."""
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x))
