"""Toxicity scores from a factorization machine over hashed terms.

A document's terms are its distinct words (A-Z lower-cased; digits, letters and characters beyond
ASCII) and the character n-grams of those words, framed by marks, hashed into ``BUCKETS`` and valued
by inverse document frequency in the training sample.  The score is the logistic of

    bias + sum_i w_i x_i + 1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

so pairs of terms add what their linear weights alone do not say (an insult next to a mention of
a group).  Weights are learned by stochastic gradient descent in numpy with a proximal step that
holds every weight at 0 until its gradients add up to more than ``L1`` (follow the regularised
leader), so the many ordinary words of a long text do not drown one insult; factors, of terms whose
weight is not 0, have step sizes of their own.

``fit`` uses at most ``per_class`` labelled documents of each class, those with the smallest hash
of their id; the bias is then shifted to the classes' true shares.  Terms seen in fewer than
``MIN_DOCS`` training documents get no weight.  The model is a table of fixed size at most and is
broadcast.

Null and empty texts have no terms and get the score of the bias alone.  Labels that are null
teach nothing; with no label at all every score is 0.  Rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .quality import word_features
from .shared import labelled_sample

BUCKETS, RANK, SIZES = 1 << 18, 8, (4, 5)
PER_CLASS, EPOCHS, MIN_DOCS, SEED = 2000, 4, 3, 5
L1, STEP, FACTOR_STEP, DECAY = 4.0, 1.0, 0.05, 1e-3


def features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``label, ids``: the distinct buckets of each document's terms."""
    schema = pa.schema([("label", pa.int32()), ("ids", pa.binary())])

    def one(rows, data, off):
        code, row, vocab = B.words(data, off)
        word, bucket = word_features(vocab, buckets, SIZES)
        order = np.argsort(word, kind="stable")
        bucket, own = bucket[order], np.searchsorted(word[order], np.arange(len(vocab) + 1))
        at, ids = B.row_starts(row, rows.num_rows), []
        for i in range(rows.num_rows):
            c = np.unique(code[at[i]:at[i + 1]])
            terms = np.unique(bucket[B.ragged(own[c], own[c + 1] - own[c])])
            ids.append(terms.astype(np.uint32).tobytes())
        return B.batch_of(schema, rows.column("label"), ids)
    return docs.select(F.col("label").cast("int").alias("label"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(B.per_block(one), "label int, ids binary")


@dataclass
class Model:
    """Bias, and per bucket its feature value, linear weight and factors (value 0: not used)."""

    bias: float
    value: np.ndarray
    weight: np.ndarray
    factors: np.ndarray


def logit(model: Model, ids: np.ndarray) -> float:
    """The model's sum for one document's distinct buckets."""
    x, v = model.value[ids], model.factors[ids]
    s = x @ v
    return float(model.bias + x @ model.weight[ids] + 0.5 * ((s * s).sum() - ((x * x) @ (v * v)).sum()))


def train(rows: list[tuple[int, np.ndarray]], share: float | None = None, buckets: int = BUCKETS, rank: int = RANK,
          epochs: int = EPOCHS, l1: float = L1, step: float = STEP, min_docs: int = MIN_DOCS,
          seed: int = SEED) -> Model:
    """Learn from (label, distinct buckets) rows; ``share``: label 1's share outside the sample."""
    n = len(rows)
    df = np.bincount(np.concatenate([i for _, i in rows]), minlength=buckets) if n else np.zeros(buckets, np.int64)
    value = np.where(df >= min_docs, np.log((1 + n) / (1 + df)) / np.log(1 + max(n, 1)), 0).astype(np.float32)
    rng = np.random.default_rng(seed)
    w, pull, squares = np.zeros(buckets), np.zeros(buckets), np.zeros(buckets)
    v = rng.normal(0, 0.01, (buckets, rank)).astype(np.float32)
    gv, bias, gb = np.full((buckets, rank), 1e-2, np.float32), 0.0, 1e-2
    rows = [(y, i[value[i] > 0]) for y, i in rows]
    for _ in range(epochs):
        for k in rng.permutation(n):
            y, ids = rows[k]
            x, wi = value[ids], w[ids]
            on = wi != 0
            a, xa = ids[on], x[on]
            va = v[a]
            s = xa @ va
            z = bias + xa @ wi[on] + 0.5 * float((s * s).sum() - ((xa * xa) @ (va * va)).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            dw = g * x
            root = np.sqrt(squares[ids])
            squares[ids] += dw * dw
            new_root = np.sqrt(squares[ids])
            pull[ids] += dw - (new_root - root) / step * wi
            p = pull[ids]
            w[ids] = np.where(np.abs(p) <= l1, 0, (np.sign(p) * l1 - p) * step / (1 + new_root))
            if len(a):
                dv = g * (xa[:, None] * s - va * (xa * xa)[:, None]) + DECAY * va
                gv[a] += dv * dv
                v[a] -= FACTOR_STEP * dv / np.sqrt(gv[a])
            gb += g * g
            bias -= FACTOR_STEP * g / np.sqrt(gb)
    if n and share is not None and 0 < share < 1:
        got = np.clip(np.mean([y for y, _ in rows]), 1e-6, 1 - 1e-6)
        bias += np.log(share / (1 - share)) - np.log(got / (1 - got))
    return Model(float(bias) if n else -30.0, np.where(w != 0, value, 0), w.astype(np.float32), v)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on ``docs(doc_id, text)`` and ``labels(doc_id, label)``."""
    got = features(labelled_sample(docs, labels, per_class)).toArrow()
    rows = sorted(((int(y), np.frombuffer(i, np.uint32).astype(np.int64))
                   for y, i in zip(got["label"].to_pylist(), got["ids"].to_pylist(), strict=True)),
                  key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    share = labels.where("label IS NOT NULL").agg(F.avg(F.col("label").cast("double"))).first()[0]
    return train(rows, share)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (the probability of label 1) for every row of ``docs(doc_id, text)``."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    used = np.flatnonzero(model.value)
    place = np.full(len(model.value), -1, np.int64)
    place[used] = np.arange(len(used))
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.bias, place, model.weight[used] * model.value[used],
         model.factors[used] * model.value[used, None]))

    def one(rows, data, off):
        bias, place, linear, factors = sent.value
        code, row, vocab = B.words(data, off)
        word, bucket = word_features(vocab, len(place), SIZES)
        alive = place[bucket] >= 0  # terms with a weight: few, so most words have none
        order = np.argsort(word[alive], kind="stable")
        word, terms = word[alive][order], place[bucket[alive]][order]
        own = np.searchsorted(word, np.arange(len(vocab) + 1))
        n = rows.num_rows
        size = np.diff(own)[code] if len(code) else np.zeros(0, np.int64)
        some = size > 0
        at = B.ragged(own[code[some]], size[some]) if some.any() else np.zeros(0, np.int64)
        pair = np.unique(np.repeat(row[some], size[some]) * np.int64(max(len(linear), 1)) + terms[at])
        r, t = pair // max(len(linear), 1), pair % max(len(linear), 1)
        z = bias + np.bincount(r, linear[t], n)
        for f in range(factors.shape[1]):
            x = factors[t, f]
            z += 0.5 * (np.bincount(r, x, n) ** 2 - np.bincount(r, x * x, n))
        return B.batch_of(schema, rows.column("doc_id"), 1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(B.per_block(one), "doc_id long, score double")
