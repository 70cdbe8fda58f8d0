"""Quality scores from supervised subword embeddings.

A document's features are its words (runs without ASCII white space, in their own case) and the
character n-grams of the words, hashed into ``BUCKETS``; a word that repeats the one before it also
gives ``REPEAT`` times the feature "repeated", in a bucket of its own.  Every bucket has a learned
vector; a document is the mean of its features' vectors, and a softmax layer on that mean gives the class
probabilities.  Vectors and layer are trained together by stochastic gradient descent in numpy.

``fit`` uses at most ``per_class`` labelled documents of each class, those with the smallest hash
of their id, whose hashed feature counts are gathered on the driver.  Since the layer is linear in
the mean, scoring needs one number per bucket and class (vector times layer), a table of fixed
size that is broadcast; a block's distinct words are hashed once.

Null and empty texts have no features and get the score of the bias alone.  Labels that are null
teach nothing; with no label at all every score is 0.5.  Rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .shared import labelled_sample

BUCKETS, DIM, SIZES, REPEAT = 1 << 17, 16, (3, 4, 5), 8
PER_CLASS, EPOCHS, RATE, SEED = 2000, 12, 0.6, 11


def word_features(vocab: list[bytes], buckets: int = BUCKETS, sizes=SIZES):
    """(word number, bucket) of each word and of its character n-grams, framed by marks."""
    if not vocab:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = (B.hash64(vocab, 1) % np.uint64(buckets)).astype(np.int64)
    body = np.frombuffer(b"\x02" + b"\x03\x02".join(vocab) + b"\x03", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, vocab), np.int64, len(vocab)) + 2
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(vocab)), size)
    left = end[owner] - np.arange(len(body))
    words, out = [np.arange(len(vocab))], [whole]
    h = np.full(len(body), 14695981039346656037, np.uint64)
    for j in range(max(sizes)):
        h = h[:len(body) - j]
        h = (h ^ body[j:]) * np.uint64(1099511628211)
        if j + 1 in sizes:
            ok = left[:len(h)] > j
            mixed = h[ok] ^ (h[ok] >> np.uint64(29))
            mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
            words.append(owner[:len(h)][ok])
            out.append(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(words), np.concatenate(out)


def _block_words(data, off):
    return B.words(data, off, B.SOLID_BYTE, lower=False)


def _repeats(code, row, n_rows: int) -> np.ndarray:
    """The "repeated" features of each row."""
    again = (code[1:] == code[:-1]) & (row[1:] == row[:-1])
    return REPEAT * np.bincount(row[1:][again], minlength=n_rows)


def features(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``label, ids, counts``: each document's distinct buckets and how often each occurs."""
    schema = pa.schema([("label", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())])

    def one(rows, data, off):
        code, row, vocab = _block_words(data, off)
        word, bucket = word_features(vocab, buckets)
        order = np.argsort(word, kind="stable")
        word, bucket = word[order], bucket[order]
        at = np.searchsorted(word, np.arange(len(vocab) + 1))
        starts = B.row_starts(row, rows.num_rows)
        repeats = _repeats(code, row, rows.num_rows)
        ids, counts = [], []
        for i in range(rows.num_rows):
            c = code[starts[i]:starts[i + 1]]
            b, n = np.unique(bucket[B.ragged(at[c], at[c + 1] - at[c])], return_counts=True)
            if repeats[i]:
                b, n = np.append(b, buckets), np.append(n, repeats[i])
            ids.append(b.astype(np.uint32).tobytes())
            counts.append(n.astype(np.float32).tobytes())
        return B.batch_of(schema, rows.column("label"), ids, counts)
    return docs.select(F.col("label").cast("int").alias("label"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(B.per_block(one, max_bytes=1 << 20), "label int, ids binary, counts binary")


@dataclass
class Model:
    """Per bucket (the last: repeated words) the vector times the layer, one column per class, and
    the bias."""

    table: np.ndarray
    bias: np.ndarray


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model:
    """Stochastic gradient descent over (label, buckets, counts) rows, one document at a time."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / dim, 1 / dim, (buckets + 1, dim)).astype(np.float32)
    w, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    rows = [(y, i, c / c.sum()) for y, i, c in rows if len(i)]
    step, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, ids, x = rows[k]
            lr = rate * (1 - step / total)
            step += 1
            hidden = x @ e[ids]
            z = hidden @ w + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = w @ p
            w -= lr * np.outer(hidden, p)
            bias -= lr * 0.1 * p
            # a mean spreads the gradient over many vectors: each moves by its share of the text
            e[ids] -= (lr * 40 * x[:, None]) * back
    return Model((e @ w).astype(np.float32), bias)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Train on ``docs(doc_id, text)`` and ``labels(doc_id, label)``."""
    got = features(labelled_sample(docs, labels, per_class)).toArrow()
    rows = [(int(y), np.frombuffer(i, np.uint32).astype(np.int64), np.frombuffer(c, np.float32))
            for y, i, c in zip(got["label"].to_pylist(), got["ids"].to_pylist(), got["counts"].to_pylist(),
                               strict=True)]
    # the executors hand rows over in any order: training must not depend on it
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes(), r[2].tobytes()))
    return train(rows)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (the probability of label 1) for every row of ``docs(doc_id, text)``."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    margin = (model.table[:, 1] - model.table[:, 0]).astype(np.float64)
    bias, buckets = float(model.bias[1] - model.bias[0]), len(margin) - 1
    sent = docs.sparkSession.sparkContext.broadcast(margin.astype(np.float32))

    def one(rows, data, off):
        code, row, vocab = _block_words(data, off)
        word, bucket = word_features(vocab, buckets)
        by_word = np.bincount(word, sent.value[bucket], len(vocab))
        size = np.bincount(word, minlength=len(vocab))
        n = rows.num_rows
        total = np.bincount(row, by_word[code], n) if len(code) else np.zeros(n)
        count = np.bincount(row, size[code], n) if len(code) else np.zeros(n)
        repeats = _repeats(code, row, n)
        total, count = total + repeats * sent.value[buckets], count + repeats
        z = bias + total / np.maximum(count, 1)
        return B.batch_of(schema, rows.column("doc_id"), 1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(B.per_block(one), "doc_id long, score double")
