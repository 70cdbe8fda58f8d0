"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1/-1 components, drawn from its code point.  An n-gram of
letters is the product of its letters' vectors, each rolled by its place; a text is the sum of its
n-gram vectors (white space and other non-letters between words count as one blank letter).  A
language's prototype is the sum of the unit vectors of its training texts; a text is given the
language whose prototype has the largest cosine with it (ties: the smaller name).

``fit`` learns from at most ``per_lang`` texts of each language, those with the smallest hash of
their id; the sums are taken on the executors.  ``predict`` reads whole texts in blocks; the
frequent n-grams of a block are bundled by one matrix product, the rest row by row, so memory
depends on the block alone.

A text that is null or has no letter is ``und`` with score 0, and so is any text if no language
was learned.  The score is the cosine, at least 0.  Rows are judged one by one, so repeated rows
get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import stored

DIM, ORDER, PER_LANG = 1024, 3, 1500
SHARES, MAX_SENT = 64, 250_000
UNKNOWN = "und"
BLOCK_BYTES = 1 << 20
DENSE = 2048  # n-grams of a block that are bundled by a matrix product


@cache
def _letters() -> np.ndarray:
    """The lower-case letter of every code point; 0 for a code point that is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = ord(ch.lower()[0])
    return out


@cache
def letter_vector(code: int, dim: int) -> np.ndarray:
    """The random vector of a letter (0: the blank)."""
    bits = np.random.Generator(np.random.PCG64(0x9E3779B9 + int(code))).integers(0, 2, dim, dtype=np.int8)
    return (bits * 2 - 1).astype(np.float32)


def gram_codes(data: np.ndarray, off: np.ndarray, order: int):
    """(row, n-gram number) of every n-gram, and the letters of each distinct n-gram."""
    n_rows = len(off) - 1
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    row = np.repeat(np.arange(n_rows), np.diff(chars[off]))
    letter = _letters()[points[:len(row)]]
    blank = letter == 0
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    keep = ~blank | (~first & ~np.concatenate([[True], blank[:-1]]))
    letter, row = letter[keep], row[keep]
    has = np.zeros(n_rows, bool)
    has[row[letter > 0]] = True
    alphabet, code = np.unique(letter, return_inverse=True)
    m = len(letter) - order + 1
    empty = np.zeros(0, np.int64)
    if m <= 0:
        return empty, empty, np.zeros((0, order), np.uint32), has
    gram = np.zeros(m, np.int64)
    for j in range(order):
        gram = gram * len(alphabet) + code[j:j + m]
    ok = (row[:m] == row[order - 1:]) & (letter[1:m + 1] > 0)  # not across two words
    gram, at = gram[ok], row[:m][ok]
    size = len(alphabet) ** order
    if size <= 1 << 24:  # number the n-grams through a table rather than by sorting
        seen = np.zeros(size, bool)
        seen[gram] = True
        known = np.flatnonzero(seen)
        number = np.cumsum(seen) - 1
        gram = number[gram]
    else:
        known, gram = np.unique(gram, return_inverse=True)
    places = [alphabet[known // len(alphabet) ** (order - 1 - j) % len(alphabet)] for j in range(order)]
    return at, gram, np.stack(places, 1), has


def gram_vectors(grams: np.ndarray, dim: int) -> np.ndarray:
    """Bound vectors: the product of the letters' vectors, the j-th from the end rolled by j."""
    out = np.ones((len(grams), dim), np.float32)
    order = grams.shape[1]
    for j in range(order):
        letters, at = np.unique(grams[:, j], return_inverse=True)
        rolled = np.stack([np.roll(letter_vector(int(c), dim), order - 1 - j) for c in letters]) \
            if len(letters) else np.zeros((0, dim), np.float32)
        out *= rolled[at]
    return out


def encode(data: np.ndarray, off: np.ndarray, dim: int, order: int):
    """(bundled vectors of the block's texts, whether each has a letter)."""
    n = len(off) - 1
    row, gram, grams, has = gram_codes(data, off, order)
    out = np.zeros((n, dim), np.float32)
    if not len(gram):
        return out, has
    by_use = np.argsort(-np.bincount(gram, minlength=len(grams)), kind="stable")
    rank = np.empty(len(grams), np.int64)
    rank[by_use] = np.arange(len(grams))
    gram = rank[gram]
    top = min(DENSE, len(grams))
    vectors = gram_vectors(grams[by_use[:top]], dim)
    dense = gram < top
    for a in range(0, n, 512):
        b = min(n, a + 512)
        part = dense & (row >= a) & (row < b)
        counts = np.bincount((row[part] - a) * top + gram[part], minlength=(b - a) * top)
        out[a:b] = counts.reshape(b - a, top).astype(np.float32) @ vectors
    rest, times = np.unique(row[~dense] * np.int64(len(grams)) + gram[~dense], return_counts=True)
    for a in range(0, len(rest), 8192):
        part = rest[a:a + 8192]
        which, local = np.unique(part % len(grams), return_inverse=True)
        v = gram_vectors(grams[by_use[which]], dim)[local] * times[a:a + 8192, None].astype(np.float32)
        r = part // len(grams)
        head = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        out[r[head]] += np.add.reduceat(v, head, axis=0)
    return out, has


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


@dataclass
class Profiles:
    """Learned languages and their unit prototypes."""

    langs: list[str]
    prototypes: np.ndarray
    dim: int
    order: int


def fit(docs: DataFrame, per_lang: int = PER_LANG, dim: int = DIM, order: int = ORDER) -> Profiles:
    """Prototypes from ``docs(doc_id, text, lang)``; rows with a null text or lang teach nothing."""
    d = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col("lang").cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    # the smallest hashes of each language: first within shares of it, as one language may hold most rows
    chosen = d.select("doc_id", "lang").withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    for keys in (("lang", "share"), ("lang",)):
        w = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_lang).drop("n")
    chosen = stored(chosen.select("doc_id", "lang").distinct(), scratch_dir(docs.sparkSession, "language"))
    if chosen.count() <= MAX_SENT:  # at most per_lang rows a language; texts need not move then
        chosen = F.broadcast(chosen)

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for rows, data, off in B.blocks(batches, "text", BLOCK_BYTES):
            v, has = encode(data, off, dim, order)
            lang = np.array(rows.column("lang").to_pylist(), object)
            for name in set(lang[has].tolist()):
                total[name] = total.get(name, 0) + _unit(v[has & (lang == name)]).sum(0, dtype=np.float64)
        yield pa.RecordBatch.from_pydict({"lang": list(total), "v": [t.tobytes() for t in total.values()]},
                                         pa.schema([("lang", pa.string()), ("v", pa.binary())]))

    def add(t: pa.Table) -> pa.Table:
        v = np.sum([np.frombuffer(x, np.float64) for x in t.column("v").to_pylist()], axis=0)
        return pa.table({"lang": [t.column("lang")[0].as_py()], "v": [v.tobytes()]},
                        schema=pa.schema([("lang", pa.string()), ("v", pa.binary())]))

    got = (d.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")
           .mapInArrow(sums, "lang string, v binary").groupBy("lang").applyInArrow(add, "lang string, v binary")
           .orderBy("lang").toArrow())
    v = np.array([np.frombuffer(x, np.float64) for x in got["v"].to_pylist()], np.float64).reshape(-1, dim)
    return Profiles(got["lang"].to_pylist(), _unit(v).astype(np.float32), dim, order)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs(doc_id, text)``."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def one(rows, data, off):
        p = sent.value
        if not p.langs:
            return B.batch_of(schema, rows.column("doc_id"), [UNKNOWN] * rows.num_rows, np.zeros(rows.num_rows))
        v, has = encode(data, off, p.dim, p.order)
        cos = _unit(v) @ p.prototypes.T
        best = cos.argmax(1)
        score = np.where(has, np.clip(cos[np.arange(len(best)), best], 0, 1), 0.0)
        return B.batch_of(schema, rows.column("doc_id"),
                          [p.langs[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)], score)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(B.per_block(one, max_bytes=BLOCK_BYTES), "doc_id long, lang_pred string, score double")


def keep_recognised(docs: DataFrame, profiles: Profiles, min_score: float = -1.0) -> DataFrame:
    """``docs``, all columns, without the rows that are rejected: null texts, texts without a letter,
    and texts whose best cosine is below ``min_score``.  By default none goes for its cosine: a text of
    one or two words can have any."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def one(rows, data, off):
        p = sent.value
        v, has = encode(data, off, p.dim, p.order)
        if p.langs:
            has &= (_unit(v) @ p.prototypes.T).max(1) >= min_score
        return rows.filter(pa.array(has))

    return docs.mapInArrow(B.per_block(one, max_bytes=BLOCK_BYTES), docs.schema)
