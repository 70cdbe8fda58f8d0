"""Spelling variants: words one edit apart, found by dense prefix and suffix tiles.

``vocabulary`` counts the words of a text table.  ``neighbours`` finds, for every word, the words
that differ from it by exactly one inserted, deleted or replaced code point.  Two different words
are such a pair just when their common prefix and common suffix together reach the longer length
minus one.  Tasks lay words out as padded code-point matrices, left- and right-aligned, and compare
whole blocks of words with each other column by column.

Only words that can be a pair meet in a block.  For a shorter length ``m``, the pair shares its first
or its last ``m // 2`` code points; what lies between is halved again wherever a block would be large
(more than ``BLOCK_ROWS`` words and ``BLOCK_CELLS`` code points), so that a prefix held by a third of
all words is split by what follows it, until one place is open and the alphabet bounds the block.  A
pair belongs to the first half that holds it, so it is met once and neighbours are counted, not listed.

Texts: null is empty.  A null id reads as an empty text.  Rows with equal ids each count; an empty
table gives no words; words of any length take part.  Only the named columns are read, so others may
have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import stored

MIN_LENGTH, MIN_COUNT, NOISE, RATIO = 7, 2, 31, 10
TEXT_BYTES = 8 << 20
BLOCK_ROWS, BLOCK_CELLS, TILE = 16, 8192, 1 << 21

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def _runs(data: np.ndarray, off: np.ndarray, min_length: int):
    """(row, code, vocabulary) of the runs ``[A-Za-z\\u00C0-\\u00FF]+`` of enough code points."""
    lead = data == 0xC3  # U+00C0 to U+00FF are just the characters that begin with this byte
    member = LETTER[data] | lead
    member[1:] |= lead[:-1]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    start, end = member.copy(), member.copy()
    start[1:] &= ~member[:-1] | cut[1:n]
    end[:-1] &= ~member[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    twos = np.concatenate(([0], np.cumsum(lead)))
    long = (e - s) - (twos[e] - twos[s]) >= min_length
    s, e = s[long], e[long]
    code, words = B.distinct(B.LOWER[data], s, e)
    return np.searchsorted(off, s, "right") - 1, code, words


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               noise: int | None = NOISE) -> DataFrame:
    """``word, n`` of the words of ``docs(doc_id, text)`` that occur often enough.

    Words are runs of letters, A-Z lower-cased.  With ``noise``, a run whose crc32 of
    ``<doc_id>:<run>`` is a multiple of it loses its code point at that crc32 modulo the length."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def one(rows, data, off):
        row, code, words = _runs(data, off, min_length)
        if not len(code):
            return None
        if noise is None:
            n = np.bincount(code, minlength=len(words))
            return B.batch_of(schema, [w.decode() for w in words], n)
        seed = [zlib.crc32(f"{i or ''}:".encode()) for i in rows.column("doc_id").to_pylist()]
        pair, times = np.unique(row * np.int64(len(words)) + code, return_counts=True)
        r, c = pair // len(words), pair % len(words)
        crc = zlib.crc32
        h = np.fromiter((crc(words[j], seed[i]) for i, j in zip(r.tolist(), c.tolist(), strict=True)),
                        np.int64, len(pair))
        hit = h % noise == 0
        n = np.bincount(c[~hit], times[~hit], len(words)).astype(np.int64)
        out = {words[i].decode(): int(n[i]) for i in np.flatnonzero(n).tolist()}
        for j, v, t in zip(c[hit].tolist(), h[hit].tolist(), times[hit].tolist(), strict=True):
            w = words[j].decode()
            k = v % len(w)
            w = w[:k] + w[k + 1:]
            if len(w) >= min_length:
                out[w] = out.get(w, 0) + t
        return B.batch_of(schema, list(out), list(out.values()))

    counted = (docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .where("text IS NOT NULL").mapInArrow(B.per_block(one, max_bytes=TEXT_BYTES), "word string, n long"))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _key():
    """A block's key: both lengths, and the shared code points at either end."""
    return F.xxhash64("m", "p", "s", "below", F.substring("word", F.lit(1), F.col("p")),
                      F.when(F.col("s") > 0, F.expr("right(word, s)")).otherwise(""))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row under the first and under the second half of its block's open places."""
    half = ((F.col("m") - F.col("p") - F.col("s")) / 2).cast("int")
    cut = F.col("p") + half
    sides = F.array(F.struct(cut.alias("p"), F.col("s").alias("s"), F.col("below").alias("below")),
                    F.struct(F.col("p").alias("p"), (F.col("s") + half).alias("s"),
                             F.least("below", cut).alias("below")))
    return (rows.withColumn("side", F.explode(sides))
            .select("word", "n", "m", "side.p", "side.s", "side.below").withColumn("key", _key()))


def _near(words: list[str], group: np.ndarray, m: int, p: np.ndarray, s: np.ndarray, below: np.ndarray):
    """(near words per row, row of the first near word or -1) for rows of whole blocks.

    ``group`` numbers the blocks, rows in order; ``p, s, below`` hold a block's shared lengths per row."""
    n = len(words)
    size = np.fromiter(map(len, words), np.int64, n)
    width = m + 1
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    left, right = np.zeros((n, width), np.uint32), np.zeros((n, width), np.uint32)
    row = np.repeat(np.arange(n), size)
    col = B.ragged(np.zeros(n, np.int64), size)
    left[row, col] = points
    right[row, size[row] - 1 - col] = points
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    count = np.diff(np.append(first, n))
    total, best = np.zeros(n, np.int64), np.full(n, -1)
    for cap in np.unique(1 << np.ceil(np.log2(np.maximum(count, 2))).astype(int)):
        mine = first[(count > cap // 2 if cap > 2 else count == 2) & (count <= cap)]
        many = count[np.searchsorted(first, mine)]
        step = max(1, TILE // (cap * cap))
        for i in range(0, len(mine), step):
            at = mine[i:i + step, None] + np.arange(cap)
            ok = np.arange(cap) < many[i:i + step, None]
            at = np.where(ok, at, 0)
            both = ok[:, :, None] & ok[:, None, :]
            both[:, np.arange(cap), np.arange(cap)] = False
            length = size[at]
            both &= np.minimum(length[:, :, None], length[:, None, :]) == m  # two longer ones meet elsewhere
            run = []
            for table in (left, right):
                alive, reach = both.copy(), np.zeros(both.shape, np.int32)
                cells = table[at]
                for c in range(width):
                    alive &= cells[:, :, None, c] == cells[:, None, :, c]
                    if not alive.any():
                        break
                    reach += alive
                run.append(np.minimum(reach, m))
            prefix, suffix = run
            longer = np.maximum(length[:, :, None], length[:, None, :])
            hit = both & (prefix + suffix >= longer - 1)
            hit &= (prefix >= p[at][:, :, None]) & (prefix < below[at][:, :, None]) & (suffix >= s[at][:, :, None])
            g, a = np.nonzero(ok)
            total[at[g, a]] = hit.sum(2)[g, a]
            best[at[g, a]] = np.where(hit.any(2), np.take_along_axis(at, hit.argmax(2), 1), -1)[g, a]
    return total, best


def _compare(batches):
    """The tiles of sorted rows ``key, m, p, s, below, word, n``; a block may reach over several batches."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()),
                        ("near", pa.string())])

    def done(table: pa.Table):
        col = {c: table.column(c).to_numpy() for c in ("key", "m", "p", "s", "below", "n")}
        words = np.array(table.column("word").to_pylist(), object)
        group = np.cumsum(np.concatenate(([0], (np.diff(col["key"]) != 0) | (np.diff(col["m"]) != 0)
                                          | (np.diff(col["p"]) != 0) | (np.diff(col["s"]) != 0)
                                          | (np.diff(col["below"]) != 0))))
        alone = np.bincount(group)[group] == 1
        for m in np.unique(col["m"]):
            # long words in few rows at a time, cut between blocks
            mine = np.flatnonzero((col["m"] == m) & ~alone)
            if not len(mine):
                continue
            edge = np.flatnonzero(np.concatenate(([True], np.diff(group[mine]) != 0)))
            room = max(1, (1 << 22) // int(m + 1))
            at = 0
            while at < len(edge):
                to = max(at + 1, int(np.searchsorted(edge, edge[at] + room, "right")) - 1)
                rows = mine[edge[at]:edge[to] if to < len(edge) else len(mine)]
                total, best = _near(words[rows].tolist(), group[rows], int(m), *(col[c][rows] for c in ("p", "s", "below")))
                some = np.flatnonzero(total)
                if len(some):
                    yield B.batch_of(schema, words[rows[some]].tolist(), total[some], col["n"][rows[best[some]]],
                                     words[rows[best[some]]].tolist())
                at = to

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 20_000:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = table.column("key").to_numpy()
        last = len(key) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
        if not last:
            continue
        yield from done(table.slice(0, last))
        held, rows = table.slice(last).to_batches(), len(key) - last
    if rows:
        yield from done(pa.Table.from_batches(held).combine_chunks())


def neighbours(spark: SparkSession, vocab: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n`` of the words of ``vocab(word, n)``, distinct and not empty, that
    have near words: how many, and the one of largest ``n`` (ties: smallest in code-point order)."""
    base = scratch_dir(spark, "spelling")
    rows = (vocab.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("m")).where("m > 0")
            .withColumns({"p": F.lit(0), "s": F.lit(0), "below": F.col("m") + 1}))
    parts, rows = [], _halves(rows)
    while True:
        rows = stored(rows, base)
        large = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("m").alias("w"),
                                         F.max(F.col("m") - F.col("p") - F.col("s")).alias("open"))
                 .where((F.col("size") > BLOCK_ROWS) & (F.col("size") * F.col("w") > BLOCK_CELLS) & (F.col("open") > 1))
                 .select("key"))
        large = stored(large, base)
        if large.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(large, "key", "left_anti"))
        rows = _halves(rows.join(large, "key", "left_semi"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    met = (every.repartition("key").sortWithinPartitions("m", "key", F.desc("n"), "word")
           .select("key", "m", "p", "s", "below", "word", "n")
           .mapInArrow(_compare, "word string, n_near long, near_n long, near string"))
    top = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("near"))).alias("top")
    return (met.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
            .select("word", "n_near", "top.near", (-F.col("top.n")).alias("near_n")))


def variants(spark: SparkSession, docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
             noise: int | None = NOISE, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``docs(doc_id, text)``.

    ``form`` is the near word of largest n where that is at least ``ratio`` times the word's own; the
    root is what following forms leads to.  A chain's counts grow by ``ratio`` (2 or more) at each step, so
    the chain is doubled until its counts would be beyond a long."""
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    base = scratch_dir(spark, "spelling")
    vocab = stored(vocabulary(docs, min_length, min_count, noise), base)
    found = vocab.join(neighbours(spark, vocab), "word", "left")
    is_form = F.col("near_n") >= F.lit(ratio) * F.col("n")
    words = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(is_form, F.col("near")).alias("form"),
                                F.when(is_form, F.col("near_n")).alias("form_n")), base)
    jump = words.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = ratio
    while reach < 1 << 62:
        reach *= reach
        nxt = jump.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jump = jump.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        jump = stored(jump, base)
    return (words.join(jump, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
