"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the token postings of every document: one row per block of documents with
the block's distinct terms (sorted 64-bit keys), where each term's postings begin, and the word
positions.  A document lies whole in one block, so lists are intersected inside a block and no
posting is ever shuffled; blocks are the unit that spreads over the cluster.

``phrase_matches`` finds every place where a window (13 consecutive item words; a shorter item is
one window) stands.  The places of a window's rarest term (by its count over the whole corpus) are
shifted by its offset and then intersected with the postings of the other terms in order of
rarity, so a window costs about the length of its rarest list.  ``proximity_matches`` finds
places of an item's rarest term with all its other terms within ``distance`` words.

Items are sent to the blocks by broadcast, in hash groups of at most ``MAX_ITEM_BYTES`` of text.

Words: texts lower-cased in A-Z only, runs of digits, ASCII letters and characters beyond ASCII.
A null or empty text has no words; it is returned with n_words 0 and is never contaminated.  Rows
that repeat a doc_id are indexed and judged one by one.  A null item_id counts as an item without
a name: its hits count, but it is not listed.  Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import free_names, fresh_path, read_back

WINDOW = 13
BLOCK_BYTES = 1 << 20
MAX_ITEM_BYTES = 8 << 20
MAX_CANDIDATES = 1 << 20

INDEX_SCHEMA = ("block long, doc_ids array<long>, doc_first array<int>, terms binary, first binary, "
                "positions binary")
MATCH_SCHEMA = "block long, ord int, doc_id long, item_id string, start int, length int"


def _index(batches):
    """One row per block: documents, their first word numbers, terms and postings."""
    from pyspark import TaskContext
    part, k = TaskContext.get().partitionId(), 0
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_first", pa.list_(pa.int32())),
                        ("terms", pa.binary()), ("first", pa.binary()), ("positions", pa.binary())])
    for rows, data, off in B.blocks(batches, "text", BLOCK_BYTES):
        code, row, vocab = B.words(data, off)
        key = B.hash64(vocab)
        order = np.argsort(key)
        rank = np.empty(len(key), np.int32)
        rank[order] = np.arange(len(key), dtype=np.int32)
        term = rank[code] if len(code) else np.zeros(0, np.int32)
        positions = np.argsort(term, kind="stable").astype(np.uint32)
        first = np.searchsorted(term[positions], np.arange(len(key) + 1)).astype(np.uint32)
        yield B.batch_of(schema, [(part << 33) + k], [rows.column("doc_id").to_pylist()],
                         [B.row_starts(row, rows.num_rows).tolist()],
                         [key[order].tobytes()], [first.tobytes()], [positions.tobytes()])
        k += 1


def build_index(docs: DataFrame, path: str) -> DataFrame:
    """Write the positional index of ``docs(doc_id, text)`` to ``path`` and return it."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d.mapInArrow(_index, INDEX_SCHEMA).write.option("parquet.block.size", 32 << 20).mode("overwrite").parquet(path)
    return read_back(docs.sparkSession, path, INDEX_SCHEMA)


def _words(texts: list) -> list[np.ndarray]:
    """The words of each text as 64-bit keys."""
    data, off = B.flat(pa.array(texts, pa.string()))
    code, row, vocab = B.words(data, off)
    key = B.hash64(vocab)
    at = B.row_starts(row, len(texts))
    return [key[code[at[i]:at[i + 1]]] for i in range(len(texts))]


def _windows(items: list, n: int):
    """(item number, window terms) without repeats; items without words have none."""
    out = {}
    for i, keys in enumerate(_words([t for _, t in items])):
        for s in range(max(1, len(keys) - n + 1) if len(keys) else 0):
            out.setdefault((i, keys[s:s + n].tobytes()), keys[s:s + n])
    return [(i, w) for (i, _), w in out.items()]


def _term_counts(index: DataFrame, wanted) -> dict[int, int]:
    """Corpus counts of the wanted terms, summed over all blocks."""
    def count(batches):
        schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
        keys = wanted.value
        total = np.zeros(len(keys), np.int64)
        for batch in batches:
            for terms, first in zip(batch.column(0), batch.column(1), strict=True):
                t, f = np.frombuffer(terms.as_py(), np.uint64), np.frombuffer(first.as_py(), np.uint32)
                at = np.searchsorted(t, keys)
                ok = np.flatnonzero(at < len(t))
                ok = ok[t[at[ok]] == keys[ok]]
                total[ok] += f[at[ok] + 1].astype(np.int64) - f[at[ok]]
        has = np.flatnonzero(total)
        yield B.batch_of(schema, keys[has].view(np.int64), total[has])
    got = (index.select("terms", "first").mapInArrow(count, "term long, n long")
           .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    return dict(zip(got["term"].to_numpy().view(np.uint64).tolist(), got["n"].to_pylist(), strict=True))


class _Block:
    """Postings of one index row."""

    def __init__(self, doc_first, terms, first, positions):
        self.doc_first = np.asarray(doc_first, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self.first = np.frombuffer(first, np.uint32).astype(np.int64)
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        self.by_place = None

    def lookup(self, keys):
        """Number of each term in this block, -1 where it has none."""
        at = np.searchsorted(self.terms, keys)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == keys, at, -1) if len(self.terms) else np.full(len(keys), -1)

    def postings(self, term):
        """(run number, position) of the postings of the given term numbers."""
        n = self.first[term + 1] - self.first[term]
        return np.repeat(np.arange(len(term)), n), self.positions[B.ragged(self.first[term], n)]

    def holds(self, term, position):
        """Whether ``term`` has a posting at ``position``: a search in its sorted list."""
        lo, hi = self.first[term].copy(), self.first[term + 1].copy()
        end = hi.copy()
        while True:
            live = lo < hi
            if not live.any():
                break
            mid = (lo + hi) // 2
            less = live & (self.positions[np.minimum(mid, len(self.positions) - 1)] < position)
            lo = np.where(less, mid + 1, lo)
            hi = np.where(live & ~less, mid, hi)
        return (lo < end) & (self.positions[np.minimum(lo, len(self.positions) - 1)] == position)

    def next_posting(self, term, position):
        """The first posting of ``term`` at or after ``position`` (a huge number if none)."""
        if self.by_place is None:
            self.by_place = np.repeat(np.arange(len(self.terms)), np.diff(self.first)) << 32 | self.positions
        keys = self.by_place
        at = np.searchsorted(keys, (term << 32) | np.maximum(position, 0))
        found = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] >> 32 == term)
        return np.where(found, self.positions[np.minimum(at, len(keys) - 1)], 1 << 40)

    def doc_of(self, position):
        return np.searchsorted(self.doc_first, position, "right") - 1


def _chunks(block: _Block, local, used):
    """Windows whose terms all occur in the block, in runs with a bounded number of candidate places."""
    alive = np.flatnonzero(((local >= 0) | ~used).all(1))
    if not len(alive):
        return []
    n = np.cumsum(np.diff(block.first)[local[alive, 0]])
    return np.split(alive, np.flatnonzero(np.diff(n // MAX_CANDIDATES)) + 1)


def _phrases(block: _Block, wins):
    """(window number, start) of all places; ``wins``: terms, offsets (rarest first), lengths."""
    terms, offsets, _ = wins
    local = block.lookup(terms.ravel()).reshape(terms.shape)
    used = offsets >= 0
    found = [_phrases_of(block, wins, local, used, alive) for alive in _chunks(block, local, used)]
    return _joined(found)


def _joined(found):
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def _phrases_of(block: _Block, wins, local, used, alive):
    terms, offsets, length = wins
    run, place = block.postings(local[alive, 0])
    win, start = alive[run], place - offsets[alive[run], 0]
    ok = start >= 0
    win, start = win[ok], start[ok]
    for j in range(1, terms.shape[1]):
        need = used[win, j]
        ok = ~need
        ok[need] = block.holds(local[win[need], j], start[need] + offsets[win[need], j])
        win, start = win[ok], start[ok]
    ok = block.doc_of(start) == block.doc_of(start + length[win] - 1)
    return win[ok], start[ok]


def _near(block: _Block, groups, distance: int):
    """(group number, place of the rarest term) with every other term within ``distance`` words."""
    terms, offsets, _ = groups
    local = block.lookup(terms.ravel()).reshape(terms.shape)
    used = offsets >= 0
    return _joined([_near_of(block, groups, distance, local, used, alive)
                    for alive in _chunks(block, local, used)])


def _near_of(block: _Block, groups, distance: int, local, used, alive):
    terms = groups[0]
    run, place = block.postings(local[alive, 0])
    win = alive[run]
    for j in range(1, terms.shape[1]):
        need = used[win, j]
        doc = block.doc_of(place)
        low = np.maximum(place - distance, block.doc_first[doc])
        high = np.minimum(place + distance, block.doc_first[doc + 1] - 1)
        ok = ~need
        ok[need] = block.next_posting(local[win[need], j], low[need]) <= high[need]
        win, place = win[ok], place[ok]
    return win, place


def _tables(wins: list, counts: dict[int, int]):
    """Term and offset tables of windows, each row ordered from the rarest term."""
    width = max(len(w) for _, w in wins)
    terms = np.zeros((len(wins), width), np.uint64)
    offsets = np.full((len(wins), width), -1, np.int64)
    for r, (_, w) in enumerate(wins):
        order = np.argsort([counts.get(int(t), 0) for t in w], kind="stable")
        terms[r, :len(w)], offsets[r, :len(w)] = w[order], order
    return terms, offsets, np.array([len(w) for _, w in wins], np.int64)


def _merge(win, start, item, length, doc):
    """Overlapping or touching places of one item in one document as (item, start, length) intervals."""
    it, ln = item[win], length[win]
    order = np.lexsort((start, it))
    it, s, e, doc = it[order], start[order], (start + ln)[order], doc[order]
    if not len(s):
        return it, s, e
    # running end per item: ends are made increasing over items by a large step
    step = int(e.max()) + 2
    reach = np.maximum.accumulate(e + it * step) - it * step
    new = np.ones(len(s), bool)
    # positions of neighbouring documents have no gap, so places of two documents may touch
    new[1:] = (it[1:] != it[:-1]) | (doc[1:] != doc[:-1]) | (s[1:] > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(s)) - 1
    return it[at], s[at], reach[last] - s[at]


def _item_groups(items: DataFrame):
    """The items in hash groups whose texts hold at most ``MAX_ITEM_BYTES``."""
    it = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = it.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + 2 * size // MAX_ITEM_BYTES
    for g in range(n):
        rows = it.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == g).toArrow()
        yield list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True))


def _search(index: DataFrame, items: DataFrame, cut, find) -> DataFrame:
    spark = index.sparkSession
    sc = spark.sparkContext
    out = None
    for group in _item_groups(items):
        wins = cut(group)
        if not wins:
            continue
        wanted = sc.broadcast(np.unique(np.concatenate([w for _, w in wins])))
        tables = _tables(wins, _term_counts(index, wanted))
        item = np.array([i for i, _ in wins], np.int64)
        sent = sc.broadcast((tables, item, [i for i, _ in group]))

        def run(batches, sent=sent):
            schema = pa.schema([("block", pa.int64()), ("ord", pa.int32()), ("doc_id", pa.int64()),
                                ("item_id", pa.string()), ("start", pa.int32()), ("length", pa.int32())])
            tables, item, names = sent.value
            for batch in batches:
                for r in batch.to_pylist():
                    b = _Block(r["doc_first"], r["terms"], r["first"], r["positions"])
                    it, s, n = find(b, tables, item)
                    doc = b.doc_of(s)
                    yield B.batch_of(schema, np.full(len(s), r["block"]), doc, [r["doc_ids"][d] for d in doc],
                                     [names[i] for i in it], s - b.doc_first[doc], n)

        found = index.mapInArrow(run, MATCH_SCHEMA)
        out = found if out is None else out.unionAll(found)
    return spark.createDataFrame([], MATCH_SCHEMA) if out is None else out


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(block, ord, doc_id, item_id, start, length): stretches of document words that windows of an
    item cover, overlapping or touching places of one item in one document joined."""
    def find(block, tables, item):
        win, start = _phrases(block, tables)
        return _merge(win, start, item, tables[2], block.doc_of(start))
    return _search(index, items, lambda g: _windows(g, window), find)


def proximity_matches(index: DataFrame, items: DataFrame, distance: int) -> DataFrame:
    """(block, ord, doc_id, item_id, start, length 1): places of an item's rarest word with each of
    its other distinct words within ``distance`` words in the same document."""
    def cut(group):
        return [(i, np.unique(k)) for i, k in enumerate(_words([t for _, t in group])) if len(k)]

    def find(block, tables, item):
        win, place = _near(block, tables, distance)
        return item[win], place, np.ones(len(win), np.int64)
    return _search(index, items, cut, find)


def documents_of(index: DataFrame) -> DataFrame:
    """(block, ord, doc_id, n_words) of every indexed document."""
    one = index.select("block", F.posexplode(F.arrays_zip(
        "doc_ids", F.slice("doc_first", 1, F.size("doc_ids")).alias("a"),
        F.slice("doc_first", 2, F.size("doc_ids")).alias("b"))).alias("ord", "d"))
    return one.select("block", "ord", F.col("d.doc_ids").alias("doc_id"),
                      (F.col("d.b") - F.col("d.a")).cast("long").alias("n_words"))


def judge(index: DataFrame, matches: DataFrame, share: int = 20) -> DataFrame:
    """One row per document: words, words inside any match, the items, and whether hits are at
    least one ``share``-th of its words."""
    w = Window.partitionBy("block", "ord").orderBy("start", "length")
    before = F.coalesce(F.max(F.col("start") + F.col("length")).over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = F.col("start") + F.col("length")
    hits = (matches.withColumn("new", F.greatest(F.lit(0), end - F.greatest("start", before)))
            .groupBy("block", "ord").agg(F.sum("new").cast("long").alias("n_hit"),
                                         F.array_sort(F.collect_set("item_id")).alias("items")))
    docs = documents_of(index).join(hits, ["block", "ord"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return docs.select("doc_id", "n_words", n_hit.alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                       ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Index ``docs``, look up every window of ``benchmark`` and judge each document."""
    index = build_index(docs, fresh_path(scratch_dir(spark, "decontam")))
    return judge(index, phrase_matches(index, benchmark))


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs``, all columns, without contaminated rows; rows are told apart by doc_id and text, so
    one that repeats a doc_id with another text is judged by its own text."""
    row = F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    found = decontaminate(spark, docs.select(row.alias("doc_id"), "text"), benchmark)
    name, = free_names(docs, "row")
    gone = found.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, row == F.col(name), "left_anti")
