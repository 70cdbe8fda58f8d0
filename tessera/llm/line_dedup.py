"""Incremental, reversible line deduplication.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; keys of at
least ``min_chars`` code points that stand in at least ``min_docs`` documents are *frequent*.  A
frequent key loses its lines in every document but the one with the largest doc_id holding it.

``LineStore`` keeps, in a shared folder:

* ``refs``: a signed log of references (key, doc_id, text, line numbers); inserting documents
  appends rows with sign +1, deleting them appends the same rows with sign -1;
* ``counts``: the exact reference counts, one row per key: documents and largest doc_id.  A change
  recounts only the touched keys, from the log;
* ``filters``: one cuckoo filter per shard of the key space, holding the frequent keys.  A key
  that crosses the threshold is inserted into its shard's filter, one that falls below it is
  deleted.  A filter that ran full is built anew, larger, from the frequent keys of its shard; when
  the keys outgrow the shards, there are twice as many shards and all filters are built anew.

The filters screen the references inside the tasks that read them, so only those that may be
frequent are joined with the counts, which settle false positives exactly.  They are sent to the
tasks while they hold at most ``MAX_FILTER_BYTES`` together; beyond that the join alone decides.

Keys are 128-bit hashes.  Null or empty texts are one empty line, and a null text stays null in
``dedup``.  A row with a null doc_id is no document: it counts nowhere and keeps its lines.  Rows
sharing a doc_id count once per key; each loses its own lines.  An empty table stores nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import free_names, fresh_path, read_back

MIN_DOCS, MIN_CHARS = 5, 40
SHARD_KEYS = 1_000_000
FILTER_KEYS = SHARD_KEYS // 50  # keys a new filter has room for at least
MAX_FILTER_BYTES = 32 << 20

REFS = "k1 long, k2 long, doc_id long, body long, lines array<int>, sign int"
COUNTS = "k1 long, k2 long, n_docs long, last_doc long"
FILTERS = "shard int, slots binary"
KEY = ["k1", "k2"]


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; each key may lie in one of two buckets.

    All operations take arrays of 128-bit keys as two int64 halves.  ``insert`` returns False when
    the filter is too full (the caller builds a larger one from the exact counts)."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(n, 1) / 4 / 0.8))))
        return cls(np.zeros((buckets, 4), np.uint16))

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, 4).copy())

    def dump(self) -> bytes:
        return self.slots.tobytes()

    def _place(self, k1, k2):
        fp = (k2.view(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)
        fp[fp == 0] = 1
        return fp, (k1.view(np.uint64) >> np.uint64(20)).astype(np.int64) & (len(self.slots) - 1)

    def _other(self, bucket, fp):
        return bucket ^ ((fp.astype(np.int64) * 0x5BD1E995) & (len(self.slots) - 1))

    def contains(self, k1, k2) -> np.ndarray:
        fp, b = self._place(k1, k2)
        return ((self.slots[b] == fp[:, None]) | (self.slots[self._other(b, fp)] == fp[:, None])).any(1)

    def insert(self, k1, k2, rounds: int = 400) -> bool:
        fp, b = self._place(k1, k2)
        rng = np.random.default_rng(7)
        for _ in range(rounds):
            if not len(fp):
                return True
            order = np.argsort(b, kind="stable")
            fp, b = fp[order], b[order]
            first = np.concatenate([[True], b[1:] != b[:-1]])
            rank = np.arange(len(b)) - np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
            nth = np.cumsum(self.slots[b] == 0, axis=1)
            fits = nth[:, 3] > rank
            slot = (nth > rank[:, None]).argmax(1)
            self.slots[b[fits], slot[fits]] = fp[fits]
            fp, b, first = fp[~fits], b[~fits], first[~fits] | (rank[~fits] == 0)
            head = np.flatnonzero(first)  # one fingerprint of each full bucket moves on
            out = rng.integers(0, 4, len(head))
            moved = self.slots[b[head], out].copy()
            self.slots[b[head], out] = fp[head]
            fp[head] = moved
            b = self._other(b, fp)
        return not len(fp)

    def delete(self, k1, k2) -> None:
        fp, b = self._place(k1, k2)
        for f, i in zip(fp, b, strict=True):  # few: keys that fell below the threshold
            for j in (int(i), int(self._other(np.array([i]), np.array([f]))[0])):
                at = np.flatnonzero(self.slots[j] == f)
                if len(at):
                    self.slots[j, at[0]] = 0
                    break


def _line_refs(min_chars: int):
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("body", pa.int64()),
                        ("lines", pa.list_(pa.int32())), ("sign", pa.int32())])

    def one(rows, data, off):
        n = len(data)
        nl = np.flatnonzero(data == 10)
        begin = np.sort(np.concatenate([off[:-1], nl + 1]), kind="stable")
        finish = np.sort(np.concatenate([nl, off[1:]]), kind="stable")
        # the i-th begin and the i-th finish belong to one line: both are sorted and nested in texts
        solid = B.SOLID_BYTE[data]
        at = np.arange(n + 1)
        nxt = np.minimum.accumulate(np.where(np.append(solid, True), at, n)[::-1])[::-1]
        prv = np.maximum.accumulate(np.where(np.append(True, solid), at, 0))
        s = np.minimum(nxt[begin], finish)
        e = np.maximum(prv[finish], s)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long = np.flatnonzero(chars[e] - chars[s] >= min_chars)
        if not len(long):
            return None
        row = np.searchsorted(off, begin[long], "right") - 1
        number = long - (np.searchsorted(nl, off[row]) + row)
        low = B.LOWER[data].tobytes()
        digest = xxhash.xxh3_128_digest
        keys = np.frombuffer(b"".join([digest(low[i:j]) for i, j in zip(s[long].tolist(), e[long].tolist())]),
                             np.int64).reshape(-1, 2)
        order = np.lexsort((number, keys[:, 1], keys[:, 0], row))
        row, number, keys = row[order], number[order], keys[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1]).any(1)
        head = np.flatnonzero(new)
        lines = pa.ListArray.from_arrays(np.append(head, len(row)).astype(np.int32), pa.array(number, pa.int32()))
        take = pa.array(row[head])
        return B.batch_of(schema, keys[head, 0], keys[head, 1], rows.column("doc_id").take(take),
                          rows.column("body").take(take), lines, np.ones(len(head), np.int32))
    return B.per_block(one)


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and long line key: the key, the document, and its line numbers."""
    d = (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
         .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                 F.xxhash64(F.col("text").cast("string")).alias("body")))
    return d.mapInArrow(_line_refs(min_chars), REFS)


class LineStore:
    """References, counts and filters under ``path``; versions are numbered from 1."""

    def __init__(self, spark: SparkSession, path: str, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                 shards: int | None = None):
        self.spark, self.path, self.min_docs, self.min_chars = spark, path.rstrip("/"), min_docs, min_chars
        self.shards, self.version = shards, 0
        self.filters: DataFrame | None = None

    def _at(self, name: str, version: int | None = None) -> str:
        return f"{self.path}/{name}/{self.version if version is None else version:06d}"

    def refs(self) -> DataFrame:
        """The signed log."""
        if not self.version:
            return self.spark.createDataFrame([], REFS)
        return self.spark.read.schema(REFS).parquet(*[self._at("refs", v) for v in range(1, self.version + 1)])

    def live(self) -> DataFrame:
        """References that are still held."""
        if self.version <= 1:
            return self.refs().drop("sign")
        return (self.refs().groupBy(*KEY, "doc_id", "body", "lines").agg(F.sum("sign").alias("sign"))
                .where("sign > 0").drop("sign"))

    def counts(self) -> DataFrame:
        return read_back(self.spark, self._at("counts"), COUNTS) if self.version else \
            self.spark.createDataFrame([], COUNTS)

    def frequent(self) -> DataFrame:
        return self.counts().where(F.col("n_docs") >= self.min_docs)

    def insert(self, docs: DataFrame) -> LineStore:
        return self._change(line_refs(docs, self.min_chars))

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Take back every reference of the given documents (column doc_id)."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        held = (self.refs().join(ids, "doc_id", "left_semi")
                .groupBy(*KEY, "doc_id", "body", "lines").agg(F.sum("sign").alias("n")).where("n > 0"))
        return self._change(held.select(*KEY, "doc_id", "body", "lines", (-F.col("n")).cast("int").alias("sign")))

    def _change(self, refs: DataFrame) -> LineStore:
        old, first = self.counts(), self.version == 0
        refs.write.parquet(self._at("refs", self.version + 1))
        self.version += 1
        if first:
            now = self._count(self.live())
        else:
            touched = read_back(self.spark, self._at("refs"), REFS).select(*KEY).distinct()
            now = self._count(self.live().join(touched, KEY, "left_semi")).unionByName(
                old.join(touched, KEY, "left_anti"))
        now.write.parquet(self._at("counts"))
        self._refresh_filters(old, first)
        return self

    @staticmethod
    def _count(live: DataFrame) -> DataFrame:
        return live.groupBy(*KEY).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc"))

    def _refresh_filters(self, old: DataFrame, first: bool) -> None:
        needed = -(-self.counts().count() // SHARD_KEYS)
        if self.shards is None:
            self.shards = max(16, needed)
        elif not first and needed > self.shards:
            self.shards, first = 2 * needed, True
        now, before = self.frequent().select(*KEY), old.where(F.col("n_docs") >= self.min_docs).select(*KEY)
        if first:
            change = now.withColumn("add", F.lit(True))
        else:
            change = (now.join(before, KEY, "left_anti").withColumn("add", F.lit(True))
                      .unionByName(before.join(now, KEY, "left_anti").withColumn("add", F.lit(False))))
        shard_of = F.pmod("k1", F.lit(self.shards)).cast("int")
        change = change.withColumn("shard", shard_of)
        size = max(1, FILTER_KEYS)
        schema = pa.schema([("shard", pa.int32()), ("slots", pa.binary())])

        def update(keys: pa.Table, filters: pa.Table | None) -> pa.Table:
            kept = filters is not None and len(filters) > 0
            shard = (keys if len(keys) else filters).column("shard")[0].as_py()
            blob = filters.column("slots")[0].as_py() if kept else None
            if kept and not blob:  # full before: what it held is not known here
                return pa.table([[shard], [b""]], schema=schema)
            f = CuckooFilter.load(blob) if kept else CuckooFilter.for_keys(max(size, len(keys) * 2))
            k = np.stack([keys.column(c).to_numpy().astype(np.int64) for c in KEY], 1)
            add = keys.column("add").to_numpy(zero_copy_only=False).astype(bool) if len(keys) else np.zeros(0, bool)
            f.delete(k[~add, 0].copy(), k[~add, 1].copy())
            full = not f.insert(k[add, 0].copy(), k[add, 1].copy())
            return pa.table([[shard], [b"" if full else f.dump()]], schema=schema)

        def build(keys: pa.Table) -> pa.Table:
            k = np.stack([keys.column(c).to_numpy().astype(np.int64) for c in KEY], 1)
            blob = b""
            for times in (2, 4, 8, 16):
                f = CuckooFilter.for_keys(max(size, len(k) * times))
                if f.insert(k[:, 0].copy(), k[:, 1].copy()):
                    blob = f.dump()
                    break
            # an empty blob stands for "all keys may be there": the counts alone decide
            return pa.table([[keys.column("shard")[0].as_py()], [blob]], schema=schema)

        if first:
            out = change.groupBy("shard").applyInArrow(lambda t: update(t, None), FILTERS)
        else:
            out = change.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(update, FILTERS)
        out.write.parquet(self._at("filters"))
        self.filters = read_back(self.spark, self._at("filters"), FILTERS)
        full = [r["shard"] for r in self.filters.where(F.length("slots") == 0).select("shard").collect()]
        if full:
            keys = now.withColumn("shard", shard_of).where(F.col("shard").isin(full))
            larger = keys.groupBy("shard").applyInArrow(build, FILTERS)
            self.filters.where(F.length("slots") > 0).unionByName(larger).write.parquet(self._at("filters_larger"))
            self.filters = read_back(self.spark, self._at("filters_larger"), FILTERS)

    def _screened(self, refs: DataFrame) -> DataFrame:
        """References whose key may be frequent, by the filters."""
        if self.filters.agg(F.sum(F.length("slots"))).first()[0] is None:
            return refs.where(F.lit(False))
        if self.filters.agg(F.sum(F.length("slots"))).first()[0] > MAX_FILTER_BYTES:
            return refs
        sent = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["slots"]) for r in self.filters.toLocalIterator()})
        shards = self.shards

        def screen(batches):
            filters = {s: CuckooFilter.load(b) if b else None for s, b in sent.value.items()}
            for batch in batches:
                k1, k2 = (batch.column(c).to_numpy().astype(np.int64) for c in KEY)
                shard, keep = np.mod(k1, shards), np.zeros(len(k1), bool)
                for s in np.unique(shard):
                    if int(s) in filters:
                        at = np.flatnonzero(shard == s)
                        f = filters[int(s)]
                        keep[at] = True if f is None else f.contains(k1[at], k2[at])
                yield batch.filter(pa.array(keep))
        return refs.mapInArrow(screen, refs.schema)

    def dropped(self) -> DataFrame:
        """(doc_id, body, lines): the line numbers each stored document loses."""
        hit = self._screened(self.live()).join(self.frequent(), KEY).where("doc_id <> last_doc")
        return hit.groupBy("doc_id", "body").agg(F.flatten(F.collect_set("lines")).alias("lines"))

    def dedup(self, docs: DataFrame, lines: bool = False) -> DataFrame:
        """``docs`` with the lines of frequent keys taken out of ``text``; with ``lines``, also
        ``n_lines`` (before) and ``n_dropped``, in place of columns that have these names."""
        doc, body, gone_lines, parts = free_names(docs, "doc", "body", "lines", "parts")
        gone = self.dropped().select(F.col("doc_id").alias(doc), F.col("body").alias(body),
                                     F.col("lines").alias(gone_lines))
        text = F.col("text").cast("string")
        j = docs.join(gone.hint("shuffle_hash"), (F.col("doc_id") == F.col(doc)) &
                      (F.xxhash64(text) == F.col(body)), "left")
        j = j.withColumn(parts, F.when(F.col(gone_lines).isNotNull(), F.split(text, "\n", -1)))
        # the numbers of the lines that stay, by a hash set: in proportion to the lines
        rest = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone_lines)
        kept = F.when(F.col(gone_lines).isNull(), text).otherwise(
            F.array_join(F.transform(rest, lambda i: F.get(parts, i)), "\n"))
        counts = ("n_lines", "n_dropped") if lines else ()
        cols = [kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c.lower() not in counts]
        if lines:
            cols += [(1 + F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))), F.lit(0)))
                     .cast("long").alias("n_lines"),
                     F.coalesce(F.size(gone_lines), F.lit(0)).cast("long").alias("n_dropped")]
        return j.select(*cols)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                lines: bool = False) -> DataFrame:
    """Insert all of ``docs`` into a new store and take out the lines it finds frequent."""
    store = LineStore(spark, fresh_path(scratch_dir(spark, "lines")), min_docs, min_chars)
    return store.insert(docs).dedup(docs, lines)
