"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles are its runs of ``SHINGLE`` words (a shorter text is one shingle); a shingle
weighs its count in the text times its inverse document frequency.  Document frequencies are
counted over all documents in ``DF_BUCKETS`` hashed buckets, as Spark's HashingTF and IDF do, so
their table has a fixed size.  ``BANDS * ROWS`` consistent weighted samples of a text agree with
those of another with a probability equal to the two texts' weighted Jaccard similarity; texts
that agree in all rows of a band share a bucket.  Pairs from buckets are verified on their whole
texts: a link is a weighted Jaccard similarity of at least ``THRESHOLD``.

Texts with the same words in the same order form a *class* (texts without any word: equal texts);
only one text of each class is sampled and compared, so copies make no pairs.  A *group* is a
connected component of classes over links.  Every text of a bucket is first compared with the
bucket's first.  Buckets whose texts still lie in several groups are then cut into tiles of bounded
size, and a task compares all texts of two tiles by one matrix product over the shingles they share;
of the links it finds it returns those that join groups.  So no pair of a bucket is left out and none
is a row: a crowd of texts that are alike but below the threshold costs arithmetic, not data.

At similarity 0.8 a pair shares no bucket with probability (1 - 0.8 ** 4) ** 16 = 0.0002; nothing else
is passed over.

Rows with a null doc_id or a null text take no part: they are returned with a null class and
group.  Rows that repeat a doc_id with another text count by their own text; repeated rows get
equal results.  Empty tables give empty results.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import blocks as B
from .shared import free_names, fresh_path, read_back, stored

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 16, 4
TILE_TEXTS, TILE_WORDS, COLUMNS = 256, 1 << 18, 4096
DF_BUCKETS, DF_CHUNK = 1 << 20, 1 << 12
TABLE_BITS = 16
BLOCK_BYTES = 1 << 20

KEYS = "doc_id long, body long, key binary"
PARTS = KEYS + ", chunk int, counts binary"
SIGNATURES = "key binary, buckets array<long>"


def _mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(data: np.ndarray, off: np.ndarray, size: int = SHINGLE):
    """Per text: a 16-byte key of its word sequence, and its shingles' hashes with their counts.

    Returns (keys, first, hashes, counts): the shingles of text i are first[i]:first[i + 1], in
    ascending order of their hash."""
    code, row, vocab = B.words(data, off)
    n = len(off) - 1
    at = B.row_starts(row, n)
    word = B.hash64(vocab, 3)[code] if len(code) else np.zeros(0, np.uint64)
    h = np.zeros(len(word), np.uint64)
    for j in range(size):  # a text's last words make no run of their own unless it is short
        h[:len(word) - j] = h[:len(word) - j] * np.uint64(0x9E3779B97F4A7C15) + word[j:]
    keys, parts, counts, first = [], [], [], np.zeros(n + 1, np.int64)
    digest = xxhash.xxh3_128_digest
    for i in range(n):
        a, b = at[i], at[i + 1]
        if a == b:
            keys.append(digest(data[off[i]:off[i + 1]].tobytes(), 1))
            continue
        own = word[a:b].tobytes()
        keys.append(digest(own, 0))
        s = np.sort(h[a:b - size + 1]) if b - a >= size else np.array([xxhash.xxh3_64_intdigest(own, 5)], np.uint64)
        new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        parts.append(s[new])
        counts.append(np.diff(np.append(new, len(s))))
        first[i + 1] = len(new)
    np.cumsum(first, out=first)
    if not parts:
        return keys, first, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return keys, first, _mix(np.concatenate(parts)), np.concatenate(counts)


def _df_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(DF_BUCKETS - 1)).astype(np.int64)


def _keys_and_counts(batches):
    """(doc_id, body, key) of every row and, at the end, the partition's bucket counts in chunks."""
    schema = pa.schema([("doc_id", pa.int64()), ("body", pa.int64()), ("key", pa.binary()), ("chunk", pa.int32()),
                        ("counts", pa.binary())])
    total = np.zeros(DF_BUCKETS, np.int64)
    for rows, data, off in B.blocks(batches, "text", BLOCK_BYTES):
        keys, _, hashes, _ = shingles(data, off)
        total += np.bincount(_df_bucket(hashes), minlength=DF_BUCKETS)
        none = [None] * rows.num_rows
        yield B.batch_of(schema, rows.column("doc_id"), rows.column("body"), keys, none, none)
    chunks = total.reshape(-1, DF_CHUNK)
    has = np.flatnonzero(chunks.any(1))
    none = [None] * len(has)
    yield B.batch_of(schema, none, none, none, has, [chunks[c].astype(np.uint32).tobytes() for c in has])


def _add_counts(batches):
    """The sum of the counts of each chunk, over all rows of the partition as they stream by."""
    schema = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for c, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[c] = total.get(c, 0) + np.frombuffer(blob.as_buffer(), np.uint32).astype(np.int64)
    yield B.batch_of(schema, list(total), [t.tobytes() for t in total.values()])


def document_weights(parts: DataFrame) -> np.ndarray:
    """The inverse document frequency of every bucket, 1 + ln((1 + n) / (1 + df)) / ln(1 + n): from 1
    (in all documents) to 2, so that a shingle of a large group of copies still counts for them."""
    n = parts.where("key IS NOT NULL").count()
    chunks = (parts.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
              .mapInArrow(_add_counts, "chunk int, counts binary").toArrow())
    df = np.zeros((DF_BUCKETS // DF_CHUNK, DF_CHUNK), np.int64)
    for c, blob in zip(chunks["chunk"].to_pylist(), chunks["counts"].to_pylist(), strict=True):
        df[c] = np.frombuffer(blob, np.int64)
    # several shingles of a text may share a bucket, so a count can pass the number of documents
    return (1 + np.log((1 + n) / (1 + np.minimum(df.ravel(), n))) / np.log(1 + max(n, 1))).astype(np.float32)


@cache
def _draws():
    """Random draws of the sampling, by ``TABLE_BITS`` bits of a shingle's hash: 1/r, r, beta, ln(c) - r
    with r and c from Gamma(2, 1) and beta uniform; and one odd multiplier for each sample."""
    rng = np.random.Generator(np.random.PCG64(20))
    r, c = rng.gamma(2, 1, (2, 1 << TABLE_BITS))
    r = np.maximum(r, 1e-3)
    beta = rng.random(1 << TABLE_BITS)
    factors = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return *(x.astype(np.float32) for x in (1 / r, r, beta, np.log(c) - r)), factors


def samples(first: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Consistent weighted samples: a 64-bit number per text (with shingles) and sample."""
    inverse, r, beta, base, factors = _draws()
    n = len(first) - 1
    log_w = np.log(weights).astype(np.float32)
    size = np.diff(first)
    owner = np.repeat(np.arange(n), size)
    out = np.empty((n, len(factors)), np.uint64)
    shift = np.uint64(64 - TABLE_BITS)
    for j, factor in enumerate(factors):
        at = ((hashes * factor) >> shift).astype(np.int32)
        b = beta[at]
        t = np.floor(log_w * inverse[at] + b)
        a = base[at] - r[at] * (t - b)
        best = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, first[:-1]), size))
        mine = owner[best]
        best = best[np.concatenate([[True], mine[1:] != mine[:-1]])]  # ties: the smallest hash
        out[:, j] = hashes[best] + t[best].astype(np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return _mix(out)


def _signatures(idf):
    schema = pa.schema([("key", pa.binary()), ("buckets", pa.list_(pa.int64()))])
    salt = (np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407)

    def one(rows, data, off):
        keys, first, hashes, counts = shingles(data, off)
        by_key = {k: i for i, k in enumerate(keys) if first[i + 1] > first[i]}  # copies in a block: once
        if not by_key:
            return None
        keep = np.array(sorted(by_key.values()))
        pick = B.ragged(first[keep], np.diff(first)[keep])
        first = np.concatenate([[0], np.cumsum(np.diff(first)[keep])])
        w = idf.value[_df_bucket(hashes[pick])] * counts[pick]
        s = samples(first, hashes[pick], w)
        h = np.broadcast_to(salt, (len(keep), BANDS)).copy()
        for j in range(ROWS):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + s[:, j::ROWS])
        return B.batch_of(
            schema, [keys[i] for i in keep],
            pa.ListArray.from_arrays(np.arange(0, h.size + 1, BANDS, dtype=np.int32),
                                     pa.array(h.view(np.int64).ravel())))
    return B.per_block(one, max_bytes=BLOCK_BYTES)


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two texts' (hashes, weights)."""
    ha, wa = a
    hb, wb = b
    at = np.searchsorted(hb, ha)
    at[at == len(hb)] = 0
    same = hb[at] == ha if len(hb) else np.zeros(len(ha), bool)
    shared = np.minimum(wa[same], wb[at[same]]).sum()
    both = wa.sum() + wb.sum() - shared
    return float(shared / both) if both > 0 else 0.0


def _verify(idf):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def texts(batch, name):
        data, off = B.flat(batch.column(name))
        _, first, hashes, counts = shingles(data, off)
        w = idf.value[_df_bucket(hashes)].astype(np.float64) * counts
        for i in range(batch.num_rows):
            h, v = hashes[first[i]:first[i + 1]], w[first[i]:first[i + 1]]
            order = np.argsort(h)
            yield h[order], v[order]

    def run(batches):
        for rows, _, _ in B.blocks(batches, "text_b", BLOCK_BYTES):
            sims = [similarity(x, y) for x, y in zip(texts(rows, "text_a"), texts(rows, "text_b"), strict=True)]
            yield B.batch_of(schema, rows.column("a"), rows.column("b"), sims)
    return run


def components(links: DataFrame, base: str) -> DataFrame:
    """(key, label): the smallest key of each component of ``links(a, b)``.

    Every round each key takes the smallest label around it, and then the label of that label;
    rounds are written to ``base`` until none changes."""
    spark = links.sparkSession
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                   base)
    labels = stored(edges.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("m"))
                    .select("key", F.least("key", "m").alias("label")), base)
    while True:
        around = (edges.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key"))
                  .agg(F.min("label").alias("near")))
        step = (labels.join(around, "key").select("key", F.col("label").alias("old"),
                                                  F.least("label", "near").alias("mid")))
        up = labels.select(F.col("key").alias("mid"), F.col("label").alias("top"))
        new = stored(step.join(up, "mid", "left")
                     .select("key", F.least("mid", F.coalesce("top", "mid")).alias("label"), "old"), base)
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("key", "label")
        if not changed:
            return labels


def _joined(labels: DataFrame, links: DataFrame, base: str) -> DataFrame:
    """``labels`` after new links: only the distinct pairs of labels that they join are followed."""
    of = lambda c: labels.select(F.col("key").alias(c), F.col("label").alias(f"label_{c}"))
    pairs = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
             .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
             .where("a <> b").distinct())
    merged = components(pairs, base).select(F.col("key").alias("label"), F.col("label").alias("top"))
    alone = merged.select(F.col("label").alias("key"), "label").join(labels, "key", "left_anti")
    return stored(labels.unionByName(alone).join(merged, "label", "left")
                  .select("key", F.coalesce("top", "label").alias("label")), base)


def _texts(keys: DataFrame, docs: DataFrame, reps: DataFrame, base: str) -> DataFrame:
    """``key, text``: one whole text of each class."""
    ids = reps.join(keys, "key", "left_semi").select("key", "doc_id", "body")
    return stored(docs.join(ids, ["doc_id", "body"]).select("key", "text"), base)


def _checked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, idf, base: str) -> DataFrame:
    """``a, b, similarity`` of every pair of keys, computed on one whole text of each class."""
    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    texts = _texts(wanted, docs, reps, base)
    both = (pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))
    return stored(both.mapInArrow(_verify(idf), "a binary, b binary, similarity double"), base)


def _words(batches):
    """``key, n, words`` of texts: their shingles' hashes, each as often as it occurs, in order."""
    schema = pa.schema([("key", pa.binary()), ("n", pa.int64()), ("words", pa.binary())])
    for rows, data, off in B.blocks(batches, "text", BLOCK_BYTES):
        _, first, hashes, counts = shingles(data, off)
        blobs = []
        for i in range(rows.num_rows):
            h = np.repeat(hashes[first[i]:first[i + 1]], counts[first[i]:first[i + 1]])
            blobs.append(np.sort(h))
        yield B.batch_of(schema, rows.column("key"), [len(h) for h in blobs], [h.tobytes() for h in blobs])


class _Tile:
    """Texts of one tile: their shingles with the weights; the k-th occurrence in a text counts as its own."""

    def __init__(self, texts: pa.StructArray, idf: np.ndarray):
        self.key, self.label = texts.field("key").to_pylist(), texts.field("label").to_pylist()
        parts = [np.frombuffer(w.as_buffer(), np.uint64) for w in texts.field("words")]
        size = np.array([len(w) for w in parts])
        self.row = np.repeat(np.arange(len(parts)), size)
        self.hash = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        n = len(self.hash)
        new = np.ones(n, bool)
        new[1:] = (self.hash[1:] != self.hash[:-1]) | (self.row[1:] != self.row[:-1])
        nth = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.feature = _mix(self.hash + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.weight = idf[_df_bucket(self.hash)].astype(np.float64)
        self.total = np.bincount(self.row, self.weight, len(parts))

    def text(self, i: int):
        """(hashes, weights) of one text, as ``similarity`` takes them."""
        mine = self.row == i
        h, at = np.unique(self.hash[mine], return_inverse=True)
        return h, np.bincount(at, self.weight[mine], len(h))


def _links(x: _Tile, y: _Tile | None, threshold: float):
    """(a, b) of links between texts of different groups, as many as join all that links would join."""
    other = x if y is None else y
    if len(set(x.label) | set(other.label)) < 2:
        return
    features = np.concatenate([x.feature, other.feature]) if y is not None else x.feature
    found, at = np.unique(features, return_inverse=True)
    n = len(x.feature)
    left = np.bincount(at[:n], minlength=len(found))
    shared = (left > 0) & (np.bincount(at[n:], minlength=len(found)) > 0) if y is not None else left > 1
    place = np.cumsum(shared) - 1
    both = np.zeros((len(x.key), len(other.key)))
    sides = [(t, np.flatnonzero(shared[c]), c) for t, c in ((x, at[:n]), (other, at[n:] if y is not None else at))]
    sides = [(t, k[np.argsort(place[c[k]], kind="stable")], c) for t, k, c in sides]
    for start in range(0, int(shared.sum()), COLUMNS):
        m = []
        for t, k, c in sides:
            column = place[c[k]]
            k = k[np.searchsorted(column, start):np.searchsorted(column, start + COLUMNS)]
            part = np.zeros((len(t.key), COLUMNS))
            part[t.row[k], place[c[k]] - start] = t.weight[k] if not m else 1.0
            m.append(part)
        both += m[0] @ m[1].T
    union = x.total[:, None] + other.total[None, :] - both
    alike = both / np.where(union > 0, union, 1)
    names = {v: i for i, v in enumerate(dict.fromkeys(x.label + other.label))}
    lx, ly = (np.array([names[v] for v in t.label]) for t in (x, other))
    group = list(range(len(names)))

    def top(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i
    for i, j in zip(*np.nonzero((alike >= threshold - 1e-9) & (lx[:, None] != ly[None, :])), strict=True):
        p, q = top(lx[i]), top(ly[j])
        if p == q or (alike[i, j] < threshold + 1e-9 and similarity(x.text(i), other.text(j)) < threshold):
            continue
        group[max(p, q)] = min(p, q)
        yield x.key[i], other.key[j]


def _tile_links(idf, threshold: float):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches):
        for batch in batches:
            got = []
            for i in range(batch.num_rows):
                x, y = (batch.column(c).slice(i, 1) for c in ("texts", "others"))
                tiles = [_Tile(t.flatten(), idf.value) if t[0].is_valid else None for t in (x, y)]
                got += _links(*tiles, threshold)
            if got:
                yield B.batch_of(schema, *map(list, zip(*got, strict=True)))
    return run


def _between(shared: DataFrame, labels: DataFrame, docs: DataFrame, reps: DataFrame, idf, threshold: float,
             base: str) -> DataFrame:
    """``a, b``: links that join the groups in each bucket whose texts lie in several."""
    grouped = shared.join(labels, "key", "left").select("bucket", "key", F.coalesce("label", "key").alias("label"))
    several = (grouped.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"),
                                             F.count("*").alias("n")).where("lo <> hi AND n > 2").select("bucket"))
    mixed = stored(grouped.join(several, "bucket"), base)
    texts = _texts(mixed.select("key").distinct(), docs, reps, base).dropDuplicates(["key"])
    words = stored(texts.mapInArrow(_words, "key binary, n long, words binary"), base)
    mixed = mixed.join(words.select("key", "n"), "key")
    tiles = mixed.groupBy("bucket").agg(F.greatest(F.ceil(F.count("*") / TILE_TEXTS),
                                                   F.ceil(F.sum("n") / TILE_WORDS)).cast("int").alias("tiles"))
    # the hash deals a bucket's texts evenly over its tiles
    dealt = (mixed.join(tiles, "bucket").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
             .join(words.select("key", "words"), "key")
             .groupBy("bucket", "tiles", "tile").agg(F.collect_list(F.struct("key", "label", "words")).alias("texts")))
    dealt = stored(dealt, base)
    kind = dealt.schema["texts"].dataType
    alone = dealt.select("texts", F.lit(None).cast(kind).alias("others"))
    x = (dealt.where("tile < tiles - 1").withColumn("other", F.explode(F.expr("sequence(tile + 1, tiles - 1)"))))
    y = (dealt.where("tile > 0").withColumn("first", F.explode(F.expr("sequence(0, tile - 1)")))
         .select("bucket", F.col("first").alias("tile"), F.col("tile").alias("other"), F.col("texts").alias("others")))
    crossed = x.join(y, ["bucket", "tile", "other"]).select("texts", "others")
    return stored(alone.unionByName(crossed).mapInArrow(_tile_links(idf, threshold), "a binary, b binary").distinct(), base)


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, body, class_id, group_id`` for every row of ``docs(doc_id, text)``.

    body: xxhash64 of the text; class_id: the smallest doc_id with the same words; group_id: the
    smallest doc_id of the component."""
    base = scratch_dir(spark, "near_dup")
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("body"))
    whole = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    path = fresh_path(base)
    whole.mapInArrow(_keys_and_counts, PARTS).write.parquet(path)
    parts = read_back(spark, path, PARTS)
    idf = spark.sparkContext.broadcast(document_weights(parts))
    members = parts.where("key IS NOT NULL").select("doc_id", "body", "key")
    reps = stored(members.groupBy("key").agg(F.min(F.struct("doc_id", "body")).alias("r"))
                  .select("key", "r.doc_id", "r.body"), base)

    signed = stored(whole.select("text").mapInArrow(_signatures(idf), SIGNATURES)
                    .groupBy("key").agg(F.first("buckets").alias("buckets")), base)
    held = signed.select(F.explode("buckets").alias("bucket"), "key")
    shared = held.groupBy("bucket").agg(F.min("key").alias("a"), F.count("*").alias("n")).where("n > 1")
    shared = stored(held.join(shared.drop("n"), "bucket"), base)  # bucket, key, a: its first key

    star = stored(shared.where("key <> a").select("a", F.col("key").alias("b")).distinct(), base)
    checked = _checked(star, whole, reps, idf, base)
    links = checked.where(F.col("similarity") >= threshold)
    labels = components(links, base)

    more = _between(shared, labels, whole, reps, idf, threshold, base)
    if more.limit(1).count():
        labels = _joined(labels, more, base)

    groups = reps.join(labels, "key", "left").select("key", "doc_id", F.coalesce("label", "key").alias("label"))
    smallest = groups.groupBy("label").agg(F.min("doc_id").alias("group_id"))
    classes = stored(groups.join(smallest, "label").select("key", F.col("doc_id").alias("class_id"), "group_id"), base)
    found = members.join(classes, "key").select("doc_id", "body", "class_id", "group_id")
    none = F.lit(None).cast("long")
    alone = (docs.where("doc_id IS NULL OR text IS NULL")
             .select("doc_id", "body", none.alias("class_id"), none.alias("group_id")))
    return found.unionByName(alone)


def keep_first(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id.  Rows that take no
    part (null doc_id or text) stay, and so do all rows that repeat a kept document."""
    doc, body = free_names(docs, "doc", "body")
    gone = (near_duplicates(spark, docs, threshold).where("doc_id <> group_id")
            .select(F.col("doc_id").alias(doc), F.col("body").alias(body)).distinct())
    match = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64(F.col("text").cast("string")) == F.col(body))
    return docs.join(gone, match, "left_anti")
