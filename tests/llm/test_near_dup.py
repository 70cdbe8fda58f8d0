import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import blocks as B
from tessera.llm import near_dup as N

from .conftest import SF, words


def weights(texts):
    data, off = B.flat(pa.array(texts, pa.string()))
    _, first, h, c = N.shingles(data, off)
    df = np.bincount(N._df_bucket(h), minlength=N.DF_BUCKETS)
    n = len(texts)
    idf = 1 + np.log((1 + n) / (1 + np.minimum(df, n))) / np.log(1 + n)
    return [dict(zip(h[a:b].tolist(), (idf[N._df_bucket(h[a:b])] * c[a:b]).tolist(), strict=True))
            for a, b in zip(first, first[1:], strict=False)]


def brute_groups(rows):
    """{doc_id: group} by comparing all pairs of texts."""
    w = weights([t for _, t in rows])
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            shared = sum(min(v, w[j][s]) for s, v in w[i].items() if s in w[j])
            both = sum(w[i].values()) + sum(w[j].values()) - shared
            if rows[i][1] == rows[j][1] or both and shared / both >= 0.8 or \
                    words(rows[i][1]) and words(rows[i][1]) == words(rows[j][1]):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: least[root(i)] for i, (d, _) in enumerate(rows)}


def test_same_groups_as_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["group_id"] for r in N.near_duplicates(spark, docs).collect()}
    assert got == brute_groups(rows)


@pytest.mark.parametrize("tile", [256, 9])
def test_crowd_of_near_copies(spark, monkeypatch, tile):
    """Copies with few and with many edits of one text: groups as by all pairs, in one tile and in many."""
    monkeypatch.setattr(N, "TILE_TEXTS", tile)
    rng = np.random.default_rng(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(160):
        t = list(base)
        for p in rng.integers(0, 120, rng.integers(0, 7)):
            t[p] = f"e{rng.integers(0, 10_000)}"
        rows.append((d, " ".join(t)))
    rows += [(200 + d, rows[3][1].upper()) for d in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["group_id"] for r in N.near_duplicates(spark, df).collect()}
    assert got == brute_groups(rows)


def test_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows + [(12, "", "en"), (13, "!!! --- ???", "en")])
    out = N.near_duplicates(spark, docs).collect()
    assert len(out) == len(odd_rows) + 2
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], set()).add((r["class_id"], r["group_id"]))
    assert got[1] == {(None, None)} and got[None] == {(None, None)}
    assert got[12] == {(2, 2)} and got[13] == {(4, 4)}  # texts without words: equal texts
    assert got[6] == {(5, 5)} and (5, 5) in got[5] and got[11] == {(11, 5)}
    kept = N.keep_first(spark, docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert left.count(5) == 3 and not {6, 11, 12, 13} & set(left) and {1, 2, 4, 7, 8, None} <= set(left)
    assert N.near_duplicates(spark, make_docs([])).count() == 0


def test_samples_agree_as_often_as_texts_are_alike():
    a = " ".join(f"a{i}" for i in range(400))
    b = " ".join(f"a{i}" for i in range(40, 440))
    data, off = B.flat(pa.array([a, b]))
    _, first, h, _ = N.shingles(data, off)
    w = np.ones(len(h))
    w[: len(h) // 3] = 3.0
    s = N.samples(first, h, w)
    one, two = (dict(zip(h[x:y].tolist(), w[x:y].tolist(), strict=True)) for x, y in zip(first, first[1:], strict=False))
    shared = sum(min(v, two.get(k, 0)) for k, v in one.items())
    true = shared / (sum(one.values()) + sum(two.values()) - shared)
    assert abs((s[0] == s[1]).mean() - true) < 0.2


def test_tiles_find_the_links_of_all_pairs(monkeypatch):
    """Repeated shingles, empty overlap, similarity just at the threshold; columns in several chunks."""
    monkeypatch.setattr(N, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    idf = rng.uniform(1, 2, N.DF_BUCKETS).astype(np.float32)
    texts = []
    for i in range(40):
        h = rng.integers(0, 30, rng.integers(1, 40)).astype(np.uint64) * np.uint64(1 << 40) + np.uint64(7)
        texts.append({"key": bytes([i]), "label": bytes([i]), "words": np.sort(h).tobytes()})
    texts += [{**t, "key": bytes([100 + i]), "label": bytes([100 + i])} for i, t in enumerate(texts[:5])]
    for threshold in (0.2, 0.5, 0.8, 1.0):
        for a, b in ((texts, None), (texts[:20], texts[20:])):
            x, y = N._Tile(pa.array(a), idf), N._Tile(pa.array(b), idf) if b else None
            z = y or x
            want = {(x.key[i], z.key[j]) for i in range(len(x.key)) for j in range(len(z.key))
                    if x.key[i] != z.key[j] and N.similarity(x.text(i), z.text(j)) >= threshold}
            got = list(N._links(x, y, threshold))
            assert set(got) <= want and len(got) < len(x.key) + len(z.key)
            assert joined(got) == joined(want)


def joined(links):
    of = {}
    for a, b in links:
        p, q = of.setdefault(a, {a}), of.setdefault(b, {b})
        if p is not q:
            p |= q
            for k in q:
                of[k] = p
    return {frozenset(v) for v in of.values()}
