import hashlib

import numpy as np
import pytest

from tessera.llm import decontam, language_id, license_scan, line_dedup, quality, toxicity

from .conftest import crc, words


def by_id(rows, *cols):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], set()).add(tuple(tuple(r[c]) if isinstance(r[c], list) else r[c] for c in cols))
    return out


# line dedup

def brute_lines(rows, min_docs=5, min_chars=40):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(d)
    last = {k: max(v) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or last.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_rows(n=9):
    common, other = "this line stands in very many documents, again and again", "é" * 40
    rows = [(i, f"own {i}\n  {common.upper() if i % 2 else common}\t\n{common}\nshort\n{other}\n") for i in range(n)]
    rows += [(50, other + "\n" + other), (51, None), (52, ""), (53, "\n\n"), (None, common), (3, "\n" + common),
             (54, "y" * 39 + "\n" + common), (54, "y" * 39 + "\n" + common), (55, "z" * 300_000 + "\n" + common)]
    return rows + [(60 + i, f"four documents only hold this long line of text\n{i}") for i in range(4)]


def digest(df):
    from pyspark.sql import functions as F
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped",
                                       F.sha2(F.coalesce("text", F.lit("")), 256)).collect()), key=str)


def test_lines_as_by_brute_force(spark, make_docs):
    rows = line_rows()
    docs = make_docs([(i, t, "en") for i, t in rows])
    out = line_dedup.dedup_lines(spark, docs, lines=True)
    assert out.columns == [*(c for c in docs.columns if c != "n_lines"), "n_lines", "n_dropped"]
    assert digest(out) == brute_lines(rows)
    assert line_dedup.dedup_lines(spark, make_docs([])).count() == 0


def test_deleted_documents_give_their_lines_back(spark, make_docs, tmp_path):
    rows = line_rows()
    docs = make_docs([(i, t, "en") for i, t in rows])
    store = line_dedup.LineStore(spark, str(tmp_path / "s"), shards=4)
    store.insert(docs.where("doc_id < 4")).insert(docs.where("doc_id >= 4"))
    assert digest(store.dedup(docs, True)) == brute_lines(rows)
    gone = list(range(2, 9)) + [55]
    store.delete(spark.createDataFrame([(i,) for i in gone] + [(None,)], "doc_id long"))
    left = [(i, t) for i, t in rows if i is not None and i not in gone]
    assert digest(store.dedup(docs.where(f"doc_id IS NOT NULL AND doc_id NOT IN ({','.join(map(str, gone))})"), True)) \
        == brute_lines(left)


def test_filters_that_run_full_lose_no_lines(spark, make_docs, tmp_path, monkeypatch):
    """A store that outgrows its filters keeps dropping the lines it found frequent before."""
    monkeypatch.setattr(line_dedup, "FILTER_KEYS", 1, raising=False)
    line = "this is the repeated line of number {:06d} and it is long".format

    def rows(ids, numbers):
        return [(i, "\n".join([f"own {i}"] + [line(n) for n in numbers])) for i in ids]

    def table(rows):
        return make_docs([(i, t, "en") for i, t in rows])

    batches = [rows(range(5), range(5)), rows(range(10, 15), range(5, 300)), rows(range(20, 25), range(300, 304)),
               rows(range(30, 34), range(400, 404))]
    for keys in (50, 10_000):  # the keys outgrow the shard and its filter; only the filter
        monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
        store, held = line_dedup.LineStore(spark, str(tmp_path / str(keys)), shards=1), []
        for batch in batches:
            store.insert(table(batch))
            held += batch
            assert digest(store.dedup(table(held), True)) == brute_lines(held)
        store.delete(spark.createDataFrame([(20,), (34,)], "doc_id long"))
        held = [r for r in held if r[0] != 20]
        assert digest(store.dedup(table(held), True)) == brute_lines(held)
        store.insert(table(rows([40], range(400, 404))))
        held += rows([40], range(400, 404))
        assert digest(store.dedup(table(held), True)) == brute_lines(held)


def test_cuckoo_filter_holds_and_forgets():
    rng = np.random.default_rng(0)
    k = rng.integers(-2**63, 2**63 - 1, (6000, 2))
    f = line_dedup.CuckooFilter.for_keys(6000)
    assert f.insert(k[:, 0].copy(), k[:, 1].copy())
    f = line_dedup.CuckooFilter.load(f.dump())
    assert f.contains(k[:, 0], k[:, 1]).all()
    f.delete(k[:3000, 0].copy(), k[:3000, 1].copy())
    assert f.contains(k[3000:, 0], k[3000:, 1]).all()
    assert f.contains(k[:3000, 0], k[:3000, 1]).mean() < 0.01


# decontamination

def brute_hits(docs, items, n=13):
    wins = {}
    for item, t in items:
        w = words(t)
        for s in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for size in {len(k) for k in wins}:
            for s in range(len(w) - size + 1):
                found = wins.get(tuple(w[s:s + size]))
                if found:
                    hit |= set(range(s, s + size))
                    ids |= found
        out.append((d, len(w), len(hit), tuple(sorted(i for i in ids if i is not None)),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def bench_rows():
    rng = np.random.default_rng(5)
    item = [" ".join(f"q{rng.integers(0, 40)}" for _ in range(m)) for m in (30, 13, 14, 3, 1, 60)]
    items = [(f"i{k}", t) for k, t in enumerate(item)] + [("i0", item[1]), (None, item[2]), ("n", None), ("e", ""),
                                                         ("s", "..."), ("r", "a a a a a a a a a a a a a a a a")]
    docs = [(k, " ".join(f"q{rng.integers(0, 40)}" for _ in range(50)) + " " + item[k % 6].upper() + " end")
            for k in range(12)]
    docs += [(20, "a " * 40), (21, None), (22, ""), (23, "!!"), (None, item[0]), (3, item[5]), (3, item[5]),
             (24, " ".join(f"f{i % 501}" for i in range(50_000)) + " " + item[0])]
    return docs, items


def test_hits_as_by_brute_force(spark, make_docs, bench_rows):
    docs, items = bench_rows
    bench = spark.createDataFrame([(*r, 1, "b") for r in items], "item_id string, text string, doc_id int, block string")
    out = decontam.decontaminate(spark, make_docs([(i, t, "en") for i, t in docs]), bench)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in out.collect()),
                 key=str)
    assert got == brute_hits(docs, items)
    none = decontam.decontaminate(spark, make_docs([(1, "a b", "en")]), bench.limit(0)).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in none] == [(2, 0, False)]
    assert decontam.decontaminate(spark, make_docs([]), bench).count() == 0


def test_neighbouring_documents_of_one_item(spark):
    """Rows that touch in their index block are judged one by one."""
    item = [f"q{i}" for i in range(20)]
    docs = [(1, " ".join(item)), (2, " ".join(item)), (3, ""), (4, " ".join(item)), (5, "x " + " ".join(item)),
            (6, " ".join(item) + " y"), (7, "a"), (8, "a"), (9, "a a")]
    items = [("i", " ".join(item)), ("j", "a")]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = decontam.decontaminate(spark, table, bench)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in out.collect()),
                 key=str)
    assert got == brute_hits(docs, items)
    assert {r["doc_id"] for r in decontam.keep_clean(spark, table, bench).collect()} == {3}


def test_proximity_matches(spark, make_docs):
    docs = make_docs([(1, "red x x blue", "en"), (2, "red " + "x " * 9 + "blue", "en"), (3, "red", "en")])
    index = decontam.build_index(docs, f"{spark.conf.get('spark.checkpoint.dir')}/near")
    items = spark.createDataFrame([("i", "blue red")], "item_id string, text string")
    assert {r["doc_id"] for r in decontam.proximity_matches(index, items, 4).collect()} == {1}


# licence scan

def test_base_phrases_as_by_brute_force(make_docs, odd_rows):
    texts = ["CC BY cc by; General Public\nLicense", "cc cc by by", "all rights reserved all rights reserved",
             "the general public license", "public license", "Licensed under CC BY-NC 4.0",
             "Licensed under the Apache License, Version 2.0", "Licensed under an Apache License, Version 2.0",
             "écc by", "x " * 40_000 + "cc by"]
    rows = odd_rows + [(100 + i, t, "en") for i, t in enumerate(texts)]
    got = {}
    for r in license_scan.scan(make_docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t, _ in rows:
        w, places = words(t), []
        for phrase, label in license_scan.BASE:
            p = phrase.split()
            places += [(label, s) for s in range(len(w)) if w[s:s + len(p)] == p]
        assert (len(w), sorted(places)) in [(r["n_words"], sorted(map(tuple, r["places"]))) for r in got[i]]
    spans = {i: {s["label"] for r in got[i] for s in r["spans"]} for i in (105, 106, 107)}
    assert spans[105] == {"cc-by-nc"} and spans[106] == {"apache-2.0"} and "apache-2.0" in spans[107]
    assert license_scan.scan(make_docs([])).count() == 0


# learned operators

def test_language_of_held_out_texts(spark, make_docs, odd_rows):
    voc = {"xx": "ba be bi bo bu".split(), "yy": "zor zar zir zur".split(), "zz": "éla élo éli".split()}
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(voc[g]) for _ in range(12)), g) for i, g in enumerate(list(voc) * 40)]
    p = language_id.fit(make_docs([r for r in rows if crc(r[0]) % 5] + [(900, None, "xx"), (901, "ba", None)]))
    assert p.langs == ["xx", "yy", "zz"]
    got = by_id(language_id.predict(make_docs(rows + [(1000 + (i or 0), t, g) for i, t, g in odd_rows]), p).collect(),
                "lang_pred", "score")
    held = [(i, g) for i, _, g in rows if crc(i) % 5 == 0]
    assert np.mean([next(iter(got[i]))[0] == g for i, g in held]) == 1
    assert got[1001] == got[1002] == got[1003] == got[1004] == {("und", 0.0)}
    assert all(0 <= s <= 1 for v in got.values() for _, s in v)
    none = language_id.fit(make_docs([]))
    assert by_id(language_id.predict(make_docs([(1, "ba", "xx")]), none).collect(), "lang_pred", "score") == {1: {("und", 0.0)}}
    docs = make_docs(odd_rows)
    kept = language_id.keep_recognised(docs, p)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {None, 5, 6, 7, 8, 9, 10, 11}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_learned_scores(spark, make_docs, odd_rows, module):
    rng = np.random.default_rng(2)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        y, t = i % 2, list(rng.choice(plain, 30))
        if y:
            t[3:6] = [f"scum{rng.integers(0, 50)}", "idiot", f"vile{rng.integers(0, 50)}"]
        rows.append((i, " ".join(t), "en"))
        labels.append((i, y))
    lab = spark.createDataFrame([x for x in labels if crc(x[0]) % 4 != 2] + [(3, None), (None, 1), (4, 0)],
                                "doc_id long, label int")
    model = module.fit(make_docs(rows), lab)
    out = by_id(module.score(make_docs(rows + [(1000 + (i or 0), t, g) for i, t, g in odd_rows]), model).collect(), "score")
    got = {i: next(iter(v))[0] for i, v in out.items() if len(v) == 1}
    held = [(got[i], y) for i, y in labels if crc(i) % 4 == 2]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[1001] == got[1002]
    again = module.fit(make_docs(rows).repartition(7), lab)  # the model does not depend on partitions
    assert by_id(module.score(make_docs(rows), again).collect(), "score")[7] == out[7]
    none = module.fit(make_docs(rows), lab.limit(0))
    assert module.score(make_docs(rows), none).count() == len(rows)
    assert module.score(make_docs([]), model).count() == 0


def test_pairs_of_terms_count():
    """Two terms whose linear weights are the same in both rows differ by their factors alone."""
    factors = np.zeros((4, 2), np.float32)
    factors[1], factors[2], factors[3] = [2, 0], [2, 0], [-2, 0]
    model = toxicity.Model(-3.0, np.ones(4, np.float32), np.array([0, .5, .5, .5], np.float32), factors)
    z = lambda ids: toxicity.logit(model, np.array(ids))
    assert z([1]) == z([2]) == z([3]) == -2.5
    assert z([1, 2]) == 2.0 and z([1, 3]) == -6.0


def test_factors_are_learned():
    """An insult beside a mention of a group is label 1, either alone is not."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(800):
        a, b = i % 2, (i // 2) % 2
        rows.append((a & b, np.unique(np.concatenate([rng.integers(10, 400, 6), [1] * a, [2] * b]).astype(np.int64))))
    with_pairs = toxicity.train(rows, buckets=512, epochs=20, l1=1.0, min_docs=1)
    alone = toxicity.Model(with_pairs.bias, with_pairs.value, with_pairs.weight, with_pairs.factors * 0)
    gain = [toxicity.logit(with_pairs, np.array(x)) - toxicity.logit(alone, np.array(x)) for x in ([1, 2], [1], [2])]
    assert gain[0] > 0 and abs(gain[1]) < 1e-6 and abs(gain[2]) < 1e-6
    assert toxicity.logit(with_pairs, np.array([1, 2])) > max(toxicity.logit(with_pairs, np.array([k])) for k in (1, 2))


def test_many_dropped_lines_take_linear_time(spark):
    """A text of 40,000 lines that all stand in five documents."""
    import time

    from tessera.llm import line_dedup
    lines = [f"a line of more than forty characters with the number {i:06d}" for i in range(40_000)]
    rows = [(d, "\n".join([f"own {d}", *lines])) for d in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    docs.count()
    start = time.time()
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark, docs, lines=True).collect()}
    assert time.time() - start < 30
    assert [out[d].n_dropped for d in range(5)] == [40_000] * 4 + [0] and out[0].text == "own 0"
    assert out[4].text == rows[4][1]


def test_columns_with_inner_names_are_kept(spark):
    from tessera.llm import decontam, line_dedup, near_dup
    line = "a line of well over forty characters that stands in many documents"
    names = "__doc long, __body long, __lines int, __row long, n_lines long, doc long, body long, lines int, parts int, row int"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}", *range(10)) for i in range(6)], f"doc_id long, text string, {names}")
    bench = spark.createDataFrame([("b", "own 3")], "item_id string, text string")
    for out in (line_dedup.dedup_lines(spark, docs), near_dup.keep_first(spark, docs), decontam.keep_clean(spark, docs, bench)):
        assert out.columns == docs.columns and out.count() > 0
        assert all(tuple(r)[2:] == tuple(range(10)) for r in out.collect())
    both = line_dedup.dedup_lines(spark, docs, lines=True)
    assert both.columns.count("n_lines") == 1 and {r.n_lines for r in both.collect()} == {2}


def test_language_fit_learns_from_the_smallest_hashes(spark, make_docs):
    """The same rows as by one ordering of each language, whatever its shares."""
    from pyspark.sql import functions as F

    from tessera.llm import language_id as li
    rows = [(i, f"{'the small ' if i % 3 else 'der kleine '}word{i} " * 5, "en" if i % 3 else "de") for i in range(300)]
    docs = make_docs([*rows, (None, "no number", "en"), (1, None, "en"), (2, "no language", None)])
    got = li.fit(docs, per_lang=20)
    few = [r.doc_id for lang in ("en", "de") for r in docs.where(F.col("lang") == lang).where("text IS NOT NULL")
           .select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(20).collect()]
    want = li.fit(docs.where(F.col("doc_id").isin([i for i in few if i is not None])), per_lang=1000)
    assert got.langs == want.langs == ["de", "en"]
    assert abs(got.prototypes - want.prototypes).max() < 1e-6
