"""The section store: filters, interrupted loads, strict loads, search by uri."""
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.functions import vectors as vx
from tessera.session import scratch_dir
from tessera.sinks import store as st

BATCH = "uri string, title string, content string, embedding_content string, pos long"


def new_store(spark, **options):
    return st.SectionStore.create(spark, scratch_dir(spark, f"test_{uuid.uuid4().hex}"), **{"parts": 4, **options})


def rows(spark, uris, word="first"):
    return spark.createDataFrame([(u, "t", f"{word} {u}", f"{word} {u}", i) for i, u in enumerate(uris)], BATCH)


def uris(n, tag="u"):
    return [f"{tag}/{i}" for i in range(n)]


@pytest.mark.parametrize("expected", [1, 100_000])
def test_filters_miss_no_stored_uri(spark, expected):
    """Also in filters far too small, and over several loads."""
    store = new_store(spark, expected=expected)
    for k in range(3):
        store.load(rows(spark, uris(2000, f"s{k}")))
    every = [u for k in range(3) for u in uris(2000, f"s{k}")]
    other = uris(3000, "other")
    keys = spark.createDataFrame([(u,) for u in every + other], "uri string")
    maybe = {r.uri for r in store.maybe_stored(keys).collect()}
    assert set(every) <= maybe
    assert {r.uri for r in store.stored(keys).collect()} == set(every)
    if expected > 1:
        assert len(maybe - set(every)) < 0.1 * len(other)


def test_a_load_cut_off_is_made_up_for(spark, monkeypatch):
    """The bits are written, the sections are not: the next load stores them, once."""
    store, batch = new_store(spark), rows(spark, uris(50))
    monkeypatch.setattr(st.SectionStore, "append", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.load(batch)
    monkeypatch.undo()
    again = st.SectionStore.open(spark, store.path)
    for _ in range(2):
        again.load(batch)
    assert sorted(r.uri for r in again.sections().collect()) == sorted(uris(50))


def test_first_row_wins_whatever_the_order(spark):
    store = new_store(spark)
    batch = spark.createDataFrame([("a", "t", "late", "x", 9), ("a", "t", "early", "x", 1), ("a", "t", "tie", "x", 1),
                                   (None, "t", "no uri", "x", 0), ("b", None, None, "x", None)], BATCH).coalesce(1)
    report = {r.uri: (r.copies, r.exists) for r in store.load(batch).collect()}
    assert report == {"a": (3, False), "b": (1, False)}
    assert {r.uri: r.content for r in store.sections().collect()} == {"a": "early", "b": None}


def test_strict_load_rejects_repeated_uris(spark):
    store = new_store(spark)
    store.load(rows(spark, ["old", "old2"]))
    batch = rows(spark, ["old", "new", "twice", "twice", "old2", "old2"], "second")
    got = {r.uri: (r.copies, r.exists, r.action) for r in store.load_collection(batch).collect()}
    assert got == {"old": (1, True, "skip_existing"), "new": (1, False, "insert"),
                   "twice": (2, False, "reject_duplicate"), "old2": (2, True, "reject_duplicate")}
    assert {r.uri: r.content for r in store.sections().collect()} == {
        "old": "first old", "old2": "first old2", "new": "second new"}


def test_empty_batches_and_store(spark):
    store = new_store(spark)
    assert store.load(spark.createDataFrame([], BATCH)).collect() == []
    assert store.sections().count() == 0
    q = spark.createDataFrame([(1, [0.0] * 64)], "query_id long, embedding array<double>")
    assert store.index().search(q, id_col="uri").collect() == []


def test_search_by_uri_after_two_loads(spark):
    store = new_store(spark)
    store.load(rows(spark, ["red apple", "green pear"]))
    store.load(rows(spark, ["red apple", "blue plum"], "second"))
    q = vx.embed_text(spark.createDataFrame([(1, "second blue plum"), (2, "first red apple")], "query_id long, text string"))
    hits = store.index("cosine").search(q, k=1, id_col="uri")
    got = {r.query_id: (r.uri, r.content) for r in hits.join(store.sections(), "uri").collect()}
    assert got == {1: ("blue plum", "second blue plum"), 2: ("red apple", "first red apple")}


def test_the_batch_is_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(u):
        runs.add(1)
        return u
    new_store(spark).load(rows(spark, uris(40)).withColumn("title", seen("uri")))
    assert runs.value == 40
