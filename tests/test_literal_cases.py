"""Literal cases (FIXTURES.md part 3) with expected values worked out by hand."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import lookups as lk
from tessera.operators import records as rc
from tessera.operators import research as rs
from tessera.operators import retrieval as rt
from tessera.operators import sections as sec
from tessera.session import scratch_dir
from tessera.sinks import store as st


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_slug(spark):
    assert one(spark, tx.slugify(F.col("v"), "-"), "Hello,  Wörld -- x") == "hello-world-x"


def test_slug_nfkd(spark):
    assert one(spark, tx.slugify(F.col("v"), "-"), "ﬁ ½ ß") == "fi-12"
    assert one(spark, tx.slugify(F.col("v"), "-"), "žlutý Éa") == "zluty-ea"


def test_slug_unicode_keeps_letters(spark):
    assert one(spark, tx.slugify(F.col("v"), "-", unicode=True), "Wörld Ünï") == "wörld-ünï"


def test_doc_uri(spark):
    df = spark.createDataFrame([("A B", "x/y.md")], "title string, path string")
    uri = df.select(sec.doc_uri(F.col("title"), F.col("path"), "base/").alias("u")).first()["u"]
    assert uri == "base/x/y/#a-b"


def test_report_file(spark):
    assert one(spark, tx.file_slug(F.col("v")), "Agentic system: v2") == "agentic_system__v2.md"


def test_sentence_rule(spark):
    got = one(spark, tx.sentences(F.col("v")), "Pi is 3.14. Ok? 你好。再见！")
    assert got == ["Pi is 3.14.", "Ok?", "你好。", "再见！"]


def test_chunks(spark):
    s = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, tx.chunk_array(s, 2), "x") == ["a b", "c"]
    assert one(spark, tx.chunk_array(s, 1), "x") == ["a", "b", "c"]
    assert one(spark, tx.chunk_array(s, 0), "x") == ["a", "b", "c"]
    assert one(spark, tx.chunk_array(F.array().cast("array<string>"), 10), "x") == []


def test_key_terms(spark):
    assert one(spark, tx.key_terms(F.col("v")), "The café cafx the été naïve and cafx") == ["cafx"]
    got = one(spark, tx.key_terms(F.col("v")), "Alpha beta gamma alpha delta with epsilon zeta")
    assert got == ["alpha", "beta", "gamma", "delta", "epsilon"]


def test_research_context_empty(spark):
    reg = spark.createDataFrame([], "topic string, aspect string, terms array<string>, pos long")
    runs = spark.createDataFrame([("t",)], "topic string")
    assert rs.research_context(reg, runs).first()["context"] == "No research context available yet."


def test_research_context_lines(spark):
    reg = spark.createDataFrame([("t", "b", ["x", "y", "z", "w"], 2), ("t", "a", ["p"], 1)],
                                "topic string, aspect string, terms array<string>, pos long")
    ctx = rs.research_context(reg, reg).first()["context"]
    assert ctx == "Research Context:\n- a: p\n- b: x, y, z"


def test_urls(spark):
    assert one(spark, tx.extract_urls(F.col("v")), "[x](http://a.b/c) http://d.e/f] http://a.b/c") == \
        ["http://a.b/c", "http://d.e/f"]
    assert one(spark, tx.extract_urls(F.col("v")), "http://z.z then [x](http://a.b)") == \
        ["http://a.b", "http://z.z"]


def test_rounding_display(spark):
    df = spark.createDataFrame([(1, "a", 2.5, 3.5, "o", "d"), (2, "b", None, 0.0, "", None)],
                               "k long, name string, length double, weight double, ocean string, description string")
    rows = {r["id"]: r for r in lk.format_whale_rows(df, ["k"]).collect()}
    assert (rows[1]["length"], rows[1]["weight"]) == ("2", "4")
    assert (rows[2]["length"], rows[2]["weight"], rows[2]["ocean"], rows[2]["description"]) == ("…", "…", "…", "…")


def test_key_exists(spark):
    df = spark.createDataFrame([(1, '{"foobar":null}'), (2, "{}"), (3, '{"a":{"foobar":1}}')],
                               "id int, attributes string")
    assert [r["id"] for r in rc.has_key(df, "foobar").collect()] == [1]


def test_since_yesterday(spark):
    df = spark.createDataFrame([(1, "2024-01-14 23:59:00"), (2, "2024-01-15 00:00:00"), (3, "2024-01-16 08:00:00")],
                               "id int, t string").withColumn("start_timestamp", F.to_timestamp("t"))
    got = sorted(r["id"] for r in rc.since_yesterday(df, dt.datetime(2024, 1, 15, 12)).collect())
    assert got == [2, 3]


def test_yesterday_errors(spark):
    df = spark.createDataFrame([(1, "2024-01-14 00:00:00", "error"), (2, "2024-01-14 23:59:59", "error"),
                                (3, "2024-01-15 00:00:00", "error"), (4, "2024-01-14 10:00:00", "info")],
                               "id int, t string, level string").withColumn("start_timestamp", F.to_timestamp("t"))
    got = sorted(r["id"] for r in rc.yesterday_with_level(df, dt.datetime(2024, 1, 15, 12)).collect())
    assert got == [1, 2]


def test_sql_guard(spark):
    df = spark.createDataFrame([(1, "success", "SEL\\ECT 1"), (2, "success", " select 1"), (3, "success", "select 1"),
                                (4, "invalid_request", None)], "id int, kind string, sql_query string")
    got = {r["id"]: (r["cleaned_sql"], r["ok"]) for r in lk.sql_text_guard(df).collect()}
    assert got == {1: ("SELECT 1", True), 2: (" select 1", False), 3: ("select 1", True), 4: (None, True)}


def test_no_hits_gives_empty_context(spark):
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    store = spark.createDataFrame([], "uri string, title string, content string, embedding array<double>")
    hits = rt.knn(store, queries, k=10, id_col="uri")
    assert rt.format_context(queries, hits, store).first()["context"] == ""


def test_l2_vs_cosine(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(1, [10.0, 0.0]), (2, [0.9, 0.5])], "vec_id long, embedding array<double>")
    l2 = [r["vec_id"] for r in rt.knn(c, q, k=2, metric="l2").orderBy("rank").collect()]
    cos = [r["vec_id"] for r in rt.knn(c, q, k=2, metric="cosine").orderBy("rank").collect()]
    assert l2 == [2, 1] and cos == [1, 2]


def test_cosine_zero_vector_never_matches(spark):
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in rt.knn(c, q, k=5, metric="cosine").collect()] == [2]


def test_knn_ties_broken_by_id(spark):
    q = spark.createDataFrame([(0, [0.0, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(i, [1.0, 0.0]) for i in (9, 3, 7, 5)], "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in rt.knn(c, q, k=3).orderBy("rank").collect()]
    assert got == [3, 5, 7]


def test_knn_query_blocks(spark):
    """A tiny bound forces groups of one query, and several pivots; the result must not change."""
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(40)]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = c.withColumnRenamed("vec_id", "query_id")
    a = sorted(tuple(r) for r in rt.knn(c, q, k=4).collect())
    b = sorted(tuple(r) for r in rt.knn(c, q, k=4, max_group_bytes=64).collect())
    d = sorted(tuple(r) for r in rt.knn(c, q, k=4, pivots=9).collect())
    assert a == b == d and len(a) == 160


def test_duplicate_uri_in_batch(spark):
    batch = spark.createDataFrame([("u1", "t", "first", "e1", 1), ("u1", "t", "second", "e2", 2),
                                   ("u2", "t", "x", "e3", 3)],
                                  "uri string, title string, content string, embedding_content string, pos long")
    store = st.SectionStore.create(spark, scratch_dir(spark, f"dup_{uuid.uuid4().hex}"))
    store.load(spark.createDataFrame([("u2", "t", "old", "e0", 1)], batch.schema))
    rows, report = store.plan(batch)
    assert [(r["uri"], r["content"]) for r in rows.collect()] == [("u1", "first")]
    assert sorted((r["uri"], r["copies"], r["exists"]) for r in report.collect()) == [("u1", 2, False), ("u2", 1, True)]
    dup = st.load_sections(spark, store.path, batch)
    assert [(r["uri"], r["dropped"]) for r in dup.collect()] == [("u1", 1)]
    assert sorted((r["uri"], r["content"]) for r in store.sections().collect()) == [("u1", "first"), ("u2", "old")]


def test_split_marked_text(spark):
    got = one(spark, tx.split_marked(F.col("v")), " a <<<SPLIT>>>  <<<SPLIT>>>b\n")
    assert got == ["a", "b"]


def test_money_text(spark):
    req = spark.createDataFrame([(1, True), (2, False), (3, True)], "account_number long, include_pending boolean")
    acc = spark.createDataFrame([(1, " A ", 10.5, 2.25), (2, "B", -3.1, 1.0)],
                                "account_number long, name string, balance double, pending double")
    got = {r["account_number"]: r["amount_text"] for r in lk.account_balance(req, acc).collect()}
    assert got == {1: "$12.75", 2: "$-3.10", 3: None}


def test_knn_single_matches_batch(spark):
    rows = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)]
    c = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(0, [2.0, 1.0, 0.5])], "query_id long, embedding array<double>")
    one_q = [(r["vec_id"], r["distance"]) for r in rt.knn_single(c, [2.0, 1.0, 0.5], k=5).collect()]
    batch = [(r["vec_id"], r["distance"]) for r in rt.knn(c, q, k=5).orderBy("rank").collect()]
    assert one_q == batch


def test_subtask_array_form(spark):
    df = spark.createDataFrame([([("a", "t1"), ("b", "t2"), ("a", "t3")],)], "s array<struct<id:string,title:string>>")
    r = df.select(rs.subtask_in_plan(F.col("s"), F.lit("a")).alias("x"),
                  rs.subtask_in_plan(F.col("s"), F.lit("z")).alias("y")).first()
    assert r["x"]["title"] == "t1" and r["y"] is None


def test_geocode_default_and_reject(spark):
    gaz = spark.createDataFrame([("Paris", 1.0, 2.0, 5), ("Paris", 3.0, 4.0, 1)],
                                "place string, lat double, lng double, match_order int")
    req = spark.createDataFrame([("Paris", False), ("Nowhere", True), ("Nowhere2", False)],
                                "place string, use_default boolean")
    got = {r["place"]: (r["found"], r["location"], r["reject_reason"]) for r in lk.geocode_first(req, gaz).collect()}
    assert got["Paris"] == (True, "3.0,4.0", None)
    assert got["Nowhere"] == (False, "51.1,-0.1", None)
    assert got["Nowhere2"][0] is False and got["Nowhere2"][2] is not None


def test_validate_records_reasons(spark):
    from tessera.operators import validate as vd
    df = spark.createDataFrame([
        ("support", 1, '{"support_advice":"a","block_card":false,"risk":11}'),
        ("support", 2, '{"support_advice":"a","block_card":true,"risk":3}'),
        ("whale", 3, '{"name":"w","length":2.0,"weight":10.0}'),
        ("whale", 4, '{"name":"w","length":2.0}'),
        ("sql_answer", 5, '{"kind":"success","sql_query":""}'),
        ("record", 6, '{"level":"fatal"}'),
        ("support", 7, "not json"),
        ("other", 8, "{}")], "record_kind string, record_id long, json string")
    got = {r["record_id"]: (r["valid"], r["reasons"]) for r in vd.validate_records(df).collect()}
    assert got[1] == (False, "risk_range") and got[2] == (True, "")
    assert got[3] == (False, "weight_min_50") and got[4] == (True, "")
    assert got[5] == (False, "sql_query_nonempty") and got[6] == (False, "level_in_domain")
    assert got[7][0] is False and "parse" in got[7][1]
    assert got[8] == (False, "parse")
    ok, bad = vd.split_valid(vd.validate_records(df))
    assert ok.count() == 2 and bad.count() == 6


def test_scrub_allow_list(spark):
    from tessera.operators import cleanup as cl
    df = spark.createDataFrame([("my password", 'x token = "abc" at 10.0.0.1 password')], "source string, text string")
    r = cl.scrub_text(df, ["source", "text"], allow=[("source", "password")]).first()
    assert r["source"] == "my password"
    assert r["text"] == "x [scrubbed] at [scrubbed] [scrubbed]"


def test_corrections_in_order_with_rejects(spark):
    from tessera.operators import cleanup as cl
    docs = spark.createDataFrame([(1, "a##b##c")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 1, "##", "-"), (1, 2, "-b-", "B"), (1, 3, "zzz", "q")],
                                  "doc_id long, seq int, old string, new string")
    r = cl.apply_corrections(docs, edits).first()
    assert r["corrected"] == "aBc" and r["rejected"] == [3]
