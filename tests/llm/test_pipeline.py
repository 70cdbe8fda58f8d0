import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from tessera.llm import decontam, language_id, line_dedup, near_dup, packing, queries, tokens

from .conftest import SF, words


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_same_as_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[key])
    cols = [d[0] for d in cur.description]
    got = E.queries()[key](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(cur.fetchall())


def test_all_queries_are_registered():
    names = {k.split("_")[0] for k in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in E.queries()
    assert [f.__wrapped__.__module__ for _, f in C.STAGES] == ["corpus_pipeline"] * 5


def test_stages_do_what_their_operators_say(spark, make_docs, odd_rows, tmp_path):
    """Each stage against its operator's own decisions, on the stage's own input."""
    passage = "thirteen plain words that a benchmark item holds and that nobody else writes down here"
    line = "a line of well over forty characters that stands in many documents"
    rows = odd_rows + [(100 + i, f"{line}\nown words number {i} " + " ".join(f"u{i}x{j}" for j in range(20)), "en")
                       for i in range(8)]
    rows += [(200, passage, "en"), (201, passage + " " + " ".join(f"long{j}" for j in range(400)), "en")]
    sf = str(tmp_path)
    spark.createDataFrame([("b", passage)], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = make_docs(rows)
    cols = docs.columns
    for name, stage in C.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        after = spark.read.parquet(f"{sf}/{name}")
        before, now = [list(map(tuple, d.select(*[c for c in ("doc_id", "text") if c in d.columns]).collect()))
                       for d in (docs, after)]
        if name != "packing":
            assert after.columns == cols
        if name == "language":
            assert sorted(now, key=str) == sorted((r for r in before if any(c.isalpha() for c in r[1] or "")), key=str)
        elif name == "lines":
            want = line_dedup.dedup_lines(spark, docs).select("doc_id", "text").collect()
            assert sorted(now, key=str) == sorted(map(tuple, want), key=str) and len(now) == len(before)
            assert sum(line in (t or "") for _, t in now) == 1
        elif name == "near_duplicates":
            groups = {(r["doc_id"], r["class_id"]): r["group_id"] for r in near_dup.near_duplicates(spark, docs).collect()}
            stay = {d for (d, _), g in groups.items() if g is None or d == g}
            assert {d for d, _ in now} == stay and set(groups.values()) <= {d for d, _ in now}
        elif name == "benchmark":
            hit = {r["doc_id"] for r in decontam.decontaminate(
                spark, docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r["contaminated"]}
            assert hit == {200} and sorted(now, key=str) == sorted((r for r in before if r[0] != 200), key=str)
        docs = after if name != "packing" else docs
    pieces = {}
    for r in spark.read.parquet(f"{sf}/packing").collect():
        pieces[r["doc_id"]] = pieces.get(r["doc_id"], 0) + r["length"]
    t = tokens.WordTokenizer(tokens.vocabulary("word_bpe_49k.json"))
    want = {}
    for d, text in map(tuple, docs.select("doc_id", "text").collect()):
        want[d] = want.get(d, 0) + len(t.tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert pieces == want and words(passage) and packing.CAPACITY == 4096


def test_run_and_empty_tables(spark, make_docs, tmp_path):
    sf = str(tmp_path)
    make_docs([]).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert C.run(spark, sf).count() == 0
    assert C.run(spark, SF).count() > 0
    assert language_id.PER_LANG == 1500
