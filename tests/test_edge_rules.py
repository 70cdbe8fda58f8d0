"""Inputs on which a plausible shortcut gives a wrong answer, with their literal results."""

import json

import pytest

from tessera.operators import cleanup as cl
from tessera.operators import lookups as lk
from tessera.operators import messages as ms
from tessera.operators import research as rs
from tessera.operators import sections as sec
from tessera.operators import validate as vd
from tessera.sources import files


def test_scrub_keeps_only_whole_allowed_matches(spark):
    df = spark.createDataFrame([("1.2.3.4 11.2.3.45 1.2.3.4",), ("none",), (None,)], "t string")
    got = [r["t"] for r in cl.scrub_text(df, ["t"], allow=[("t", "1.2.3.4")], patterns=[r"\d+(?:\.\d+){3}"]).collect()]
    assert got == [f"1.2.3.4 {cl.SCRUB_REPLACEMENT} 1.2.3.4", "none", None]
    marked = spark.createDataFrame([("\x020\x03 stays",)], "t string")
    assert cl.scrub_text(marked, ["t"], allow=[("t", "x")], patterns=["qq"]).first()["t"] == "\x020\x03 stays"


def test_message_without_parts_is_rejected(spark):
    part = "array<struct<part_kind string, content string, timestamp string>>"
    df = spark.createDataFrame([(1, 0, "response", [], "t"), (1, 1, None, [("text", "x", None)], "t")],
                               f"batch_id long, pos int, kind string, parts {part.replace(' string', ':string')}, timestamp string")
    chat = ms.chat_messages(df)
    assert [r["reject_reason"] is not None for r in chat.collect()] == [True, True]
    assert ms.ndjson_lines(chat).count() == 0


def test_languages_with_a_splitter(spark):
    df = spark.createDataFrame([("en",), ("zh",), ("zh-tw",), ("fr",), (None,)], "lang string")
    got = {r["lang"]: (r["splitter"], r["reject_reason"]) for r in sec.route_by_language(df).collect()}
    assert got["en"] == ("en", None) and got["zh"] == got["zh-tw"] == ("zh", None)
    assert got["fr"] == got[None] == (None, sec.NO_SPLITTER)
    with pytest.raises(Exception, match=sec.NO_SPLITTER):
        sec.route_by_language(df, strict=True).select("lang").collect()


def test_missing_section_fields_fail_whatever_is_read(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": 1, "parent": None, "path": "p", "level": 1, "title": "t"}))
    with pytest.raises(Exception, match="content"):
        files.read_doc_sections(spark, str(tmp_path)).select("title").collect()
    with pytest.raises(Exception, match="content"):
        files.read_doc_sections(spark, str(tmp_path)).count()


def test_default_location_comes_before_any_lookup(spark):
    req = spark.createDataFrame([("here", True), ("here", False), ("gone", False)], "place string, use_default boolean")
    gaz = spark.createDataFrame([("here", 1.0, 2.0, 0)], "place string, lat double, lng double, match_order int")
    got = {(r["place"], r["use_default"]): (r["lat"], r["reject_reason"]) for r in lk.geocode_first(req, gaz).collect()}
    assert got["here", True] == (lk.DEFAULT_LAT, None) and got["here", False] == (1.0, None)
    assert got["gone", False][0] is None and got["gone", False][1]


def test_required_fields_and_kinds_of_records(spark):
    rows = [("support", 1, '{"support_advice": "a", "risk": 3}'),
            ("support", 2, '{"support_advice": "a", "risk": 3, "block_card": false}'),
            ("sql_answer", 3, '{"kind": "foo", "sql_query": "SELECT 1"}'),
            ("sql_answer", 4, '{"kind": "success", "sql_query": "SELECT 1"}')]
    df = spark.createDataFrame(rows, "record_kind string, record_id long, json string")
    got = {r["record_id"]: r["valid"] for r in vd.validate_records(df).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}


def test_each_provider_has_its_own_limit(spark):
    rows = []
    for p, (prov, fields) in enumerate(rs.PROVIDER_FIELDS.items()):
        rows += [(1, prov, 10 * p + i, json.dumps({f: f"{prov}{i}" for f in fields})) for i in range(5)]
    df = spark.createDataFrame(rows, "search_id long, provider string, pos long, payload string")
    out = rs.normalize_search_results(df, max_results=3)
    assert sorted((r["provider"], r["rank"]) for r in out.collect()) == \
        sorted((p, k) for p in rs.PROVIDER_FIELDS for k in (1, 2, 3))
