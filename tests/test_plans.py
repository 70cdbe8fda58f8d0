"""Physical-plan shape: the scale properties the design relies on, read from ``explain``."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tessera.plans import load_all
from tessera.plans import fixtures as fx
from tessera.plans import store_queries as sq

SF = "/root/testdata/sf0.001"
LIBRARY, LIBRARY_SQL = load_all()
QUERIES = {k: v for k, v in E.queries().items() if k in LIBRARY}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, key):
    p = plan(QUERIES[key](spark, SF), "simple")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_chunking_is_narrow(spark):
    p = plan(fx.doc_chunks(spark, SF), "simple")
    # the only exchange allowed is the round-robin spread of a small text scan (local inputs only)
    exchanges = [line for line in p.splitlines() if "Exchange" in line]
    assert all("RoundRobinPartitioning" in line for line in exchanges), exchanges


def test_knn_limits_before_the_shuffle(spark):
    p = plan(QUERIES["knn_l2"](spark, SF), "simple")
    assert "MapInArrow" in p
    assert "WindowGroupLimit" in p and "Partial" in p


def test_store_probe_reads_only_the_parts_in_question(spark):
    store = sq.store_fixture(spark, SF)
    some = store.sections().where("part IN (3, 5)").select("uri").limit(3)
    p = plan(store.stored(some))
    assert "PartitionFilters: [isnotnull(part" in p
    assert "ReadSchema: struct<uri:string>" in p


def test_fan_out_cap_partial_limit(spark):
    p = plan(QUERIES["fan_out_cap"](spark, SF), "simple")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_time_filters_reach_the_scan(spark):
    p = plan(QUERIES["records_yesterday_errors"](spark, SF), "simple")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p and "LessThan(ts," in p


def test_language_vote_is_narrow(spark):
    p = plan(QUERIES["detect_language"](spark, SF), "simple")
    assert "Exchange" not in p and "Generate" not in p


def test_rows_are_numbered_as_rows(spark):
    df = QUERIES["enumerate_rows"](spark, SF)
    assert df.columns == ["doc_id", "sent_idx", "row_idx", "sentence_md5"]
    assert "Window [row_number()" in plan(df, "simple")
    assert df.agg({"row_idx": "min"}).first()[0] == 0
