"""Keyword search over the written page index against counting every page by hand."""
import random
import re
import uuid
from collections import Counter

import pytest

from tessera.functions import text as tx
from tessera.operators import page_index as pi
from tessera.operators import research as rs

TOKEN = re.compile(r"\w+")


def terms(text):
    return [t for t in TOKEN.findall((text or "").lower()) if re.fullmatch("[a-z]{3,}", t)
            and t not in tx.KEY_TERM_STOPWORDS]


def brute(queries, pages, n):
    out = set()
    for q, text in queries:
        asked, rows = set(terms(text)), []
        for p, url, html in pages:
            if p is None:
                continue
            seen = Counter(t for t in terms(html) if t in asked)
            if seen:
                rows.append((-len(seen), -sum(seen.values()), p, url))
        rows.sort()
        out |= {(q, p, u, -d, -t, i) for i, (d, t, p, u) in enumerate(rows[:n], 1)} or {(q, None, None, 0, 0, None)}
    return out


def made(seed, n_pages=400, n_queries=60):
    rng = random.Random(seed)
    vocab = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    weight = [1 / (i + 1) for i in range(200)]
    page = lambda i: (i, f"http://x/{i}", " ".join(rng.choices(vocab, weight, k=rng.choice([0, 3, 30, 200]))))
    pages = [page(i) for i in range(n_pages)] + [(None, "http://none", "waa wab"), (9_000, "http://null", None)]
    queries = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 12)))) for i in range(n_queries)]
    return pages, [*queries, (100, "nowhere to find"), (101, ""), (102, None), (103, queries[0][1]), (104, "the and")]


@pytest.mark.parametrize("block, limit", [(1, 3), (16, 5), (2048, 5)])
def test_search_equals_counting(spark, monkeypatch, block, limit):
    monkeypatch.setattr(pi, "BLOCK_PAGES", block)
    pages, queries = made(block)
    got = rs.search_pages(spark.createDataFrame(queries, "query_id long, text string"),
                          spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), limit)
    assert set(map(tuple, got.select("query_id", "page_id", "url", "distinct_hits", "total_hits", "rank").collect())) \
        == brute(queries, pages, limit)


def test_groups_of_queries_and_appended_pages(spark, tmp_path):
    pages, queries = made(7)
    q = spark.createDataFrame(queries, "query_id long, text string")
    p = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    pi.write_index(p.where("page_id % 2 = 0"), path)
    pi.write_index(p.where("page_id % 2 = 1"), path, mode="append")
    got = pi.search_index(q, pi.read_index(spark, path), 5, max_query_bytes=2000)
    assert set(map(tuple, got.select("query_id", "page_id", "url", "distinct_hits", "total_hits", "rank").collect())) \
        == brute(queries, pages, 5)


def test_only_the_best_pages_are_shuffled(spark, tmp_path):
    pages, queries = made(8)
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    pi.write_index(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    q = spark.createDataFrame(queries, "query_id long, text string")
    plan = pi.search_index(q, pi.read_index(spark, path), 5)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "WindowGroupLimit" in plan


def test_empty_tables(spark):
    q = spark.createDataFrame([], "query_id long, text string")
    p = spark.createDataFrame([], "page_id long, url string, html string")
    assert rs.search_pages(q, p).collect() == []
    one = spark.createDataFrame([(1, "some words")], "query_id long, text string")
    assert rs.search_pages(one, p).collect()[0].page_id is None


def test_skipping_reads_fewer_postings(spark, monkeypatch):
    """The bar of the pages found so far keeps the common terms' postings unread."""
    import numpy as np
    import pyarrow as pa
    html = [" ".join(["common"] * 3 + (["rare", "scarce"] if i < 5 else [])) for i in range(1000)]
    batch = pa.RecordBatch.from_pylist([{"page_id": i, "url": "u", "tokens": terms(h)} for i, h in enumerate(html)])
    block = pi._Block(next(pi._build([batch])).slice(0, 1), pa.array(["common", "rare", "scarce"]))
    read = []
    whole = pi._Block.postings
    monkeypatch.setattr(pi._Block, "postings", lambda self, t: read.append(len(out := whole(self, t))) or out)
    first = block.best(np.sort(block.place), 5, (0, 0))
    again = block.best(np.sort(block.place), 5, (first[-1][0], first[-1][1]))
    assert again == first and read == [1010, 5]
