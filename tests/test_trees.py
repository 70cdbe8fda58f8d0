"""Nested JSON scrubbing and usage over trees of runs."""
import json
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.operators import cleanup as cl
from tessera.operators import messages as mg

PATTERN = re.compile("|".join(map(cl._python_pattern, cl.SCRUB_PATTERNS)), re.ASCII)


def scrub_parsed(v, path, allow):
    if isinstance(v, dict):
        return {k: scrub_parsed(x, (*path, k), allow) for k, x in v.items()}
    if isinstance(v, list):
        return [scrub_parsed(x, (*path, i), allow) for i, x in enumerate(v)]
    if isinstance(v, str):
        return PATTERN.sub(lambda m: m.group() if (path, m.group()) in allow else cl.SCRUB_REPLACEMENT, v)
    return v


leaf = st.one_of(st.none(), st.booleans(), st.integers(), st.floats(allow_nan=False, allow_infinity=False),
                 st.sampled_from(["password", "PASSWORD x", 'token = "a\\"', "10.0.0.1", 'q"\\{[', "é ", ""]), st.text(max_size=5))
tree = st.recursive(leaf, lambda c: st.one_of(st.lists(c, max_size=4), st.dictionaries(
    st.sampled_from(["a", "b", "password", 'k"{', ""]), c, max_size=3)), max_leaves=20)


@settings(max_examples=300, deadline=None)
@given(tree, st.booleans(), st.sampled_from([None, 1]))
def test_scrub_tree_equals_walking_the_parsed_tree(value, ascii_only, indent):
    allow = {(("a",), "password"), (("a", 0), "password"), (("b", "a"), "10.0.0.1")}
    text = json.dumps(value, ensure_ascii=ascii_only, indent=indent)
    got = cl.scrub_tree(text, PATTERN, allow)
    assert json.loads(got) == scrub_parsed(value, (), allow)
    if got == text:
        assert scrub_parsed(value, (), allow) == value


def test_everything_else_stays_as_written(spark):
    text = '{ "attributes" : {"my_safe_value":"a password", "n": 1.50e3, "password": 7, "big": 123456789012345678901},\n "x":["password"]}'
    rows = [(1, text), (2, None), (3, "no json: password"), (4, '"password"'), (5, "")]
    df = spark.createDataFrame(rows, "id long, r string")
    got = {r.id: r.r for r in cl.scrub_json(df, "r", allow=[(("attributes", "my_safe_value"), "password")]).collect()}
    assert got == {1: text.replace('["password"]', '["[scrubbed]"]'), 2: None, 3: "no json: [scrubbed]", 4: '"[scrubbed]"', 5: ""}
    # the whole match has to be allowed, at just this path
    df = spark.createDataFrame([(1, '{"attributes":{"my_safe_value":"Password","other":"password"}}')], "id long, r string")
    r = cl.scrub_json(df, "r", allow=[(("attributes", "my_safe_value"), "password")]).first().r
    assert json.loads(r) == {"attributes": {"my_safe_value": "[scrubbed]", "other": "[scrubbed]"}}


RUNS = "run_id string, parent string, model string, request_tokens long, response_tokens long"


def brute(rows):
    up = {r[0]: r[1] for r in rows}
    out = {}
    for run, _, model, req, resp in rows:
        at = run
        while at in up:
            a = out.setdefault((at, model), [0, 0, 0])
            out[(at, model)] = [a[0] + 1, a[1] + req, a[2] + resp]
            at = up[at]
    return {(k[0], k[1], *v) for k, v in out.items()}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "alone"])
def test_usage_by_run_equals_following_parents(spark, shape):
    rng = random.Random(1)
    n = 70
    parent = {"chain": lambda i: i - 1, "star": lambda i: 0, "random": lambda i: rng.randrange(max(i, 1)),
              "alone": lambda i: None}[shape]
    rows = [(f"r{i}", None if i == 0 or parent(i) is None else f"r{parent(i)}", f"m{i % 3}", i, 2 * i) for i in range(n)]
    rows.append(("orphan", "nobody", "m0", 5, 5))
    got = {tuple(r) for r in mg.usage_by_run(spark.createDataFrame(rows, RUNS)).collect()}
    assert got == brute(rows)


def test_runs_in_a_circle_raise(spark):
    rows = [("a", "b", "m", 1, 1), ("b", "a", "m", 1, 1), ("c", None, "m", 1, 1)]
    with pytest.raises(ValueError, match="parents"):
        mg.usage_by_run(spark.createDataFrame(rows, RUNS))
    assert mg.usage_by_run(spark.createDataFrame([], RUNS)).collect() == []
