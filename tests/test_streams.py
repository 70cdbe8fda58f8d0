"""Incremental list scanning, the keyed log, and the streams that use them."""
import json
import random
import uuid

from pyspark.sql import functions as F

from tessera.session import scratch_dir
from tessera.streaming import streams as ss
from tessera.streaming.keyed_log import KeyedLog
from tessera.streaming.partial import ListScanner, valid_record

GOOD = {"name": "blue", "length": 30.5, "weight": 100000, "description": 'a {brace}, a "quote" and a \\ back'}
PIECES = "list_id long, seq long, delta string, is_last boolean"


def scan(text, cuts):
    s, at = ListScanner(), 0
    for c in [*cuts, len(text)]:
        s = ListScanner(*json.loads(json.dumps(s.state())))  # as it is kept between micro-batches
        s.feed(text[at:c])
        at = c
    return s.n_complete, s.n_valid, s.strict_ok()


def test_scanner_reads_any_cut_alike():
    rng = random.Random(2)
    for text, want in [
            (json.dumps([GOOD] * 3), (3, 3, True)), (json.dumps([]), (0, 0, True)), (" [ ] ", (0, 0, True)),
            (json.dumps([GOOD, {"name": "x", "length": 1, "weight": 10}]), (2, 1, False)),
            (json.dumps([GOOD, {"name": "x"}]), (2, 1, False)), (json.dumps([GOOD, {"n": {"m": [{}]}}]), (2, 1, False)),
            (json.dumps([GOOD])[:-1], (1, 1, False)), (json.dumps([GOOD])[:-2], (0, 0, False)), ("", (0, 0, False)),
            (json.dumps([GOOD, 5]), (1, 1, False)), ("[{},]", (1, 0, False)), ('[{"name": "a", "length": NaN}]', (1, 0, False)),
            (json.dumps(["a {b} c", GOOD]), (1, 1, False)), (json.dumps(GOOD), (1, 1, False)), ('[{"a" 1}]', (1, 0, False)),
            (json.dumps([GOOD]) + json.dumps([GOOD]), (2, 2, False))]:
        for _ in range(30):
            cuts = sorted(rng.sample(range(len(text) + 1), min(len(text), rng.randint(0, 12))))
            assert scan(text, cuts) == want, (text, cuts)


def test_scanner_agrees_with_whole_parsing():
    rng = random.Random(3)
    for _ in range(300):
        rows = [{"name": rng.choice(["a", 'b"}', "{", None, 5]), "length": rng.choice([1, 2.5, None, "3", True]),
                 **({"weight": rng.choice([50, 49.9, None, 1e9, "x"])} if rng.random() < 0.7 else {})} for _ in range(rng.randint(0, 5))]
        text = json.dumps(rows)
        n = sum(bool(valid_record(json.dumps(r))) for r in rows)
        assert scan(text, sorted(rng.sample(range(len(text)), min(len(text), 5)))) == (len(rows), n, n == len(rows))


def answers(spark, files, name, max_files):
    base = scratch_dir(spark, f"{name}_{uuid.uuid4().hex}")
    for rows in files:
        spark.createDataFrame(rows, PIECES).coalesce(1).write.mode("append").parquet(f"{base}/src")
    out = ss.run_partial_records(spark, f"{base}/src", PIECES, base, f"{base}/ck", max_files)
    return sorted(tuple(r) for r in out.collect())


def test_pieces_in_any_order_and_batches(spark):
    texts = {1: json.dumps([GOOD] * 4), 2: json.dumps([GOOD, {"name": "x", "length": 2, "weight": 10}])}
    rows = []
    for k, text in texts.items():
        parts = [text[i:i + 25] for i in range(0, len(text), 25)]
        rows += [(k, i, p, i == len(parts) - 1) for i, p in enumerate(parts)]
    rows += [(3, 0, None, False), (3, 1, "[]", True), (None, 0, "[", True), (4, 1, "never answered", None)]
    one = answers(spark, [rows], "one", None)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    many = answers(spark, [shuffled[i::5] for i in range(5)] + [shuffled[:4]], "many", 1)
    assert one == many
    last = {r[0]: r[3:] for r in one if r[2]}
    assert last == {1: (4, 4, True), 2: (2, 1, False), 3: (0, 0, True)}
    assert 4 not in {r[0] for r in one}


LINES = "conv_id long, seq long, line string"


def line(seq, ts, content, conv=1, role="model"):
    return (conv, seq, json.dumps({"role": role, "timestamp": ts, "content": content}))


def test_bad_lines_are_rejected_and_the_stream_goes_on(spark):
    base = scratch_dir(spark, f"rejects_{uuid.uuid4().hex}")
    t = "2024-01-01T00:00:00+00:00"
    files = [[line(1, t, "one"), line(2, "abc", "x"), (1, 3, "not json"), (1, 4, ""), (1, 5, None)],
             [line(6, t, "two"), (1, 7, "{}"), line(8, None, "y")]]
    for f in files:
        spark.createDataFrame(f, LINES).coalesce(1).write.mode("append").parquet(f"{base}/src")
    out = ss.run_message_upsert(spark, f"{base}/src", LINES, f"{base}/log", f"{base}/ck", max_files=1, fold_after=1)
    assert [tuple(r) for r in out.collect()] == [(1, t, "model", "two", 1)]
    rejects = {r.seq: r.reason for r in ss.rejected_lines(spark, f"{base}/log").collect()}
    assert rejects == {2: "bad timestamp", 3: "no message", 7: "no message", 8: "no message"}


def total(rows):
    return rows.groupBy("k").agg(F.max("v").alias("v"))


def test_folding_and_replayed_epochs_give_the_same_view(spark):
    frames = [spark.createDataFrame([(k, (k * 7 + e * 3) % 11) for k in range(e, e + 4)], "k long, v long") for e in range(7)]
    views = []
    for fold in (1, 2, 3, 100):
        log = KeyedLog(spark, scratch_dir(spark, f"log_{uuid.uuid4().hex}"), total, fold)
        for e, f in enumerate(frames):
            log.append(f, e)
            if e in (2, 5):
                log.append(f, e)  # the epoch is run again
        log.append(frames[1], 1)  # also one that is in the base
        views.append(sorted(map(tuple, log.read().collect())))
    assert all(v == views[0] for v in views) and len(views[0]) == 10
    # a base that was cut off is not read, and is made anew
    log = KeyedLog(spark, scratch_dir(spark, f"log_{uuid.uuid4().hex}"), total, 100)
    for e, f in enumerate(frames):
        log.append(f, e)
    spark.createDataFrame([(0, 99)], "k long, v long").write.parquet(f"{log.path}/base/upto=6")
    assert sorted(map(tuple, log.read().collect())) == views[0]
    log.fold(6)
    assert sorted(map(tuple, log.read().collect())) == views[0] and log._bases() == 6


def test_a_read_does_not_grow_with_the_epochs(spark):
    log = KeyedLog(spark, scratch_dir(spark, f"log_{uuid.uuid4().hex}"), total, 2)
    for e in range(6):
        log.append(spark.createDataFrame([(e, e)], "k long, v long"), e)
    done = log._bases()
    assert done >= 4
    assert "PartitionFilters: [isnotnull(epoch#" in (p := log.read()._jdf.queryExecution().toString()) and f"> {done})" in p


class _State:
    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


def test_one_call_of_the_state_function_serves_many_lists():
    import pandas as pd

    from tessera.streaming.partial import _step
    text = '[{"name":"a}","length":1},{"name":"b","length":2,"weight":3}]'
    pieces = [(n, i, text[i * 10:i * 10 + 10], i == 6) for n in range(5) for i in range(7)]
    state, got = _State(), []
    for part in (pieces[33::-2], pieces[::2], pieces[3:9]):  # the last pieces come again
        frame = pd.DataFrame(part, columns=["list_id", "seq", "delta", "is_last"])
        got += [r for f in _step((0,), iter([frame[:9], frame[9:]]), state) for r in f.itertuples(index=False, name=None)]
    assert sorted(r[:3] for r in got) == sorted((n, i, last) for n, i, _, last in pieces)
    assert {r[3:] for r in got if r[2]} == {(2, 1, False)}


def test_growing_texts_are_dealt_by_message_and_sorted_after_that(spark):
    from tessera.streaming.streams import merge_messages, merge_windows
    last = "struct<seq: long, text_so_far: string>"
    w = spark.createDataFrame([(1, 2, s // 2, (s, "x" * s)) for s in range(6)],
                              f"conv_id long, turn long, window_start long, last {last}")
    m = spark.createDataFrame([(1, "t", (s, "model", "x" * s), s) for s in range(6)],
                              "conv_id long, timestamp string, last struct<seq: long, role: string, content: string>, first_seq long")
    for rows, merge, key in ((w, merge_windows, "conv_id#"), (m, merge_messages, "conv_id#")):
        merged = merge(rows)
        lines = merged._jdf.queryExecution().executedPlan().toString().splitlines()
        at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(" + key in line]
        assert len(at) == 1 and not any("Exchange" in line for i, line in enumerate(lines) if i not in at)
        assert not any("Aggregate" in line for line in lines[at[0]:])
    assert sorted(r["last"]["seq"] for r in merge_windows(w).collect()) == [1, 3, 5]
    assert [(r["last"]["seq"], r["first_seq"]) for r in merge_messages(m).collect()] == [(5, 0)]
