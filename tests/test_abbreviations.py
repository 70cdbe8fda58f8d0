"""Abbreviations learned from a corpus, against the statistic in plain Python."""
import math
import random
import re
from collections import Counter

import pytest

from tessera.operators import abbreviations as ab
from tessera.operators import sections as sec


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    nouns = ["house", "river", "market", "garden", "window", "letter", "summer", "winter"]
    out = []
    for i in range(n):
        parts = [f"Dr. {rng.choice(nouns).title()} saw the {rng.choice(nouns)}.", f"It was the {rng.choice(nouns)}.",
                 f"Some, e.g. the {rng.choice(nouns)} there, fell at the {rng.choice(nouns)}.", f"We met Mr. {rng.choice(nouns).title()} at the {rng.choice(nouns)}."]
        rng.shuffle(parts)
        out.append((i, " ".join(parts)))
    return out


def brute(rows):
    n, stop = Counter(), Counter()
    for _, text in rows:
        for run in (text or "").lower().split()[:-1]:
            if re.fullmatch(r"[^\W\d_]+(\.[^\W\d_]+)*\.?", run):
                w = run[:-1] if run.endswith(".") else run
                n[w] += 1
                stop[w] += run.endswith(".")
    p = sum(stop.values()) / sum(n.values())

    def like(k, m, q):
        return (k * math.log(q) if k else 0) + ((m - k) * math.log(1 - q) if m - k else 0)
    out = {}
    for w, m in n.items():
        if stop[w]:
            letters = len(w.replace(".", ""))
            score = -2 * (like(stop[w], m, p) - like(stop[w], m, ab.CERTAIN)) * math.exp(-letters)
            out[w] = (m, stop[w], score * (w.count(".") + 1) * letters ** (stop[w] - m))
    return out


def test_scores_equal_the_statistic(spark):
    rows = [*corpus(), (900, None), (901, ""), (902, "one"), (903, "  spaced   out. here\n"), (904, "4th. no word. x_y. end")]
    got = {r.word: r for r in ab.abbreviations(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for w, (n, k, score) in want.items():
        assert (got[w].n, got[w].n_stop) == (n, k) and abs(got[w].score - score) < 1e-5 * max(1, abs(score))
    assert {w for w, r in got.items() if r.abbreviation} == {"dr", "mr", "e.g"}


@pytest.mark.parametrize("empty", [False, True])
def test_sentences_do_not_end_at_learned_abbreviations(spark, empty):
    rows = corpus(n=300)
    docs = spark.createDataFrame([*rows, (900, None), (901, ""), (902, "Ask Dr."), (903, "Dr. Nobody. Mr. Yes! The end")],
                                 "doc_id long, text string").repartition(3)
    known = ab.abbreviations(docs).where("abbreviation")
    if empty:
        known = known.limit(0)
    out = sec.split_sentences(docs, splitter=ab.learned_splitter(known))
    assert out.columns == ["doc_id", "text", "sentences"]
    got = {r.doc_id: r.sentences for r in out.collect()}
    plain = {r.doc_id: r.sentences for r in sec.split_sentences(docs).collect()}
    if empty:
        assert got == plain
        return
    assert all(len(got[i]) == 4 and " ".join(got[i]) == t for i, t in rows)
    assert got[900] is None and got[901] == [] and got[902] == ["Ask Dr."]
    assert got[903] == ["Dr. Nobody.", "Mr. Yes!", "The end"]


def test_empty_corpus(spark):
    assert ab.abbreviations(spark.createDataFrame([], "text string")).collect() == []
