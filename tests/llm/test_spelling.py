import random
import re
import zlib
from collections import Counter

from tessera.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by trying all of them."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=7, noise=31, ratio=10):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= min_length:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2}
    out, form = [], {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
        out.append([w, form.get(w), None, n[w], len(close), n[form[w]] if w in form else None])
    for row in out:
        root = row[0]
        while root in form:
            root = form[root]
        row[2] = root
    return sorted(map(tuple, out))


def run(spark, docs):
    got = S.variants(spark, docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, got))


def test_variants_equal_all_pairs(spark):
    rng = random.Random(3)
    stems = ["thanouing", "thanouer", "wörterbücher", "aaaaaaaa", "aaaaaaaab", "ababababab", "Straßenbahn×÷"]
    words = []
    for _ in range(900):
        w = rng.choice(stems)
        for _ in range(rng.randint(0, 2)):
            k, c = rng.randrange(len(w) + 1), rng.choice(["a", "b", "ö", "n", ""])
            w = w[:k] + c + w[k + rng.randint(0, 1):]
        words += [w] * rng.choice([1, 1, 2, 3, 30, 400])
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    assert run(spark, spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_large_blocks_are_split_and_nothing_is_lost(spark, monkeypatch):
    """Words with one prefix and suffix: blocks of any bound find the same pairs."""
    rng = random.Random(5)
    vocab = {"preface" + "".join(rng.choice("ab") for _ in range(rng.randint(2, 7))) + "suffix" for _ in range(250)}
    rows = [(0, " ".join(vocab)), (1, " ".join(vocab))]
    frame = spark.createDataFrame([(w, 2) for w in vocab], "word string, n long")
    want = {w: (k, min(c)) for w in vocab if (k := len(c := [x for x in vocab if near(w, x)]))}
    for limit in (2, 10_000):
        monkeypatch.setattr(S, "BLOCK_ROWS", limit)
        monkeypatch.setattr(S, "BLOCK_CELLS", limit)
        got = {r.word: (r.n_near, r.near) for r in S.neighbours(spark, frame).collect()}
        assert got == want
    assert {r[0] for r in run(spark, spark.createDataFrame(rows, "doc_id long, text string"))} <= {
        *vocab, *(w[:i] + w[i + 1:] for w in vocab for i in range(len(w)))}


def test_odd_rows(spark, make_docs, odd_rows):
    rows = odd_rows + [(20, "chains chains chainss", "en"), (21, "x" * 30_000 + " " + "y" * 30_001, "en"),
                       (22, "x" * 29_999 + " Überall überall ÜBERALL überall", "en")]
    assert run(spark, make_docs(rows)) == brute([(i, t) for i, t, _ in rows])
    assert run(spark, make_docs([])) == []


def test_any_code_points(spark):
    """The neighbour search itself takes words of any script."""
    vocab = spark.createDataFrame([("猫", 5), ("犬", 9), ("😀a", 3), ("😀", 2), ("zz", 1)], "word string, n long")
    got = {r.word: (r.n_near, r.near, r.near_n) for r in S.neighbours(spark, vocab).collect()}
    assert got == {"猫": (2, "犬", 9), "犬": (2, "猫", 5), "😀": (3, "犬", 9), "😀a": (1, "😀", 2)}
