"""The column rules against straightforward Python versions of the same rules.

Random strings (fixed seed) mix ASCII and accented letters, digits, CJK text and punctuation,
whitespace, brackets and URL fragments.  Sentences are compared with a plain Python model of the
"""

import random
import re

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.plans.common import table

PIECES = ["a", "b", "Z", "é", "ü", "ß", "ç", "ñ", "你", "好", "0", "7", "_", " ", "  ", "\n", "\t", ".", "!", "?",
          "...", "。", "！", "？", ",", "-", "--", "(", ")", "[", "]", "http://a.b/c", "https://x.y/z?q=1",
          "[l](http://m.n/o)", "the", "and", "with", "cafx", "Word", "naïve", "ab", "abc_d", "3.14", "ﬁ", "½"]


def random_texts(n=400, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def py_sentences(t):
    m = re.sub(r"([.!?]+)\s+", "\\1\x01", t, flags=re.ASCII)
    m = re.sub(r"([。！？]+)\s*", "\\1\x01", m, flags=re.ASCII)
    parts = [re.sub(r"^\s+|\s+$", "", p, flags=re.ASCII) for p in m.split("\x01")]
    return [p for p in parts if p]


def run(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r["i"]: r["r"] for r in df.select("i", expr(F.col("t")).alias("r")).collect()}


def test_sentences_model(spark):
    texts = random_texts()
    got = run(spark, texts, tx.sentences)
    bad = [(t, got[i], py_sentences(t)) for i, t in enumerate(texts) if got[i] != py_sentences(t)]
    assert not bad, bad[:3]


def test_key_terms_by_properties(spark):
    texts = random_texts(seed=11)
    got = run(spark, texts, tx.key_terms)
    for i, t in enumerate(texts):
        places = [t.lower().find(w) for w in got[i]]
        assert len(got[i]) <= 5 and len(set(got[i])) == len(got[i]) and min(places, default=0) >= 0
        assert all(w.isascii() and w.isalpha() and len(w) > 2 and w not in tx.KEY_TERM_STOPWORDS for w in got[i])


def test_key_terms_literal(spark):
    texts = ["The cat and THE Cat sat; dogs ran, birds flew away home", "ab a1b2c3 naïve", "x_yz word_s one-two"]
    got = run(spark, texts, tx.key_terms)
    assert got[0] == ["cat", "sat", "dogs", "ran", "birds"] and got[1] == [] and got[2] == ["one", "two"]


def test_urls_by_properties(spark):
    texts = random_texts(seed=13)
    got = run(spark, texts, tx.extract_urls)
    for i, t in enumerate(texts):
        assert len(set(got[i])) == len(got[i])
        assert all(u in t and u.startswith("http") and not set(u) & set(" \n\t)") for u in got[i])


def test_urls_literal(spark):
    texts = ["see [a](http://x.y/z) and https://q.r/s, http://x.y/z", "http://p.q [b](https://m.n)"]
    got = run(spark, texts, tx.extract_urls)
    assert got[0] == ["http://x.y/z", "https://q.r/s,"] and got[1] == ["https://m.n", "http://p.q"]


def test_slugify_literal(spark):
    texts = ["Hello,  World!", "Crème Brûlée -- now", "ﬁne ½ Ünder_score", "  trim  me  ", "你好"]
    got = run(spark, texts, lambda c: tx.slugify(c, "-"))
    assert [got[i] for i in range(5)] == ["hello-world", "creme-brulee-now", "fine-12-under_score", "trim-me", ""]


def test_sentences_model_on_documents(spark, sf_small):
    rows = table(spark, sf_small, "documents").select("doc_id", "text", tx.sentences(F.col("text")).alias("s")).collect()
    bad = [r["doc_id"] for r in rows if r["s"] != py_sentences(r["text"])]
    assert not bad, bad[:5]
