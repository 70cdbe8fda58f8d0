import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import token_counts as T

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
COUNTS = T.counter(PATH, PATTERN)
pieces = st.sampled_from(["a", "word", "'", "'s", "'ll", " ", "  ", "\n", "\r\n", "9", "42", "é", "日本", ".", "!?", "\t x", "l"])
texts = st.lists(pieces, max_size=400).map("".join)


@settings(max_examples=150, deadline=None)
@given(texts, st.lists(st.tuples(st.integers(-3, 900), st.integers(-2, 60), texts), max_size=6))
def test_counts_after_edits_are_those_of_the_whole_text(text, edits):
    t, plain = T.CountedText(text, COUNTS), text
    for start, length, new in edits:
        t.edit(start, length, new)
        start = max(0, min(start, len(plain)))
        plain = plain[:start] + new + plain[max(start, min(start + max(length, 0), len(plain))):]
        assert t.text == plain
        assert t.tree.tokens == len(COUNTS.encoding.encode_ordinary(plain))
        assert t.tree.chars == len(plain)


def test_only_touched_leaves_are_encoded():
    text = "some words of a long text, " * 5000
    t = T.CountedText(text, COUNTS)
    t.edit(60_000, 5, "other things")
    assert t.encoded <= 3 * T.LEAF
    assert t.tree.tokens == len(COUNTS.encoding.encode_ordinary(t.text))


def test_tables(spark, make_docs, odd_rows):
    docs = make_docs([(i, t, lang) for i, t, lang in odd_rows if i != 5] + [(12, "mail bob@example.org, +49 123 456 789.", "en")])
    trees = T.build(docs, PATH, PATTERN)
    edits = spark.createDataFrame(
        [(8, 1, 10, 3, "new"), (8, 0, 5, 0, "first "), (2, 0, 99, 1, "grown"), (1, 0, 0, 0, "was null"),
         (7, 0, None, 1, "x"), (9, 0, 100, 5, None), (None, 0, 0, 1, "y")],
        "doc_id long, seq int, start long, length long, replacement string")
    got = {r["doc_id"]: r for r in T.apply_edits(T.with_edits(trees, edits), PATH, PATTERN).collect()}
    n = lambda s: len(COUNTS.encoding.encode_ordinary(s))
    long = dict((i, t) for i, t, _ in odd_rows)[8]
    after = long[:5] + "first " + long[5:]
    after = after[:10] + "new" + after[13:]
    assert got[8]["text"] == after and got[8]["n_tokens"] == n(after) and got[8]["n_edits"] == 2
    assert got[2]["text"] == "grown" and got[1]["text"] == "was null" and got[1]["n_tokens_before"] == 0
    assert got[7]["n_edits"] == 0 and got[9]["text"] == "x" * 29_995 and got[9]["n_tokens"] == n("x" * 29_995)
    assert got[None]["n_edits"] == 0 and got[3]["n_tokens"] == n("   \n\t")
    masked = {r["doc_id"]: r for r in T.apply_edits(T.masking_edits(trees), PATH, PATTERN).collect()}
    assert masked[12]["text"] == "mail [email], [number]." and masked[12]["n_tokens"] == n("mail [email], [number].")
    assert T.apply_edits(T.masking_edits(T.build(make_docs([]), PATH, PATTERN)), PATH, PATTERN).count() == 0


def test_masks_are_those_of_the_plain_patterns():
    import random
    import re
    plain = re.compile(r"(?P<m0>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)|(?P<m1>\+?[0-9][0-9 ()-]{6,}[0-9])")
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@-+ _%(19é") for _ in range(rng.randint(0, 50)))
        want = [(m.start(), m.end() - m.start(), T.MASKS[int(m.lastgroup[1:])][1]) for m in plain.finditer(text)][::-1]
        assert T.mask_places(text) == [{"start": a, "length": n, "replacement": r} for a, n, r in want], text


def test_masking_of_long_runs_ends():
    import time
    for text in ("a" * 1_000_000, "1" + " " * 1_000_000, "a@" * 300_000, "a." * 500_000 + "@", "1-" * 500_000):
        start = time.time()
        T.mask_places(text)
        assert time.time() - start < 10
