import re
import zlib

import pytest

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, key string, label int, row int, "
        "body long, lines int, start long, ids string, item_id string, n_words long, score double, __doc long, __body long, "
        "__lines int, __row long, n_lines long, doc long, parts string, word string, n long, added string, base string")


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table with extra columns whose names the operators use inside, some null."""
    def make(rows):
        full = [(i, t, lang, "s", None if t is None else len(t), None, 1, None, 2, None, 3, "x", None, 4, None,
                 5, None, 6, None, 7, None, "p", None, 8, None, "b")
                for i, t, lang in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null and repeated ids, ties, a very long text, texts of signs only."""
    passage = "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood"
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [(1, None, "en"), (2, "", "en"), (3, "   \n\t", None), (4, "!!! --- ???", "de"), (5, passage, "en"),
            (5, passage, "en"), (6, passage.upper() + "!", "en"), (7, "one two", None), (None, passage, "en"),
            (8, long, "fr"), (9, "x" * 30_000, "es"), (10, "écrit à Paris\nécrit à Paris\n\n", "fr"),
            (11, passage + " again", "en"), (5, "another text with the same number", "en")]
