"""Column expressions for text: sentences, chunks, tokens, slugs, URLs, HTML.

All rules are written with built-in Spark SQL functions so they stay inside
whole-stage code generation and need no Python worker.  Patterns avoid
lookaround and ``\\b`` so the same rule runs unchanged in Java regex and in
RE2 (the DuckDB oracle).
"""

from __future__ import annotations

import pandas as pd
import unicodedata
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Marker placed at sentence boundaries before splitting.
SENTENCE_MARK = "\u0001"
# Sentence ends: Latin terminators followed by whitespace; CJK terminators
# followed by optional whitespace.
LATIN_END = r"([.!?]+)\s+"
CJK_END = "([。！？]+)\\s*"
# Key-term rule: word tokens are runs of letters, digits and underscore;
# a key term is an all-ASCII-lower-case token of three letters or more.
WORD_TOKEN = r"[\p{L}\p{N}_]+"
KEY_TERM = r"^[a-z]{3,}$"
# The same rule as one pattern: a run of 3+ ASCII lower-case letters that is a whole word token
# (no letter, digit or underscore right before or after it).
KEY_TERM_IN_TEXT = r"(?<![\p{L}\p{N}_])[a-z]{3,}(?![\p{L}\p{N}_])"
# Stopwords dropped from key terms, in the order given by the reference.
KEY_TERM_STOPWORDS = ["the", "and", "that", "this", "with", "for", "are", "from"]
KEY_TERM_COUNT = 5
# URL patterns: Markdown links first, then bare URLs.
MD_LINK_URL = r"\]\((https?://[^\s)]+)\)"
BARE_URL = r"(https?://[^\s)\]]+)"
# Citation marker such as [3].
CITATION_MARK = r"\[\d+\]"
# Separator for pre-split text.
SPLIT_MARK = "<<<SPLIT>>>"
# -----------------------------------------------------------------------------


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def sentences(text: Column) -> Column:
    """array<string> of sentences: a marker after every terminator run (the whitespace that
    follows it is consumed), split on the marker, pieces stripped, empty pieces dropped.

    Because each boundary consumes the whitespace after it and sits right after the
    punctuation, only the first and last piece can carry edge whitespace; stripping the whole
    text once is therefore the same as stripping every piece, and keeps the rule free of
    per-piece lambdas (built-in functions only)."""
    marked = F.regexp_replace(strip_ws(text), LATIN_END, "$1" + SENTENCE_MARK)
    marked = F.regexp_replace(marked, CJK_END, "$1" + SENTENCE_MARK)
    return F.array_remove(F.split(marked, SENTENCE_MARK, -1), "")


def chunk_array(sents: Column, batch_size: int) -> Column:
    """Group consecutive sentences into chunks of ``batch_size`` joined by one space.

    ``batch_size < 2`` keeps one sentence per chunk.  Pure array functions:
    no explode, no shuffle, order preserved.
    """
    if batch_size < 2:
        return sents
    n = F.size(sents)
    last = F.ceil(n / F.lit(batch_size)).cast("int") - 1
    starts = F.when(n > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(sents, i * batch_size + 1, batch_size), " "))


NON_WORD = r"[^\p{L}\p{N}_]+"


def word_tokens(text: Column) -> Column:
    """Lower-cased word tokens (letters, digits, underscore; Unicode-aware).

    Same tokens as extracting ``WORD_TOKEN`` matches, computed as a split on the complement
    class with empty edge pieces removed (a built-in, no lambda), which is faster."""
    return F.array_remove(F.split(F.lower(text), NON_WORD, -1), "")


def key_terms(text: Column, n: int = KEY_TERM_COUNT) -> Column:
    """First ``n`` distinct ASCII key terms in order of first occurrence, stopwords dropped
    (the text is lower-cased before tokenising, as the reference does).

    Whole-token ASCII runs are extracted by one lookaround pattern (Java regex), which selects
    exactly the word tokens that fully match ``[a-z]{3,}`` without a per-token lambda, so the
    expression stays in generated code."""
    toks = F.regexp_extract_all(F.lower(text), F.lit(KEY_TERM_IN_TEXT), 0)
    stop = F.array(*[F.lit(s) for s in KEY_TERM_STOPWORDS])
    return F.slice(F.array_except(toks, stop), 1, n)


def extract_urls(text: Column) -> Column:
    """Markdown-link URLs then bare URLs, first occurrence kept."""
    md = F.regexp_extract_all(text, F.lit(MD_LINK_URL), 1)
    bare = F.regexp_extract_all(text, F.lit(BARE_URL), 1)
    return F.array_distinct(F.concat(md, bare))


def strip_citations(text: Column) -> Column:
    return F.regexp_replace(text, CITATION_MARK, "")


def split_marked(text: Column) -> Column:
    """Split on the explicit marker, strip pieces, drop empty ones."""
    parts = F.split(text, F.lit(SPLIT_MARK), -1)
    return F.filter(F.transform(parts, strip_ws), lambda s: s != F.lit(""))


def file_slug(topic: Column) -> Column:
    """Report file name: every char outside [a-zA-Z0-9] becomes '_', lower-cased, '.md' added."""
    return F.concat(F.lower(F.regexp_replace(topic, r"[^a-zA-Z0-9]", "_")), F.lit(".md"))


def path_stem(path: Column) -> Column:
    """File name without directory and without the last suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


@F.pandas_udf(T.StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """NFKD-normalise and drop everything outside ASCII (no built-in does NFKD)."""
    return s.map(lambda v: None if v is None else
                 unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode("ascii"))


def slugify(value: Column, separator: str = "-", unicode: bool = False) -> Column:
    """URL slug: (ASCII fold) → drop [^\\w\\s-] → strip → lower → collapse separator/space runs."""
    v = value if unicode else ascii_fold(value)
    word = r"\p{L}\p{N}_" if unicode else r"a-zA-Z0-9_"
    v = F.regexp_replace(v, rf"[^{word}\s-]", "")
    v = F.lower(strip_ws(v))
    sep = separator.replace("\\", "\\\\").replace("]", "\\]").replace("-", "\\-")
    return F.regexp_replace(v, rf"[{sep}\s]+", separator.replace("$", "\\$"))


def html_to_text(html: Column) -> Column:
    """Readable text from raw HTML: drop script/style/comments, tags, decode basic entities,
    collapse whitespace."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return strip_ws(F.regexp_replace(t, r"\s+", " "))


# fixed values: HTML entities decoded by html_to_text (&amp; last)
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def html_title(html: Column) -> Column:
    return strip_ws(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1))
