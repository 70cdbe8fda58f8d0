"""Documents -> sentences -> chunks -> section rows.

Every step here is a narrow (per-row) transformation built from array
functions, so a document collection of any size is processed without a
shuffle; the only wide operators are the optional window index and the
language vote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import posexplode_rows

# fixed values: base of documentation URIs (a parameter of doc_sections)
DOC_BASE_URL = "https://docs.example.com/docs/"


def split_sentences(df: DataFrame, text_col: str = "text", out_col: str = "sentences",
                    splitter=None) -> DataFrame:
    """Add ``array<string>`` of sentences.  ``splitter(df, text_col, out_col)`` may replace the
    built-in rule (e.g. a model in an iterator pandas UDF)."""
    if splitter is not None:
        return splitter(df, text_col, out_col)
    return df.withColumn(out_col, tx.sentences(F.col(text_col)))


def chunk_text(df: DataFrame, sentences_col: str = "sentences", batch_size: int = 1,
               out_col: str = "chunks") -> DataFrame:
    """Add ``array<string>`` chunks: ``batch_size`` consecutive sentences joined by a space."""
    return df.withColumn(out_col, tx.chunk_array(F.col(sentences_col), batch_size))


def explode_indexed(df: DataFrame, array_col: str, idx_col: str, value_col: str, keep: list[str],
                    start: int = 0) -> DataFrame:
    """One row per array element, numbered from ``start`` (``posexplode``: no shuffle and no sort)."""
    return posexplode_rows(df, keep, array_col, idx_col, value_col) \
        .withColumn(idx_col, (F.col(idx_col) + start).cast("long"))


def book_sections(chunks: DataFrame, path_col: str = "path", idx_col: str = "chunk_idx",
                  chunk_col: str = "chunk") -> DataFrame:
    """Section rows for chunked files: uri ``{path}/{idx}``, title ``{stem} #{idx}``,
    embedding_content ``title: {title}`` + blank line + content."""
    title = F.concat(tx.path_stem(F.col(path_col)), F.lit(" #"), F.col(idx_col).cast("string"))
    return (chunks
            .withColumn("uri", F.concat(F.col(path_col), F.lit("/"), F.col(idx_col).cast("string")))
            .withColumn("title", title)
            .withColumn("content", F.col(chunk_col))
            .withColumn("embedding_content", F.concat(F.lit("title: "), F.col("title"), F.lit("\n\n"),
                                                      F.col("content"))))


def doc_uri(title, path, base_url: str = DOC_BASE_URL):
    """``{base}{path without .md}/#{slugify(title, '-')}``."""
    return F.concat(F.lit(base_url), F.regexp_replace(path, r"\.md$", ""), F.lit("/#"),
                    tx.slugify(title, "-"))


def doc_sections(df: DataFrame, base_url: str = DOC_BASE_URL) -> DataFrame:
    """Validated DocSection rows -> Section rows (uri, title, content, embedding_content)."""
    emb = F.concat(F.lit("path: "), F.col("path"), F.lit("\n\ntitle: "), F.col("title"), F.lit("\n\n"),
                   F.col("content"))
    return df.select("id", doc_uri(F.col("title"), F.col("path"), base_url).alias("uri"), "title", "content",
                     emb.alias("embedding_content"))


def enumerate_rows(df: DataFrame, group_cols: list[str], order_cols: list[str], start: int = 0,
                   out_col: str = "row_idx") -> DataFrame:
    """Running index per group in the given order, from ``start`` (0 for chunks, 1 for display), for rows
    that come from a table; elements of an array are numbered by ``explode_indexed``."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(out_col, (F.row_number().over(w) - 1 + start).cast("long"))


def split_marked_text(df: DataFrame, text_col: str = "text", out_col: str = "pieces") -> DataFrame:
    return df.withColumn(out_col, tx.split_marked(F.col(text_col)))


# fixed values: language routing of the sentence splitter
SPLITTER_BY_LANG = {"en": "en", "zh": "zh", "zh-cn": "zh", "zh-tw": "zh"}
NO_SPLITTER = "no sentence splitter for this language"


def route_by_language(df: DataFrame, lang_col: str = "lang", strict: bool = False) -> DataFrame:
    """Add ``splitter`` (en / zh) and ``reject_reason`` (``NO_SPLITTER``); ``zh`` is what
    the detector here emits.

    With ``strict=True`` a language without a splitter fails the job, whatever columns are read."""
    known = F.create_map(*[F.lit(x) for kv in SPLITTER_BY_LANG.items() for x in kv])
    splitter = F.try_element_at(known, F.col(lang_col))
    if strict:
        df = df.where(F.when(splitter.isNotNull(), F.lit(True))
                      .otherwise(F.raise_error(F.lit(NO_SPLITTER)).cast("boolean")))
    return (df.withColumn("splitter", splitter)
              .withColumn("reject_reason", F.when(F.col("splitter").isNull(), F.lit(NO_SPLITTER))))


# fixed values: function words used by the built-in language identifier (ours)
FUNCTION_WORDS = {
    "en": ["the", "and", "of", "to", "in", "is", "that", "it", "was", "for", "with", "as", "on", "by",
           "this", "are", "from", "be"],
    "fr": ["le", "la", "les", "des", "du", "de", "et", "un", "une", "est", "qui", "dans", "pour", "par",
           "sur", "avec", "au", "aux"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "den", "dem", "zu", "von", "mit", "sich", "ein",
           "eine", "auf", "für", "im"],
    "es": ["el", "los", "las", "del", "y", "que", "en", "una", "por", "con", "para", "es", "se", "al",
           "lo", "su"],
}
HAN_SHARE = 0.3


def detect_language(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    detector=None) -> DataFrame:
    """(id, detected_lang, hits): the language whose function words occur most often
    (ties by language code); texts with a Han-character share above ``HAN_SHARE`` are ``zh``;
    no hit at all gives ``unknown``.

    Narrow: one pattern takes all function words of a text, in any language, as whole tokens, and each
    language counts its own among them.  No row is exploded and nothing is shuffled."""
    if detector is not None:
        return detector(df, id_col, text_col)
    langs = sorted(FUNCTION_WORDS)
    every = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})
    word = r"[\p{L}\p{N}_]"
    found = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(f"(?<!{word})(?:{'|'.join(every)})(?!{word})"), 0)
    n_chars = F.length(F.regexp_replace(F.col(text_col), r"\s", ""))
    han = F.length(F.regexp_replace(F.col(text_col), r"[^\p{IsHan}]", ""))
    mostly_han = F.when(n_chars > 0, han / n_chars > HAN_SHARE).otherwise(F.lit(False))
    per = df.select(id_col, mostly_han.alias("han"), found.alias("found"))
    count = lambda lg: F.size(F.filter("found", lambda w: w.isin(*FUNCTION_WORDS[lg])))
    per = per.select(id_col, "han", *[F.coalesce(F.greatest(count(lg), F.lit(0)), F.lit(0)).alias(f"n_{lg}")
                                      for lg in langs])
    best = F.greatest(*[F.col(f"n_{lg}") for lg in langs])
    pick = None
    for lg in langs:  # alphabetical: the first language reaching the maximum wins a tie
        cond = F.col(f"n_{lg}") == best
        pick = F.when(cond, F.lit(lg)) if pick is None else pick.when(cond, F.lit(lg))
    detected = F.when(F.col("han"), F.lit("zh")).when(best == 0, F.lit("unknown")).otherwise(pick)
    return per.select(id_col, detected.alias("detected_lang"), best.cast("long").alias("hits"))
