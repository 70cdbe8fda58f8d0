"""One registered query per operator: its production parameters over its whole table, and the
DuckDB SQL of the result where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import fold_of

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _held_out(doc_id: str, folds: int, fold: int):
    return F.coalesce(fold_of(doc_id, folds) == fold, F.lit(False)).alias("held_out")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL_WORDS = (r"regexp_extract_all(translate(coalesce({}, ''), '" + UPPER + "', '" + LOWER + "'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


@register("op6_decontamination", sql=f"""
WITH items AS (SELECT item_id::VARCHAR AS item_id, {SQL_WORDS.format('text')} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, s, s + least(13, len(w)) - 1) AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {SQL_WORDS.format('text')} AS w FROM documents),
grams AS (
  SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
found AS (SELECT g.doc_id, g.s, g.n, v.item_id FROM grams g JOIN wins v ON g.n = v.n AND g.win = v.win),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a 13-word window of a benchmark item."""
    from .decontam import decontaminate
    out = decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@register("op5_line_dedup", sql=f"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                    '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
f AS (SELECT k, max(doc_id) AS last_doc FROM l WHERE length(k) >= 40
      GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (last_doc IS NOT NULL AND doc_id <> last_doc)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last_doc IS NULL OR doc_id = last_doc), ''))
         AS kept_sha256
FROM l LEFT JOIN f USING (k) GROUP BY doc_id
""")
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand in five documents or more."""
    from .line_dedup import dedup_lines
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(spark, docs, lines=True)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@register("op4_license_scan")
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template spans of every document."""
    from .license_scan import scan
    out = scan(table(spark, sf_dir, "documents"))
    names = lambda *c: F.array_join(F.array_sort(F.array_distinct(F.concat(*c))), ",")
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        names("places.label").alias("base_labels"), names("places.label", "spans.label").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("spans.share"), F.lit(0.0)))
         .alias("score"))


@register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold."""
    from . import language_id as li
    docs = table(spark, sf_dir, "documents")
    profiles = li.fit(docs.where(fold_of("doc_id", 5) != 0))
    return li.predict(docs, profiles).select("doc_id", _held_out("doc_id", 5, 0),
                                             "lang_pred", "score")


def _learned(spark, sf_dir, module, label: str, threshold: float) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = (table(spark, sf_dir, "labels").where(fold_of("doc_id", 4) != 2)
              .select("doc_id", F.col(label).alias("label")))
    scored = module.score(docs, module.fit(docs, labels))
    return scored.select("doc_id", _held_out("doc_id", 4, 2), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    from . import quality
    return _learned(spark, sf_dir, quality, "quality", 0.7)


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    from . import toxicity
    return _learned(spark, sf_dir, toxicity, "toxic", 0.3)


@register("op3_vector_search", sql="""
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors of highest integer inner product for every hundredth vector."""
    from .vector_search import top_k
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(spark, vectors, vectors.where("vec_id % 100 = 0"))


@register("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    from .packing import pack
    from .tokens import vocabulary
    out = pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset")


@register("op10_near_duplicates")
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of equal word sequences and the near-duplicate group of every document."""
    from .near_dup import near_duplicates
    out = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "group_id")


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its personal data are masked by edits."""
    import public_tokenizers

    from . import token_counts as tc
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    trees = tc.build(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return (tc.apply_edits(tc.masking_edits(trees), path, public_tokenizers.PATTERN)
            .select("doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_encoded"))


@register("op11_spelling_variants", sql=f"""
WITH RECURSIVE tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) AS run
  FROM documents),
pairs AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(
      list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: unicode(c)::BIGINT),
      lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + c % 64] END))),
    lambda h, b: xor(h >> 8, t[xor(h, b) % 256 + 1])), 4294967295::BIGINT) AS h
  FROM pairs, tab),
v AS (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2)
           ELSE run END AS word, times FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INTEGER AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN v b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN v b ON a.cut = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS form_n, arg_min(other, (-other_n, other)) AS form
  FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END::BIGINT AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON w.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON f.word = w.word JOIN forms e ON w.at = e.word WHERE e.form IS NULL
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near words, usual form and root of every word of the documents."""
    from .spelling import variants
    return variants(spark, table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@register("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened coordinates of every embedding, one row per component."""
    from .whitening import whiten
    out = whiten(spark, table(spark, sf_dir, "embeddings"))
    pair = F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "pair")
    return (out.select("vec_id", "n", "deviation", "identity_error", pair)
            .select("vec_id", (F.col("component") + 1).alias("component"), "n", "deviation", "pair.whitened",
                    "pair.explained", "identity_error"))


@register("op13_personal_data")
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: the base rules' spans, and all with those the field adds."""
    from . import personal_data as pd
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pd.find(docs, pd.fit(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s.kind == k)).cast("long")
    names = F.array(*map(F.lit, pd.KINDS))
    listed = lambda c: F.array_join(F.transform(
        F.array_sort(c), lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")
    return out.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(pd.KINDS)],
                      F.sha2(listed("base"), 256).alias("base_sha256"),
                      listed(F.concat("base", "added")).alias("spans"))
