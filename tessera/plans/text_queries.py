"""Registered queries: text ingest, sections, embeddings and retrieval."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import abbreviations as ab
from ..operators import retrieval as rt
from ..operators import sections as sec
from ..operators import vector_index as vi
from ..session import scratch_dir
from ..sinks import store as st
from ..sinks.named_files import write_named_files
from ..sources import files as fs
from . import fixtures as fx
from .common import (q, register, sql_chunks, sql_sentences, sql_slug, sql_stem, sql_strip,
                     sql_word_tokens, table)

NL = "\n"
DIM = vx.DEFAULT_DIM
K = rt.DEFAULT_K

# --- oracle building blocks ---------------------------------------------------
SQL_SENTENCES = f"SELECT doc_id, source, lang, {sql_sentences('text')} AS sents FROM documents"
SQL_CHUNKS = f"""
SELECT doc_id, source, path, unnest(range(len(ch))) AS chunk_idx, unnest(ch) AS chunk
FROM (SELECT doc_id, source, 'books/' || source || '/' || doc_id || '.pdf' AS path,
             {sql_chunks('sents', fx.CHUNK_SENTENCES)} AS ch FROM ({SQL_SENTENCES}))"""
SQL_SECTIONS = f"""
SELECT doc_id, chunk_idx, uri, title, content, 'title: ' || title || '{NL}{NL}' || content AS embedding_content
FROM (SELECT doc_id, chunk_idx, path || '/' || chunk_idx AS uri,
             {sql_stem('path')} || ' #' || chunk_idx AS title, chunk AS content FROM ({SQL_CHUNKS}))"""


def sql_embed(src: str, id_col: str, text_col: str, dim: int = DIM) -> str:
    """(id, emb DOUBLE[]) hashed embedding of ``text_col`` for every row of ``src``."""
    return f"""
(WITH tok AS (SELECT {id_col} AS id, unnest({sql_word_tokens(text_col)}) AS t FROM ({src})),
 hb AS (SELECT id, ('0x' || substr(md5(t), 1, 7))::BIGINT % {dim} AS b,
               CASE WHEN ('0x' || substr(md5(t), 8, 1))::BIGINT % 2 = 0 THEN 1 ELSE -1 END AS sg FROM tok),
 g AS (SELECT id, b, sum(sg) AS c FROM hb GROUP BY id, b),
 ids AS (SELECT {id_col} AS id FROM ({src})),
 nr AS (SELECT ids.id, coalesce(sqrt(sum(g.c * g.c)), 0) AS nrm FROM ids LEFT JOIN g ON g.id = ids.id GROUP BY ids.id)
 SELECT nr.id, list(CASE WHEN nr.nrm > 0 THEN coalesce(g.c, 0) / nr.nrm ELSE 0.0 END ORDER BY r.i) AS emb
 FROM nr CROSS JOIN range({dim}) r(i) LEFT JOIN g ON g.id = nr.id AND g.b = r.i
 GROUP BY nr.id)"""


def sql_knn(queries: str, corpus: str, dist: str, k: int = K, id_name: str = "vec_id") -> str:
    """queries/corpus: relations (id, emb).  dist: expression over qe, ce."""
    return f"""
SELECT query_id, rank, {id_name}, distance FROM (
  SELECT qq.id AS query_id, cc.id AS {id_name}, round({dist}, 6) AS distance,
         row_number() OVER (PARTITION BY qq.id ORDER BY round({dist}, 6), cc.id) AS rank
  FROM (SELECT id, emb AS qe FROM {queries}) qq, (SELECT id, emb AS ce FROM {corpus}) cc
  WHERE {dist} IS NOT NULL)
WHERE rank <= {k}"""


L2 = "list_distance(qe, ce)"
COS = "(1 - list_cosine_similarity(qe, ce))"

# --- sentences, chunks, sections ----------------------------------------------


@register("split_sentences", f"""
SELECT doc_id, unnest(range(len(sents))) AS sent_idx, unnest(sents) AS sentence FROM ({SQL_SENTENCES})""")
def q_split_sentences(spark, sf):
    s = fx.doc_sentences(spark, sf)
    return sec.explode_indexed(s, "sentences", "sent_idx", "sentence", ["doc_id"])


SQL_ABBREVIATIONS = f"""
WITH runs AS (SELECT list_filter(string_split_regex(lower(text), '\\s+'), lambda r: r <> '') AS l FROM documents),
words AS (SELECT unnest(list_slice(l, 1, len(l) - 1)) AS run FROM runs),
counts AS (SELECT regexp_replace(run, '\\.$', '') AS word, count(*) AS n, count(*) FILTER (run LIKE '%.') AS n_stop
           FROM words WHERE regexp_full_match(run, '[\\p{{L}}]+(\\.[\\p{{L}}]+)*\\.?') GROUP BY 1),
total AS (SELECT sum(n_stop)::DOUBLE / sum(n)::DOUBLE AS p FROM counts),
l AS (SELECT word, n, n_stop, length(replace(word, '.', ''))::DOUBLE AS letters,
             (CASE WHEN n_stop = 0 THEN 0 ELSE n_stop * ln(p) END + CASE WHEN n = n_stop THEN 0 ELSE (n - n_stop) * ln(1 - p) END)
             - (n_stop * ln({ab.CERTAIN}::DOUBLE) + (n - n_stop) * ln(1 - {ab.CERTAIN}::DOUBLE)) AS d
      FROM counts, total WHERE n_stop > 0),
s AS (SELECT word, n, n_stop, round(-2 * d * exp(-letters) * (length(word) - letters + 1) * pow(letters, n_stop - n), 6) AS score FROM l)
SELECT word, n, n_stop, score + 0.0 AS score, score >= {ab.SCORE} AS abbreviation FROM s"""


@register("abbreviations", SQL_ABBREVIATIONS)
def q_abbreviations(spark, sf):
    """The score of every word of the documents that stands before a full stop."""
    a = ab.abbreviations(table(spark, sf, "documents").select("text"))
    return a.withColumn("score", F.col("score") + F.lit(0.0))


@register("split_sentences_learned", f"""
WITH known AS (SELECT word FROM ({SQL_ABBREVIATIONS}) WHERE abbreviation),
s AS (SELECT doc_id, unnest(range(len(sents))) AS pos, unnest(sents) AS sentence FROM ({SQL_SENTENCES})),
w AS (SELECT *, sentence LIKE '%.' AND regexp_replace(string_split_regex(lower(sentence), '\\s+')[-1], '\\.$', '')
                IN (SELECT word FROM known) AS held FROM s),
g AS (SELECT *, coalesce(sum(CASE WHEN held THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS sent_idx FROM w)
SELECT doc_id, sent_idx, string_agg(sentence, ' ' ORDER BY pos) AS sentence FROM g GROUP BY doc_id, sent_idx""")
def q_split_sentences_learned(spark, sf):
    """Sentences that do not end at the abbreviations learned from all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    known = ab.abbreviations(docs).where("abbreviation")
    s = sec.split_sentences(docs, splitter=ab.learned_splitter(known))
    return sec.explode_indexed(s, "sentences", "sent_idx", "sentence", ["doc_id"])


@register("chunk_text", f"SELECT doc_id, chunk_idx, chunk FROM ({SQL_CHUNKS})")
def q_chunk_text(spark, sf):
    return fx.doc_chunks(spark, sf).select("doc_id", "chunk_idx", "chunk")


@register("book_sections", SQL_SECTIONS)
def q_book_sections(spark, sf):
    return fx.chunk_sections(spark, sf)


@register("enumerate_rows", f"""
SELECT doc_id, sent_idx, row_number() OVER (PARTITION BY doc_id ORDER BY sent_idx) - 1 AS row_idx, md5(sentence) AS sentence_md5
FROM (SELECT doc_id, unnest(range(len(sents))) AS sent_idx, unnest(sents) AS sentence FROM ({SQL_SENTENCES}))""")
def q_enumerate_rows(spark, sf):
    """Running index of every document's sentences, numbered as rows of a table."""
    s = sec.explode_indexed(fx.doc_sentences(spark, sf), "sentences", "sent_idx", "sentence", ["doc_id"])
    s = s.select("doc_id", "sent_idx", F.md5("sentence").alias("sentence_md5"))
    return sec.enumerate_rows(s, ["doc_id"], ["sent_idx"], start=0).select("doc_id", "sent_idx", "row_idx", "sentence_md5")


@register("enumerate_table_rows", """
SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_idx FROM documents""")
def q_enumerate_table_rows(spark, sf):
    """Display numbers of every source's documents."""
    d = table(spark, sf, "documents").select("source", "doc_id")
    return sec.enumerate_rows(d, ["source"], ["doc_id"], start=1)


@register("split_marked_text", f"""
SELECT doc_id, unnest(range(len(p))) AS piece_idx, unnest(p) AS piece FROM (
  SELECT doc_id, list_filter(list_transform(string_split(txt, {q(tx.SPLIT_MARK)}), lambda s: {sql_strip('s')}),
                             lambda s: s <> '') AS p
  FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0
                            THEN array_to_string(sents, {q(tx.SPLIT_MARK)}) || {q(tx.SPLIT_MARK + '   ' + tx.SPLIT_MARK)}
                            ELSE array_to_string(sents, {q(tx.SPLIT_MARK)}) END AS txt
        FROM ({SQL_SENTENCES})))""")
def q_split_marked_text(spark, sf):
    m = sec.split_marked_text(fx.marked_text(spark, sf))
    return sec.explode_indexed(m, "pieces", "piece_idx", "piece", ["doc_id"])


# --- embeddings and retrieval --------------------------------------------------


@register("embed_text", f"""
SELECT id AS doc_id, i - 1 AS dim_idx, round(v, 6) AS value
FROM (SELECT id, unnest(emb) AS v, unnest(range(1, len(emb) + 1)) AS i
      FROM {sql_embed('SELECT doc_id, text FROM documents', 'doc_id', 'text')})
WHERE v <> 0""")
def q_embed_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    e = vx.check_dim(vx.embed_text(d, "text", "embedding", DIM), "embedding", DIM)
    return vx.sparse_components(e, "doc_id")


_VEC = "(SELECT vec_id AS id, embedding::DOUBLE[] AS emb FROM embeddings)"
_SCALED = "(SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE * (1 + vec_id % 5)) AS emb FROM embeddings)"


@register("knn_l2", sql_knn(_VEC, _VEC, L2))
def q_knn_l2(spark, sf):
    e = table(spark, sf, "embeddings")
    return rt.knn(e, e.withColumnRenamed("vec_id", "query_id"), k=K, metric="l2")


@register("knn_cosine", sql_knn(_SCALED, _SCALED, COS))
def q_knn_cosine(spark, sf):
    e = fx.scaled_vectors(spark, sf)
    return rt.knn(e, e.withColumnRenamed("vec_id", "query_id"), k=K, metric="cosine")


# the hyperplane index in SQL: planes by md5, cells by signs, cells visited by rising cost until they hold the
# rows that the sampled queries needed
SQL_KNN_APPROX = f"""
WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v,
                  list_transform(embedding, lambda x: floor(x::DOUBLE * {int(vi.UNIT)})) AS w FROM embeddings),
size AS (SELECT count(*) AS n, max(len(v)) AS dim,
                least({vi.MAX_PLANES}, greatest(0, floor(log2(greatest(count(*) // {vi.PLANE_ROWS}, 1)))))::INT AS planes FROM e),
planes AS (SELECT j, list(1.0::DOUBLE - 2 * (('0x' || md5({vi.PLANE_SEED} || ':' || j || ':' || i)[1])::INT % 2) ORDER BY i) AS s
           FROM size, range({vi.MAX_PLANES}) a(j), range(4096) b(i) WHERE j < planes AND i < dim GROUP BY j),
m AS (SELECT id, j, list_dot_product(w, s)::BIGINT AS m FROM e, planes),
code AS (SELECT e.id, coalesce(sum(CASE WHEN m >= 0 THEN 1 << j::INT ELSE 0 END), 0)::INT AS cell
         FROM e LEFT JOIN m ON m.id = e.id GROUP BY e.id),
cells AS (SELECT cell, count(*) AS n FROM code GROUP BY cell),
cost AS (SELECT e.id AS qid, c.cell, any_value(c.n) AS n,
                coalesce(sum(CASE WHEN (m >= 0)::INT <> (c.cell >> j::INT) % 2 THEN abs(m) ELSE 0 END), 0) AS cost
         FROM e CROSS JOIN cells c LEFT JOIN m ON m.id = e.id GROUP BY e.id, c.cell),
seen AS (SELECT qid, cell, coalesce(sum(n) OVER (PARTITION BY qid ORDER BY cost, cell
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM cost),
pairs AS (SELECT q.id AS qid, c.id, round(list_distance(q.v, c.v), 6) AS distance FROM e q, e c),
asked AS (SELECT id FROM e ORDER BY md5(id::VARCHAR), id LIMIT {vi.RECALL_QUERIES}),
exact AS (SELECT qid, id FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rn
                               FROM pairs WHERE qid IN (SELECT id FROM asked)) WHERE rn <= {K}),
need AS (SELECT list_sort(list(seen))[greatest(1, ceil({vi.SAMPLE_RECALL}::DOUBLE * count(*)))::INT] + 1 AS need
         FROM exact JOIN code USING (id) JOIN seen ON seen.qid = exact.qid AND seen.cell = code.cell)
SELECT query_id, rank, vec_id, distance FROM (
  SELECT p.qid AS query_id, p.id AS vec_id, p.distance,
         row_number() OVER (PARTITION BY p.qid ORDER BY p.distance, p.id) AS rank
  FROM pairs p JOIN code USING (id) JOIN seen s ON s.qid = p.qid AND s.cell = code.cell
  WHERE s.seen < (SELECT greatest({K}, need) FROM need))
WHERE rank <= {K}"""


@register("knn_approx", SQL_KNN_APPROX)
def q_knn_approx(spark, sf):
    e = table(spark, sf, "embeddings")
    return rt.knn_approx(e, e.withColumnRenamed("vec_id", "query_id"), k=K)


def section_store(spark, sf):
    """A store with the sections of every document, embedded once."""
    store = st.SectionStore.create(spark, scratch_dir(spark, f"store_{uuid.uuid4().hex}"), dim=DIM)
    store.load(fx.chunk_sections(spark, sf).withColumn("pos", F.struct("doc_id", "chunk_idx")))
    return store


def embedded_queries(spark, sf):
    return vx.embed_text(fx.text_queries(spark, sf), "text", "embedding", DIM)


def context_for_queries(spark, sf):
    """The minimum slice: documents -> sentences -> chunks(10) -> sections -> loaded store ->
    exact L2 top-10 by uri for every benchmark text -> rendered context."""
    store, qs = section_store(spark, sf), embedded_queries(spark, sf)
    hits = store.index().search(qs, K, id_col="uri")
    return rt.format_context(qs, hits, store.sections(), id_col="uri")


_SECS = f"(SELECT * FROM ({SQL_SECTIONS}))"
_SEC_EMB = sql_embed(SQL_SECTIONS, "uri", "embedding_content")
_Q_EMB = sql_embed("SELECT item_id, text FROM benchmark", "item_id", "text")
SQL_HITS = sql_knn(_Q_EMB, _SEC_EMB, L2, id_name='uri')
SQL_CONTEXT = f"""
WITH hits AS ({SQL_HITS}),
secs AS {_SECS}
SELECT b.item_id AS query_id,
       coalesce(string_agg('# ' || s.title || '{NL}URI:' || s.uri || '{NL}{NL}' || s.content || '{NL}',
                           '{NL}{NL}' ORDER BY h.rank), '') AS context
FROM benchmark b LEFT JOIN hits h ON h.query_id = b.item_id LEFT JOIN secs s ON s.uri = h.uri
GROUP BY b.item_id"""


@register("format_context", SQL_CONTEXT)
def q_format_context(spark, sf):
    return context_for_queries(spark, sf)


@register("knn_sections", f"SELECT query_id, rank, uri, distance FROM ({SQL_HITS})")
def q_knn_sections(spark, sf):
    return section_store(spark, sf).index().search(embedded_queries(spark, sf), K, id_col="uri")


# --- sources and per-document projections ------------------------------------


@register("list_files")
def q_list_files(spark, sf):
    return fs.list_files(spark, sf, ".parquet").select("name", "length")


@register("read_text_docs", "SELECT doc_id, md5(text) AS text_md5, length(text) AS n_chars FROM documents")
def q_read_text_docs(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    folder = scratch_dir(spark, f"text_docs_{uuid.uuid4().hex}")
    write_named_files(d.withColumn("name", F.concat("doc_id", F.lit(".md"))), folder)
    r = fs.read_text_docs(spark, folder)
    return r.select(F.regexp_extract("name", r"^(-?\d+)\.md$", 1).cast("long").alias("doc_id"),
                    F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


SQL_DOC_ROWS = """
SELECT doc_id::INT AS id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE doc_id - 1 END::INT AS parent,
       source || '/' || lang || '.md' AS path, (doc_id % 3 + 1)::INT AS level, text AS title,
       text AS content FROM documents"""


@register("read_doc_sections", f"SELECT id, parent, path, level, title, md5(content) AS content_md5 FROM ({SQL_DOC_ROWS})")
def q_read_doc_sections(spark, sf):
    rows = fx.doc_section_rows(spark, sf)
    folder = fs.write_json_lines(rows, scratch_dir(spark, "doc_sections"))
    r = fs.read_doc_sections(spark, folder)
    return r.select("id", "parent", "path", "level", "title", F.md5("content").alias("content_md5"))


@register("slugify", f"SELECT id, {sql_slug('title')} AS slug FROM ({SQL_DOC_ROWS})")
def q_slugify(spark, sf):
    return fx.doc_section_rows(spark, sf).select("id", tx.slugify(F.col("title"), "-").alias("slug"))


@register("doc_sections", f"""
SELECT id, '{sec.DOC_BASE_URL}' || regexp_replace(path, '\\.md$', '') || '/#' || {sql_slug('title')} AS uri, title,
       md5(content) AS content_md5,
       md5('path: ' || path || '{NL}{NL}title: ' || title || '{NL}{NL}' || content) AS embedding_content_md5
FROM ({SQL_DOC_ROWS})""")
def q_doc_sections(spark, sf):
    s = sec.doc_sections(fx.doc_section_rows(spark, sf))
    return s.select("id", "uri", "title", F.md5("content").alias("content_md5"),
                    F.md5("embedding_content").alias("embedding_content_md5"))


@register("route_by_language", f"""
SELECT doc_id, lang, CASE WHEN lang = 'en' THEN 'en' WHEN lang IN ('zh', 'zh-cn', 'zh-tw') THEN 'zh' END AS splitter,
       CASE WHEN lang = 'en' OR lang IN ('zh', 'zh-cn', 'zh-tw') THEN NULL ELSE '{sec.NO_SPLITTER}' END AS reject_reason
FROM documents""")
def q_route_by_language(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return sec.route_by_language(d)


def _sql_function_words() -> str:
    rows = ", ".join(f"({q(lang)}, {q(w)})" for lang, ws in sec.FUNCTION_WORDS.items() for w in ws)
    return f"(VALUES {rows}) fw(lang, word)"


@register("detect_language", f"""
WITH toks AS (SELECT doc_id, unnest({sql_word_tokens('text')}) AS word FROM documents),
votes AS (SELECT doc_id, lang, count(*) AS hits FROM toks JOIN {_sql_function_words()} USING (word) GROUP BY ALL),
best AS (SELECT doc_id, lang, hits FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, lang) AS rn
                                         FROM votes) WHERE rn = 1),
base AS (SELECT doc_id, length(regexp_replace(text, '\\s', '', 'g')) AS n,
                length(regexp_replace(text, '[^\\p{{Han}}]', '', 'g')) AS han FROM documents)
SELECT base.doc_id, CASE WHEN n > 0 AND han / n > {sec.HAN_SHARE} THEN 'zh' ELSE coalesce(best.lang, 'unknown') END
         AS detected_lang, coalesce(best.hits, 0)::BIGINT AS hits
FROM base LEFT JOIN best USING (doc_id)""")
def q_detect_language(spark, sf):
    return sec.detect_language(table(spark, sf, "documents"))
