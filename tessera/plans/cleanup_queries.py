"""Registered queries: bulk corrections and scrubbing over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleanup as cl
from .common import q, register, table

# Edit list per document (FIXTURES.md: edits): two junk markers removed, then a word that occurs
# nowhere, which must come back as rejected.
EDITS = [(1, "###", ""), (2, "%%%", "")]
ABSENT_WORD = "qqzzqq"


def edits(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    rows = [d.select("doc_id", F.lit(s).alias("seq"), F.lit(o).alias("old"), F.lit(n).alias("new"))
            for s, o, n in EDITS]
    rows.append(d.select("doc_id", F.lit(3).alias("seq"),
                         F.concat(F.lit(ABSENT_WORD), F.col("doc_id").cast("string")).alias("old"), F.lit("x").alias("new")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("seq", F.col("seq").cast("int"))


def _sql_step(t, old, new):
    return f"CASE WHEN contains({t}, {old}) THEN replace({t}, {old}, {new}) ELSE {t} END"


_T1 = _sql_step("text", q(EDITS[0][1]), q(EDITS[0][2]))
_T2 = _sql_step("t1", q(EDITS[1][1]), q(EDITS[1][2]))
_W = f"'{ABSENT_WORD}' || doc_id"


@register("apply_corrections", f"""
SELECT doc_id, md5(t3) AS corrected_md5, length(t3) AS corrected_chars,
       concat_ws(',', CASE WHEN NOT contains(text, {q(EDITS[0][1])}) THEN '1' END,
                      CASE WHEN NOT contains(t1, {q(EDITS[1][1])}) THEN '2' END,
                      CASE WHEN NOT contains(t2, {_W}) THEN '3' END) AS rejected
FROM (SELECT *, {_sql_step('t2', _W, "'x'")} AS t3 FROM (
        SELECT *, {_T2} AS t2 FROM (SELECT doc_id, text, {_T1} AS t1 FROM documents)))""")
def q_apply_corrections(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    r = cl.apply_corrections(d, edits(spark, sf))
    return r.select("doc_id", F.md5("corrected").alias("corrected_md5"),
                    F.length("corrected").cast("long").alias("corrected_chars"),
                    F.array_join(F.transform("rejected", lambda s: s.cast("string")), ",").alias("rejected"))


ALLOW = [("source", "password")]


def _sql_scrub(col, allowed):
    pats = "|".join(f"(?:{p})" for p in cl.SCRUB_PATTERNS)
    if not allowed:
        return f"regexp_replace({col}, {q(pats)}, {q(cl.SCRUB_REPLACEMENT)}, 'g')"
    parts, found = f"string_split_regex({col}, {q(pats)})", f"regexp_extract_all({col}, {q(pats)})"
    kept = ", ".join(q(m) for m in allowed)
    return (f"array_to_string([p || CASE WHEN i > len({found}) THEN '' WHEN {found}[i] IN ({kept}) THEN {found}[i] "
            f"ELSE {q(cl.SCRUB_REPLACEMENT)} END FOR p, i IN {parts}], '')")


@register("scrub_text", f"""
SELECT doc_id, {_sql_scrub('source', [m for c, m in ALLOW if c == 'source'])} AS source,
       {_sql_scrub('text', [m for c, m in ALLOW if c == 'text'])} AS text FROM documents""")
def q_scrub_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    return cl.scrub_text(d, ["source", "text"], allow=ALLOW)


SAFE = ("attributes", "my_safe_value")


@register("scrub_json", f"""
SELECT doc_id, regexp_replace(safe, {q('|'.join(f'(?:{p})' for p in cl.SCRUB_PATTERNS[1:]))}, {q(cl.SCRUB_REPLACEMENT)}, 'g') AS safe,
       {_sql_scrub('safe', [])} AS unsafe, {_sql_scrub('text', [])} AS note, {_sql_scrub('safe', [])} AS first_event, doc_id AS id
FROM (SELECT doc_id, text, 'the password of ' || source || ' is token = "' || doc_id || '"' AS safe FROM documents)""")
def q_scrub_json(spark, sf):
    """Nested records of every document; ``password`` stays at one path only."""
    d = table(spark, sf, "documents").select("doc_id", "source", "text")
    value = F.concat(F.lit("the password of "), "source", F.lit(' is token = "'), F.col("doc_id").cast("string"), F.lit('"'))
    record = F.to_json(F.struct(
        F.struct(value.alias("my_safe_value"), value.alias("value"), F.col("text").alias("note")).alias("attributes"),
        F.array(F.struct(value.alias("my_safe_value")), F.struct(F.lit("none").alias("my_safe_value"))).alias("events"),
        F.col("doc_id").alias("id")))
    r = cl.scrub_json(d.select("doc_id", record.alias("r")), "r", allow=[(SAFE, "password")])
    shape = "attributes struct<my_safe_value:string,value:string,note:string>, events array<struct<my_safe_value:string>>, id long"
    r = r.select("doc_id", F.from_json("r", shape).alias("r"))
    return r.select("doc_id", F.col("r.attributes.my_safe_value").alias("safe"), F.col("r.attributes.value").alias("unsafe"),
                    "r.attributes.note", F.col("r.events")[0]["my_safe_value"].alias("first_event"), "r.id")
