"""Bulk text corrections and scrubbing of sensitive values."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_EDIT_BYTES = 256 * 1024 * 1024

# fixed values (ours): patterns redacted by scrub_text and the replacement text
SCRUB_PATTERNS = [r"(?i)password", r'token\s*=\s*"[^"]*"', r"\d{1,3}(\.\d{1,3}){3}"]
SCRUB_REPLACEMENT = "[scrubbed]"


def apply_corrections(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      max_broadcast_bytes: int = MAX_BROADCAST_EDIT_BYTES) -> DataFrame:
    """Apply each document's edits (doc_id, seq, old, new) in ``seq`` order, replacing every
    occurrence.  An edit whose ``old`` text is absent when its turn comes is not applied and is
    listed in ``rejected`` (seq numbers) for manual handling.

    Edits are grouped per document first (a list per document, small by nature), so the
    document side is joined once; when the grouped edits are small enough they are broadcast
    and the documents are not shuffled at all."""
    per_doc = edits.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("seq", "old", "new"))).alias("edits"))
    size = per_doc.agg(F.sum(F.length(F.to_json("edits")) + 16).alias("b")).first()["b"] or 0
    right = F.broadcast(per_doc) if size <= max_broadcast_bytes else per_doc
    j = docs.join(right, id_col, "left")
    init = F.struct(F.col(text_col).alias("t"), F.array().cast("array<int>").alias("rej"))
    step = lambda acc, e: F.when(F.contains(acc["t"], e["old"]),
                                 F.struct(F.replace(acc["t"], e["old"], e["new"]).alias("t"), acc["rej"].alias("rej"))) \
        .otherwise(F.struct(acc["t"].alias("t"), F.array_append(acc["rej"], e["seq"]).alias("rej")))
    res = F.aggregate(F.coalesce(F.col("edits"), F.array().cast("array<struct<seq:int,old:string,new:string>>")),
                      init, step)
    return j.select(id_col, res["t"].alias("corrected"), res["rej"].alias("rejected"))


def scrub_text(df: DataFrame, columns: list[str], allow: list[tuple[str, str]] | None = None,
               patterns: list[str] | None = None) -> DataFrame:
    """Replace pattern matches in the given columns by ``[scrubbed]`` unless the (column, match)
    pair is allow-listed.  A match is kept only if the whole of it equals an allowed value."""
    pats = "|".join(f"(?:{p})" for p in (patterns or SCRUB_PATTERNS))
    allow = allow or []
    out = df
    for c in columns:
        v = F.col(c)
        kept = [m for col, m in allow if col == c]
        if kept:
            found = F.transform(F.regexp_extract_all(v, F.lit(f"({pats})"), F.lit(0)),
                                lambda m: F.when(m.isin(*kept), m).otherwise(F.lit(SCRUB_REPLACEMENT)))  # noqa: B023
            # the texts between the matches, each followed by what its match becomes
            v = F.array_join(F.zip_with(F.split(v, pats, -1), found, lambda t, m: F.concat(t, F.coalesce(m, F.lit("")))), "")
        else:
            v = F.regexp_replace(v, pats, SCRUB_REPLACEMENT)
        out = out.withColumn(c, v)
    return out


# a string, a bracket or mark, or a run of anything else (numbers, words)
JSON_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\]:,]|[^\s"{}\[\]:,]+|"', re.S)


def _python_pattern(pattern: str) -> str:
    """One of the scrub patterns for Python: a leading case flag holds for this pattern only."""
    return f"(?i:{pattern[4:]})" if pattern.startswith("(?i)") else f"(?:{pattern})"


def scrub_tree(text: str, pattern: re.Pattern, allow: set) -> str:
    """JSON ``text`` with the matches in its string values replaced, but those in ``allow`` (path, match).

    A path is the tuple of keys and list positions that lead to the value.  Everything else stays as it
    is written: keys, numbers, order and white space."""
    out, last, path, keys = [], 0, [], []
    is_key = False  # whether the next string is a key

    def put(m):
        return m.group() if (tuple(path), m.group()) in allow else SCRUB_REPLACEMENT
    for token in JSON_TOKEN.finditer(text):
        t = token.group()
        if t in "{[":
            keys.append(t)
            path.append(None if t == "{" else 0)
            is_key = t == "{"
        elif t in "}]" and keys:
            keys.pop()
            path.pop()
            is_key = False
        elif t == "," and keys:
            is_key = keys[-1] == "{"
            if not is_key:
                path[-1] += 1
        elif t[0] == '"' and len(t) > 1:
            value = json.loads(t, strict=False)
            if is_key:
                path[-1], is_key = value, False
            elif (clean := pattern.sub(put, value)) != value:
                out += [text[last:token.start()], json.dumps(clean, ensure_ascii=False)]
                last = token.end()
    return "".join(out) + text[last:]


def scrub_json(df: DataFrame, column: str, allow: list[tuple[tuple, str]] | None = None,
               patterns: list[str] | None = None) -> DataFrame:
    """Replace pattern matches in all string values of a column of JSON texts by ``[scrubbed]``, at any
    depth, unless the value's path and the whole match are allow-listed.  A text that is no JSON is
    scrubbed as one string."""
    pattern = re.compile("|".join(map(_python_pattern, patterns or SCRUB_PATTERNS)), re.ASCII)
    allowed = {(tuple(path), match) for path, match in allow or []}

    def one(text):
        if text is None:
            return None
        try:
            json.loads(text, strict=False)
        except (ValueError, RecursionError):
            return pattern.sub(SCRUB_REPLACEMENT, text)
        return scrub_tree(text, pattern, allowed)

    @F.arrow_udf("string")
    def scrub(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in texts.to_pylist()], pa.string())
    return df.withColumn(column, scrub(F.col(column)))
