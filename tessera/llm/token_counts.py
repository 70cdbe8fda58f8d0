"""Token counts that follow edits.

A text is cut into pre-tokens by the vocabulary's pattern; merges never cross them, so a text's
token count is the sum over its pre-tokens.  ``build`` keeps a segment tree for each document: a
leaf is a run of ``LEAF`` pre-tokens with its characters and tokens, inner nodes hold the sums of
their subtrees.

An edit (start, length, replacement; characters) walks down the tree to the leaf that holds the
first character whose pre-token can change: the pattern looks at most ``CONTEXT`` characters past a
pre-token's end, so that is the leaf of ``start - CONTEXT``.  From that leaf's beginning the new
text is cut again until a cut falls on an old leaf's end behind the edit.  The pattern never looks
back, so all that follows is as before.  Only those leaves are encoded again, and the sums above
them updated; a tree is laid out anew when edits have made a leaf ``WIDEST`` times too long.

Edits of one document apply in their order, each to the text that the ones before have left.
Positions beyond the text are moved to its end; an edit with a null start or length is passed over,
a null replacement deletes.  A null text counts as empty; its edited text stays null if no edit
applies.  Each row is counted by itself, so repeated rows get equal results; edits are matched by
doc_id and apply to every row of it.  Null doc_ids match no edit.  Empty tables give empty results.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import blocks as B

LEAF, WIDEST, CONTEXT = 32, 4, 2
REMEMBERED, LONG = 400_000, 32

TREES = "doc_id long, text string, leaf_chars binary, leaf_tokens binary"
EDITS = "array<struct<start long, length long, replacement string>>"
COUNTS = ("doc_id long, text string, leaf_chars binary, leaf_tokens binary, n_tokens_before long, n_tokens long, "
          "n_edits int, n_encoded long")


class PieceCounts(dict):
    """The number of tokens of each pre-token met so far."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken
        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        n = len(self.encoding.encode_ordinary(piece))
        if len(piece) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


@cache
def counter(path: str, pattern: str) -> PieceCounts:
    return PieceCounts(path, pattern)


def leaves(pieces: list[str], counts: PieceCounts, runs: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(characters, tokens) of runs of ``LEAF`` pieces, or of ``runs`` runs of about equal length."""
    if not pieces:
        n = runs or 0
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    chars = np.fromiter(map(len, pieces), np.int64, len(pieces))
    tokens = np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))
    if runs is None:
        at = np.arange(0, len(pieces), LEAF)
        return np.add.reduceat(chars, at), np.add.reduceat(tokens, at)
    bounds = np.arange(runs + 1) * len(pieces) // runs
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (chars, tokens)]
    return tuple(np.diff(s[bounds]) for s in sums)


class SegmentTree:
    """Sums of characters and tokens over the leaves; node 1 is the root."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.n = len(chars)
        self.width = 1 << max(0, int(self.n - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        self.sums[self.width:self.width + self.n, 0] = chars
        self.sums[self.width:self.width + self.n, 1] = tokens
        level = self.width
        while level > 1:
            level //= 2
            self.sums[level:2 * level] = self.sums[2 * level:4 * level:2] + self.sums[2 * level + 1:4 * level:2]

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """(leaf holding the character at ``place``, its first character)."""
        node, before = 1, 0
        place = max(0, min(place, self.chars - 1))
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if place - before >= left:
                before += left
                node += 1
        return node - self.width, before

    def leaf_chars(self, leaf: int) -> int:
        return int(self.sums[self.width + leaf, 0])

    def put(self, first: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Replace the leaves from ``first`` on and update the sums above them."""
        lo, hi = self.width + first, self.width + first + len(chars)
        self.sums[lo:hi, 0], self.sums[lo:hi, 1] = chars, tokens
        while lo > 1:
            lo, hi = lo // 2, (hi - 1) // 2 + 1
            self.sums[lo:hi] = self.sums[2 * lo:2 * hi:2] + self.sums[2 * lo + 1:2 * hi:2]

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        own = self.sums[self.width:self.width + self.n]
        return own[:, 0].copy(), own[:, 1].copy()


class CountedText:
    """A text with its tree."""

    def __init__(self, text: str, counts: PieceCounts, tree: SegmentTree | None = None):
        self.text, self.counts, self.encoded = text, counts, 0
        self.tree = tree or SegmentTree(*leaves(counts.pieces.findall(text), counts))

    def edit(self, start: int, length: int, replacement: str) -> None:
        size = len(self.text)
        start = max(0, min(start, size))
        end = max(start, min(start + max(0, length), size))
        old = self.tree
        self.text = self.text[:start] + replacement + self.text[end:]
        if not size:
            self._lay_out()
            return
        shift = len(replacement) - (end - start)
        first, begin = old.find(start - CONTEXT)
        # old leaf ends behind the edit, as places of the new text
        last, stop = first, begin + old.leaf_chars(first)
        while stop < end and last + 1 < old.n:
            last += 1
            stop += old.leaf_chars(last)
        pieces, at = [], begin
        for m in self.counts.pieces.finditer(self.text, begin):
            pieces.append(m.group())
            at = m.end()
            while stop + shift < at and last + 1 < old.n:
                last += 1
                stop += old.leaf_chars(last)
            if at == stop + shift and stop >= end:
                break
        else:
            last = old.n - 1
        self.encoded += len(pieces)
        runs = last - first + 1
        if len(pieces) > runs * LEAF * WIDEST:
            self._lay_out()
            return
        old.put(first, *leaves(pieces, self.counts, runs))

    def _lay_out(self) -> None:
        pieces = self.counts.pieces.findall(self.text)
        self.encoded += len(pieces)
        self.tree = SegmentTree(*leaves(pieces, self.counts))


def _packed(values: np.ndarray) -> bytes:
    return values.astype(np.int32).tobytes()


def build(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, text, leaf_chars, leaf_tokens`` of ``docs(doc_id, text)``: the leaves of each tree
    (32-bit numbers), from which the sums above are made again where they are needed.

    path: a rank file; pattern: what cuts a text into pre-tokens."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", pa.binary()),
                        ("leaf_tokens", pa.binary())])

    def run(batches):
        counts = counter(path, pattern)
        for rows, _, _ in B.blocks(batches):
            found = [leaves(counts.pieces.findall(t or ""), counts) for t in rows.column("text").to_pylist()]
            yield B.batch_of(schema, rows.column("doc_id"), rows.column("text"),
                             [_packed(c) for c, _ in found], [_packed(t) for _, t in found])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, TREES)


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``trees`` with the column ``edits`` from ``edits(doc_id, seq, start, length, replacement)``."""
    own = (edits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "start", "length", "replacement"))),
                            lambda e: F.struct(e["start"].cast("long").alias("start"),
                                               e["length"].cast("long").alias("length"),
                                               e["replacement"].cast("string").alias("replacement")))
                .alias("edits")))
    return trees.join(own, "doc_id", "left")


def apply_edits(trees: DataFrame, path: str, pattern: str) -> DataFrame:
    """Trees after their ``edits``, with the token counts before and after, the number of edits and
    the number of pre-tokens that had to be encoded for them."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", pa.binary()),
                        ("leaf_tokens", pa.binary()), ("n_tokens_before", pa.int64()), ("n_tokens", pa.int64()),
                        ("n_edits", pa.int32()), ("n_encoded", pa.int64())])

    def one(row, counts):
        chars, tokens = (np.frombuffer(row[c], np.int32) for c in ("leaf_chars", "leaf_tokens"))
        before = int(tokens.sum(dtype=np.int64))
        todo = [(e["start"], e["length"], e["replacement"] or "") for e in row["edits"] or []
                if e is not None and e["start"] is not None and e["length"] is not None]
        if not todo:
            return (*(row[c] for c in ("doc_id", "text", "leaf_chars", "leaf_tokens")), before, before, 0, 0)
        t = CountedText(row["text"] or "", counts, SegmentTree(chars, tokens))
        for e in todo:
            t.edit(*e)
        c, k = t.tree.leaves()
        return row["doc_id"], t.text, _packed(c), _packed(k), before, t.tree.tokens, len(todo), t.encoded

    def run(batches):
        counts = counter(path, pattern)
        for rows, _, _ in B.blocks(batches):
            done = [one(r, counts) for r in rows.to_pylist()]
            yield B.batch_of(schema, *([r[i] for r in done] for i in range(len(schema))))

    return trees.select("doc_id", "text", "leaf_chars", "leaf_tokens",
                        F.col("edits").cast(EDITS).alias("edits")).mapInArrow(run, COUNTS)


# What the masking edits replace, and by what.  A mail address starts where its run of characters
# does, or right behind the last match (\G): elsewhere in the run it would be found no more and no less, and
# runs of any length are read once.
MASKS = [(r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "[email]"), (r"\+?[0-9][0-9 ()-]{6,}[0-9]", "[number]")]


def mask_places(text: str | None, masks: list[tuple[str, str]] = MASKS) -> list[dict]:
    """The edits that mask a text, from its end to its beginning."""
    import regex
    if not text:
        return []
    both = regex.compile("|".join(f"(?P<m{i}>{p})" for i, (p, _) in enumerate(masks)))
    return [{"start": m.start(), "length": m.end() - m.start(), "replacement": masks[int(m.lastgroup[1:])][1]}
            for m in both.finditer(text)][::-1]


def masking_edits(docs: DataFrame, masks: list[tuple[str, str]] = MASKS) -> DataFrame:
    """``docs`` with the column ``edits``: one edit for every place of a mask's pattern, from the
    text's end to its beginning.  Of overlapping places the first in the text counts."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("replacement", pa.string())]))

    @arrow_udf(EDITS)
    def edits(text: pa.Array) -> pa.Array:
        return pa.array([mask_places(t, masks) for t in text.to_pylist()], kind)

    return docs.withColumn("edits", edits(F.col("text").cast("string")))
