"""Personal data: exact patterns, and a skip-chain conditional random field around them.

``base_spans`` finds e-mail addresses, IP addresses, card and phone numbers by fixed rules, each in one
pass over a text of any length.  The field adds what the rules miss in the same document: another way
to write a number that stands elsewhere in full, a part of it, a neighbour of the same entity.

Its nodes are the tokens (runs without ASCII white space) that hold a digit or ``@``; all other tokens
are observed as "none".  Two potentials join nodes besides their own features: a chain potential between
tokens that stand side by side, and a skip potential between distant tokens that repeat, that is whose
letters and digits are equal or whose last seven digits are.  Each token is joined to the next one that
repeats it, so a document's edges grow with its tokens, not with their pairs.  Tokens of base spans keep
their kind; messages are passed along all edges (sum-product, damped) until they settle, at most
``ROUNDS`` times, and a free token is taken as an entity if its belief is ``BELIEF`` or more.

Learning is by pseudo-likelihood: a token's label given its neighbours' depends on a finite number of
small configurations, which are counted over all documents in Spark; the table of counts, whose size the
features bound and not the corpus, is fitted in numpy around priors that favour no entity, and equal
labels on both ends of a skip edge.

Null and empty texts have no spans.  Rows with equal or null ids are each read by themselves; an empty
table gives no rows.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B

# fixed values: the kinds in their order, and the patterns and limits of the base rules
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]++")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

LABELS = 1 + len(KINDS)  # 0: none
ROUNDS, DAMPING, BELIEF, BESIDE = 30, 0.3, 0.9, 0.5
NONE_PRIOR, SKIP_PRIOR, STRENGTH, STEPS, RATE = 1.5, 3.0, 1e-3, 600, 0.1
FULL = 7  # digits of a number's end that make two tokens alike
OUTER = "()[]{}<>\"'.,;:!?"

DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
ALNUM = DIGIT.copy()
ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
DIGIT_STEPS = np.array([1, 2, 3, 4, 5, 7, 10, 14, 20])


def luhn(digits: str) -> bool:
    """Whether the check sum of a digit string is right."""
    twice = digits[-2::-2]
    return (sum(map(int, digits[-1::-2])) + sum(2 * int(d) - 9 * (d > "4") for d in twice)) % 10 == 0


def _emails(text: str):
    pos, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > pos and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        # what stands before this sign belongs to no later address
        pos = m.end() if m else at + 1
        at = text.find("@", pos)


def _phones(text: str):
    for m in PHONE.finditer(text):
        body = m.group().rstrip(" ().-")
        if len(body) >= 4:
            yield m.start(), m.start() + len(body), body


def base_spans(text: str, failed: bool = False) -> list[tuple[int, int, int]]:
    """(start, kind's place in ``KINDS``, end) of all base spans, sorted; with ``failed`` also, under
    kind -1, what has the form of an IP address or card but fails its check."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in IP.finditer(text):
        ok = all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))
        if ok or failed:
            out.append((m.start(), 1 if ok else -1, m.end()))
    for m in CARD.finditer(text):
        d = m.group().replace(" ", "").replace("-", "")
        if CARD_DIGITS[0] <= len(d) <= CARD_DIGITS[1] and ((ok := luhn(d)) or failed):
            out.append((m.start(), 2 if ok else -1, m.end()))
    for s, e, body in _phones(text):
        if PHONE_DIGITS[0] <= sum(map(str.isdigit, body)) <= PHONE_DIGITS[1]:
            out.append((s, 3, e))
    return sorted(out)


@dataclass
class Graph:
    """The nodes of a block's texts and their edges."""

    row: np.ndarray
    start: np.ndarray  # code points in the text
    end: np.ndarray
    feature: np.ndarray
    label: np.ndarray  # kind + 1 of a base span, else 0
    held: np.ndarray  # whether the label is certain
    chain: np.ndarray  # (left, right) nodes
    skip: np.ndarray  # (earlier, later) nodes
    spans: list[list[tuple[int, int, int]]]


def _pairs(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Each node with the next one of its text that has its key (0: none)."""
    some = np.flatnonzero(key)
    some = some[np.lexsort((some, key[some], row[some]))]
    a, b = some[:-1], some[1:]
    same = (row[a] == row[b]) & (key[a] == key[b])
    return np.stack([a[same], b[same]], 1)


def graph(data: np.ndarray, off: np.ndarray) -> Graph:
    """Tokens, features, base spans and edges of a block of texts."""
    s, e, row = B.spans(data, off, B.SOLID_BYTE)

    def tally(member):
        upto = np.concatenate(([0], np.cumsum(member)))
        return upto[e] - upto[s], upto
    digits, _ = tally(DIGIT[data])
    signs, _ = tally(data == 64)
    node = np.flatnonzero((digits > 0) | (signs > 0))
    dots = tally(data == 46)[0][node]
    paren = tally((data == 40) | (data == 41))[0][node]
    dash = tally(data == 45)[0][node]
    letters = tally(ALNUM[data] & ~DIGIT[data])[0][node]
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    r, ns, ne = row[node], s[node], e[node]
    start, end = points[ns] - points[off[r]], points[ne] - points[off[r]]
    digits, signs = digits[node], signs[node]
    # what stands before: nothing, a node, a label (ends with : or =), another word
    before = np.full(len(node), 0)
    prior = node - 1
    has = (prior >= 0) & (row[np.maximum(prior, 0)] == r)
    last = data[e[prior[has]] - 1] if has.any() else np.zeros(0, np.uint8)
    before[has] = np.where((last == 58) | (last == 61), 2, 3)
    chained = np.flatnonzero(has & np.isin(prior, node))
    before[chained] = 1
    chain = np.stack([chained - 1, chained], 1)
    feature = np.minimum(signs, 1)
    for value, many in ((np.searchsorted(DIGIT_STEPS, digits, "right"), 10), (np.minimum(dots, 4), 5),
                        (data[ns] == 43, 2), (paren > 0, 2), (dash > 0, 2), (letters > 0, 2), (before, 4)):
        feature = feature * many + value
    body, low = data.tobytes(), B.LOWER[data].tobytes()
    drop = bytes(i for i in range(256) if not ALNUM[i])
    only = bytes(i for i in range(256) if not DIGIT[i])
    whole, tail = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
    h = xxhash.xxh3_64_intdigest
    for i, (a, b) in enumerate(zip(ns.tolist(), ne.tolist(), strict=True)):
        t = low[a:b].translate(None, drop)
        if len(t) >= 4:
            whole[i] = (h(t) >> 1) | 1
        t = body[a:b].translate(None, only)
        if len(t) >= FULL:
            tail[i] = (h(t[-FULL:]) >> 1) | 1
    skip = np.unique(np.concatenate([_pairs(r, whole), _pairs(r, tail)]), axis=0)
    if len(chain):  # neighbours are joined once
        skip = skip[~np.isin(skip[:, 0] * len(node) + skip[:, 1], chain[:, 0] * len(node) + chain[:, 1])]
    label, held = np.zeros(len(node), np.int64), np.zeros(len(node), bool)
    spans = [[] for _ in range(len(off) - 1)]
    at = np.searchsorted(r, np.arange(len(off)))
    for i in np.unique(r).tolist():
        found = base_spans(body[off[i]:off[i + 1]].decode("utf-8", "replace"), failed=True)
        spans[i] = [x for x in found if x[1] >= 0]
        lo, hi = at[i], at[i + 1]
        # the first of overlapping spans names the token, and none that failed
        for a, kind, b in sorted(found, key=lambda x: (x[1] >= 0, -x[0], -x[1])):
            mine = slice(lo + np.searchsorted(end[lo:hi], a, "right"), lo + np.searchsorted(start[lo:hi], b))
            label[mine], held[mine] = kind + 1, True
    return Graph(r, start, end, feature, label, held, chain, skip, spans)


def _split(feature: np.ndarray) -> np.ndarray:
    """Places of a feature code's indicators in the weight table: each part, and digits with dots."""
    parts, rest = [], feature
    for many in (4, 2, 2, 2, 2, 5, 10, 2):
        parts.append(rest % many)
        rest = rest // many
    before, letters, dash, paren, plus, dots, digits, at = parts
    first = np.cumsum([0, 4, 8, 8, 2, 50])
    return np.stack([before + first[0], letters * 4 + dash * 2 + paren + first[1], plus * 4 + letters * 2 + at + first[2],
                     at + first[3], digits * 5 + dots + first[4]], 1)


N_WEIGHTS = 72


@dataclass
class Model:
    """Log potentials: own features (indicator by label), side by side (left by right), repeats."""

    own: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, feature: np.ndarray) -> np.ndarray:
        return self.own[_split(feature)].sum(1)


def configurations(docs: DataFrame) -> DataFrame:
    """``label, feature, left, right, alike, n``: how often a token has a label, features and neighbours'
    labels (5: none); ``alike`` holds the counts of labels over its skip edges, a digit each."""
    schema = pa.schema([(c, pa.int64()) for c in ("label", "feature", "left", "right", "alike", "n")])

    def one(rows, data, off):
        g = graph(data, off)
        n = len(g.label)
        if not n:
            return None
        left, right = np.full(n, LABELS), np.full(n, LABELS)
        left[g.chain[:, 1]] = g.label[g.chain[:, 0]]
        right[g.chain[:, 0]] = g.label[g.chain[:, 1]]
        alike = (np.bincount(g.skip[:, 0], 10.0 ** g.label[g.skip[:, 1]], n)
                 + np.bincount(g.skip[:, 1], 10.0 ** g.label[g.skip[:, 0]], n)).astype(np.int64)
        found, times = np.unique(np.stack([g.label, g.feature, left, right, alike], 1), axis=0, return_counts=True)
        return B.batch_of(schema, *found.T, times)

    return (_texts(docs).mapInArrow(B.per_block(one), ", ".join(f"{f.name} long" for f in schema))
            .groupBy("label", "feature", "left", "right", "alike").agg(F.sum("n").alias("n")))


def train(label, feature, left, right, alike, n) -> Model:
    """The potentials that make the counted labels likeliest given their neighbours', near the priors.
    Labels weigh alike; the bias is then set to their true shares."""
    own, prior = np.zeros((N_WEIGHTS, LABELS)), SKIP_PRIOR * np.eye(LABELS)
    own[:4, 0] = NONE_PRIOR
    first = own.copy()
    chain, skip = np.zeros((LABELS + 1, LABELS + 1)), prior.copy()
    total = np.bincount(label, n, LABELS)
    if np.count_nonzero(total) < 2:
        own[:4, 0] = 10.0  # without any base span nothing tells entities from other tokens
        return Model(own, chain[:LABELS, :LABELS], skip)
    weight = (n / total[label]) / np.count_nonzero(total)
    where = _split(feature)
    votes = np.stack([alike // 10 ** k % 10 for k in range(LABELS)], 1).astype(float)
    hot = np.eye(LABELS)[label]
    every = [own, chain, skip]
    moved, scale = [np.zeros_like(x) for x in every], [np.zeros_like(x) for x in every]
    for t in range(1, STEPS + 1):
        z = own[where].sum(1) + chain[left, :LABELS] + chain[:LABELS, right].T + votes @ skip
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p = (p / p.sum(1, keepdims=True) - hot) * weight[:, None]
        grad = [STRENGTH * (own - first), STRENGTH * chain, STRENGTH * (skip - prior)]
        for j in range(where.shape[1]):
            np.add.at(grad[0], where[:, j], p)
        np.add.at(grad[1][:, :LABELS], left, p)
        np.add.at(grad[1][:LABELS].T, right, p)
        g = votes.T @ p
        grad[2] += (g + g.T) / 2
        for x, d, m, v in zip(every, grad, moved, scale, strict=True):  # Adam
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            x -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    # no neighbour on a side is told by the features; its weights go to the bias of every token
    own[:4] += chain[LABELS, :LABELS] + chain[:LABELS, LABELS]
    edge = chain[:LABELS, :LABELS] - chain[LABELS, None, :LABELS] - chain[:LABELS, LABELS, None]
    own[:4] += np.log(np.maximum(total, 0.5) / total.sum())
    return Model(own, edge, skip)


def fit(docs: DataFrame) -> Model:
    """Learn from the base spans of ``docs(text)``."""
    got = configurations(docs).toPandas().sort_values(["label", "feature", "left", "right", "alike"])
    return train(*(got[c].to_numpy(np.int64) for c in ("label", "feature", "left", "right", "alike")),
                 got["n"].to_numpy(np.float64))


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(1))


def beliefs(model: Model, g: Graph, rounds: int = ROUNDS, damping: float = DAMPING) -> np.ndarray:
    """Each node's label probabilities after loopy message passing, base tokens held to their label."""
    z = model.unary(g.feature)
    held = g.held
    z[held] = np.where(np.eye(LABELS, dtype=bool)[g.label[held]], 0, -50.0)
    pairs = np.concatenate([g.chain, g.skip])
    if len(pairs):
        matrix = np.concatenate([np.broadcast_to(model.chain, (len(g.chain), LABELS, LABELS)),
                                 np.broadcast_to(model.skip, (len(g.skip), LABELS, LABELS))])
        source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
        matrix = np.concatenate([matrix, matrix.transpose(0, 2, 1)])
        # a held token hears nothing, and what it says never changes
        use = ~held[target]
        turn = np.where(use, np.cumsum(use) - 1, -1)
        back = np.concatenate([turn[len(pairs):], turn[:len(pairs)]])[use]
        source, target, matrix = source[use], target[use], matrix[use]
        said = np.zeros((len(source), LABELS))
        known = back >= 0
        for _ in range(rounds):
            total = z + np.stack([np.bincount(target, said[:, k], len(z)) for k in range(LABELS)], 1)
            heard = total[source]
            heard[known] -= said[back[known]]
            new = _logsum(heard[:, :, None] + matrix)
            new -= _logsum(new[:, :, None])
            change = np.abs(new - said).max(initial=0)
            said = damping * said + (1 - damping) * new
            if change < 1e-3:
                break
        z = z + np.stack([np.bincount(target, said[:, k], len(z)) for k in range(LABELS)], 1)
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def runs(g: Graph, p: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, start, kind, end) of the runs of free tokens that are believed to be one entity."""
    kind = np.where(~g.held & (p.max(1) >= BESIDE), p.argmax(1), 0)
    joined = np.zeros(len(kind), bool)
    joined[g.chain[:, 1]] = kind[g.chain[:, 0]] == kind[g.chain[:, 1]]
    some = np.flatnonzero(kind)
    run = np.cumsum(~joined[some])
    out = []
    for k in np.unique(run[p.max(1)[some] >= BELIEF]):
        mine = some[run == k]
        out.append((int(g.row[mine[0]]), int(g.start[mine[0]]), int(kind[mine[0]]) - 1, int(g.end[mine[-1]])))
    return out


def _texts(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("string").alias("text"))


def find(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, base, added`` for every row of ``docs(doc_id, text)``: base spans and those of the field,
    as arrays of ``start, kind, end`` (code points, end exclusive), by start and kind."""
    ids = docs.select(F.col(id_col).alias("doc_id"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    kind = ids.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def one(rows, data, off):
        g = graph(data, off)
        added = [[] for _ in range(len(off) - 1)]
        if len(g.label):
            p = beliefs(sent.value, g)
            for r, *x in runs(g, p):
                added[r].append(tuple(x))
            for r, spans in enumerate(added):
                if spans:
                    text = data[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace")
                    added[r] = [_bare(text, *x) for x in spans]
        keys = ("start", "kind", "end")
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), *(pa.array([[dict(zip(keys, x, strict=True)) for x in spans] for spans in part], span)
                                      for part in (g.spans, added))], names=["doc_id", "base", "added"])

    array = "array<struct<start:long,kind:int,end:long>>"
    return (_texts(docs, F.col(id_col).alias("doc_id"))
            .mapInArrow(B.per_block(one), f"doc_id {kind}, base {array}, added {array}"))


def _bare(text: str, start: int, kind: int, end: int) -> tuple[int, int, int]:
    """A span without the signs around it."""
    body = text[start:end]
    left = len(body) - len(body.lstrip(OUTER))
    return start + left, kind, start + len(body.rstrip(OUTER))
