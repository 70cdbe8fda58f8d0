"""Licence scans with a generalised suffix automaton.

The automaton accepts every run of words that stands in one of the licence templates.  A file is
streamed through it, giving at each word the length of the longest match ending there (its
matching statistics) and the template places of that match.  Matches that cannot be extended, of
at least ``MIN_MATCH`` words, are chained: a chain's matches advance in the text and in one
template with gaps of at most ``MAX_GAP`` words.  A chain is a span; it takes the template's label
where it covers at least ``MIN_SHARE`` of the template's words.

The three base phrases are templates too, and every place where one stands is reported, read off
the automaton's states.

Only stretches of words in which each pair of neighbours stands in some template can hold a match
of two words or more, so those are found for a block of documents at once and only they are
streamed.  Word rule: A-Z lower-cased, runs of digits, ASCII letters and characters beyond ASCII.
Null and empty texts have no words, no spans and score 0; each row is scanned by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B

MIN_MATCH, MAX_GAP, MIN_SHARE = 4, 8, 0.6

# Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

# Notices and the operative sentences of public licences, by label.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License "
                   "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
                   "or implied."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


class Automaton:
    """Suffix automaton of several word sequences; states know the template places of their runs."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.length, ends = [{}], [-1], [0], [[]]
        for t, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c, ends)
                ends[last].append((t, i))
        # a state's places are those of all states whose suffix it is
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                ends[self.link[v]] = sorted(set(ends[self.link[v]]) | set(ends[v]))
        self.ends = [sorted(set(e)) for e in ends]

    def _extend(self, last: int, c: int, ends: list) -> int:
        if c in self.next[last]:  # another sequence has led here already
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q, ends)
        cur = self._state({}, self.length[last] + 1, ends)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q, ends)
        return cur

    def _state(self, edges: dict, length: int, ends: list) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int, ends: list) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1, ends)
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def walk(self, seq) -> int:
        s = 0
        for c in seq:
            s = self.next[s][c]
        return s

    def stream(self, seq):
        """(state, match length) after each word."""
        s = n = 0
        for c in seq:
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1
            yield s, n


class Scanner:
    """The automaton of base phrases and templates, with what the block-wise screen needs."""

    def __init__(self, templates=TEMPLATES, base=BASE, min_match=MIN_MATCH, max_gap=MAX_GAP, min_share=MIN_SHARE):
        self.min_match, self.max_gap, self.min_share = min_match, max_gap, min_share
        texts = [p for p, _ in base] + [t for _, t in templates]
        data, off = B.flat(pa.array(texts))
        code, row, vocab = B.words(data, off)
        self.ids = {w: i + 1 for i, w in enumerate(vocab)}
        at = B.row_starts(row, len(texts))
        seqs = [(code[at[i]:at[i + 1]] + 1).tolist() for i in range(len(texts))]
        self.base_labels, self.labels = [b for _, b in base], [b for b, _ in templates]
        self.sizes = [len(s) for s in seqs[len(base):]]
        self.automaton = Automaton(seqs)
        n = len(vocab) + 1
        self.pairs, self.starts_base = np.zeros((n, n), bool), np.zeros((n, n), bool)
        for k, s in enumerate(seqs):
            for a, b in zip(s, s[1:], strict=False):
                self.pairs[a, b] = True
            if k < len(base):
                self.starts_base[s[0], s[1]] = True
        self.n_base = len(base)
        # base phrases whose run is a suffix of a state's runs
        own = {}
        for k in range(len(base)):
            own.setdefault(self.automaton.walk(seqs[k]), []).append((k, len(seqs[k])))
        self.phrases = []
        for s in range(len(self.automaton.next)):
            found, v = [], s
            while v > 0:
                found += own.get(v, [])
                v = self.automaton.link[v]
            self.phrases.append(found)

    def stretches(self, tok: np.ndarray, row: np.ndarray):
        """(first word, end) of stretches that can hold a long match or a base phrase."""
        if len(tok) < 2:
            return []
        ok = self.pairs[tok[:-1], tok[1:]] & (row[:-1] == row[1:])
        s = np.flatnonzero(ok & ~np.concatenate([[False], ok[:-1]]))
        e = np.flatnonzero(ok & ~np.concatenate([ok[1:], [False]])) + 2
        begun = np.concatenate([[0], np.cumsum(self.starts_base[tok[:-1], tok[1:]] & ok)])
        keep = (e - s >= self.min_match) | (begun[e - 1] > begun[s])
        return list(zip(s[keep].tolist(), e[keep].tolist(), strict=True))

    def read(self, seq: list[int]):
        """Base places [(phrase, start)] and maximal matches [(start, end, state)] of a stretch."""
        places, matches, before = [], [], (0, 0)
        a = self.automaton
        for i, (s, n) in enumerate(a.stream(seq)):
            places += [(k, i - m + 1) for k, m in self.phrases[s] if m <= n]
            if before[1] >= self.min_match and n <= before[1]:
                matches.append((i - before[1], i, before[0]))
            before = (s, n)
        if before[1] >= self.min_match:
            matches.append((len(seq) - before[1], len(seq), before[0]))
        return places, matches

    def chains(self, matches):
        """Spans (template, start, end, covered words) of one document's matches, by text order."""
        open_, done = {}, []
        for start, end, state in matches:
            for t, last in self.automaton.ends[state]:
                if t < self.n_base:
                    continue
                t -= self.n_base
                first = last - (end - start) + 1
                best = None
                for c in open_.get(t, []):  # (start, end, covered, last template place)
                    if end > c[1] and last > c[3] and start - c[1] <= self.max_gap and first - c[3] - 1 <= self.max_gap:
                        new = min(end - max(start, c[1]), last - max(first - 1, c[3]))
                        if new > 0 and (best is None or c[2] + new > best[2]):
                            best = (c[0], end, c[2] + new, last)
                live = [c for c in open_.get(t, []) if start - c[1] <= self.max_gap]
                done += [(t, *c) for c in open_.get(t, []) if start - c[1] > self.max_gap]
                open_[t] = [*live, best or (start, end, end - start, last)]
        done += [(t, *c) for t, cs in open_.items() for c in cs]
        out = {}
        for t, s, e, n, _ in done:  # of chains that begin at one place, the fullest
            if n >= self.min_share * self.sizes[t] and n > out.get((t, s), (0, 0))[1]:
                out[t, s] = (e, n)
        return sorted((t, s, e, min(n, self.sizes[t])) for (t, s), (e, n) in out.items())


RESULT = ("doc_id long, n_words long, places array<struct<label string, start long>>, "
          "spans array<struct<label string, start long, end long, share double>>")


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Per document: its words, the places of base phrases and the template spans (word numbers)."""
    sc = scanner or Scanner()
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()),
        ("places", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
        ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                      ("share", pa.float64())])))])

    def one(rows, data, off):
        code, row, vocab = B.words(data, off)
        known = np.fromiter((sc.ids.get(w, 0) for w in vocab), np.int64, len(vocab))
        tok = known[code] if len(code) else np.zeros(0, np.int64)
        at = B.row_starts(row, rows.num_rows)
        places = [[] for _ in range(rows.num_rows)]
        matches = [[] for _ in range(rows.num_rows)]
        for s, e in sc.stretches(tok, row):
            r = int(row[s])
            p, m = sc.read(tok[s:e].tolist())
            base = s - int(at[r])
            places[r] += [{"label": sc.base_labels[k], "start": base + i} for k, i in p]
            matches[r] += [(base + a, base + b, state) for a, b, state in m]
        spans = [[{"label": sc.labels[t], "start": s, "end": e, "share": n / sc.sizes[t]}
                  for t, s, e, n in sc.chains(m)] for m in matches]
        return B.batch_of(schema, rows.column("doc_id"), np.diff(at), places, spans)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(B.per_block(one), RESULT)
