"""Token ids of whole texts, by way of their distinct stretches.

The vocabulary used here drops white space and never joins characters across it, nor an ASCII letter
with one of ``MARKS`` beside it.  So a text's ids are those of its stretches, cut at blanks, tabs,
line ends and between letters and marks, back to back.  Most stretches repeat: each distinct one of
a block is encoded once, and remembered between blocks within a bound.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np

from . import blocks as B

REMEMBERED = 1_500_000
LONG = 64  # longer stretches are not remembered

SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, 0x09, 0x0A, 0x0D]] = False
# not the apostrophe, which begins endings of words, nor the signs of special tokens
MARKS = b".,;:!?()"
KIND = np.zeros(256, np.int8)
KIND[65:91] = KIND[97:123] = 1
KIND[list(MARKS)] = 2


def vocabulary(name: str) -> str:
    """The path of an installed public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def stretches(data: np.ndarray, off: np.ndarray):
    """(code per stretch, row per stretch, distinct stretches as bytes), in reading order."""
    solid, kind, n = SOLID[data], KIND[data], len(data)
    cut = np.zeros(n + 1, bool)
    cut[1:n] = kind[1:] + kind[:-1] == 3  # a letter beside a mark
    cut[off] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:n]
    end[:-1] &= ~solid[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    code, found = B.distinct(data, s, e, solid)
    return code, np.searchsorted(off, s, "right") - 1, found


def _lower_cases(normalizer: dict | None) -> bool:
    """Whether a vocabulary's normalizer lower-cases all text."""
    if not normalizer:
        return False
    return normalizer["type"] == "Lowercase" or any(map(_lower_cases, normalizer.get("normalizers", [])))


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker: tasks that share a worker share what it remembers."""
    return WordTokenizer(path)


class WordTokenizer:
    """Encodes blocks of texts with a vocabulary that never crosses the stretches' ends.

    Each distinct stretch is encoded once while it is remembered; where the vocabulary itself lower-cases
    all text, stretches that differ in the case of A-Z are one."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.lower = _lower_cases(json.loads(self.tokenizer.to_str()).get("normalizer"))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # place of each stretch in first and size
        self.flat, self.first, self.size = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))

    def _places(self, found: list[bytes]) -> np.ndarray:
        """The places of the stretches; new ones are encoded."""
        if len(self.known) > REMEMBERED or len(self.flat) > 8 * REMEMBERED:
            self._forget()
        known = self.known
        out = list(map(known.get, found))
        new = [i for i, v in enumerate(out) if v is None]
        if new:
            ids, size = [], []
            for a in range(0, len(new), 4096):
                part = [found[i].decode("utf-8", "replace") for i in new[a:a + 4096]]
                for c in self.tokenizer.encode_batch_fast(part, add_special_tokens=False):
                    got = c.ids
                    size.append(len(got))
                    ids += got
            start = len(self.size)
            for k, i in enumerate(new, start):
                out[i] = k
                if len(found[i]) <= LONG:
                    known[found[i]] = k
            size = np.array(size, np.int64)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.array(ids, np.uint32)])
        return np.array(out, np.int64)

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int | None = None) -> list[np.ndarray]:
        """The ids of each text, with ``end_id`` behind them if it is given."""
        code, row, found = stretches(B.LOWER[data] if self.lower else data, off)
        place = self._places(found)
        n = len(off) - 1
        at = place[code] if len(code) else np.zeros(0, np.int64)
        counts = self.size[at]
        body = self.flat[B.ragged(self.first[at], counts)]
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, counts, n).astype(np.int64))])
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        return [np.concatenate([body[ends[i]:ends[i + 1]], tail]) for i in range(n)]
