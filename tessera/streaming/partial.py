"""Records of a JSON list that arrives in pieces, checked as they become complete.

``ListScanner`` reads a list's text piece by piece and holds what the next piece needs: where in the
list it stands, the depth, whether it is inside a string or behind a backslash, and the text of the
record that is still open.  So each piece is read once, and a brace inside a string ends nothing.

``scan_lists`` runs one scanner per list as keyed streaming state.  The state's key is a slot, a hash of the
list's id, so that a call of the state function, which costs far more than a piece, serves all lists of a
slot.  Pieces that arrive before an earlier one wait in the state; a piece is answered when all before it
have come, so the answers do not depend on the order of arrival or on the micro-batches.  A piece that
comes again is ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, FIRST, RECORD, AFTER, NEXT, END = range(6)
IN_STRING, IN_RECORD = re.compile(r'["\\]'), re.compile(r'["{}]')
WEIGHT_MIN = 50

RESULT = "list_id long, seq long, is_last boolean, n_complete long, n_valid long, strict_ok boolean"
# per list of the slot, as JSON: its id, the next seq, the scanner's state and the pieces that wait
STATE = "lists string"
SLOTS = 1 << 11


def _number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def valid_record(text: str) -> bool | None:
    """Whether a record keeps the rules (name and length are there, weight is missing or at least 50);
    None if it is no JSON object."""
    def refuse(name):
        raise ValueError(name)
    try:
        r = json.loads(text, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None
    weight = r.get("weight")
    return isinstance(r.get("name"), str) and _number(r.get("length")) and (
        weight is None or (_number(weight) and weight >= WEIGHT_MIN))


class ListScanner:
    """Reads ``[{...}, {...}]`` in pieces; see the module."""

    def __init__(self, place=START, depth=0, in_string=False, escaped=False, held="", bad=False, n_complete=0, n_valid=0):
        self.place, self.depth, self.in_string, self.escaped = place, depth, in_string, escaped
        self.held, self.bad, self.n_complete, self.n_valid = held, bad, n_complete, n_valid

    def state(self) -> tuple:
        return (self.place, self.depth, self.in_string, self.escaped, self.held, self.bad, self.n_complete, self.n_valid)

    def feed(self, piece: str) -> None:
        i, own = 0, [self.held]
        while i < len(piece):
            start = i
            if self.escaped:
                self.escaped, i = False, i + 1
            elif self.in_string or self.place == RECORD:
                m = (IN_STRING if self.in_string else IN_RECORD).search(piece, i)
                i = m.end() if m else len(piece)
                sign = m.group() if m else ""
                if sign == "\\":
                    self.escaped = True
                elif sign == '"':
                    self.in_string = not self.in_string
                elif sign:
                    self.depth += 1 if sign == "{" else -1
            else:
                i += 1
                if not piece[start].isspace():
                    self._between(piece[start])
            if self.place == RECORD:
                own.append(piece[start:i])
                if self.depth == 0:
                    self._record("".join(own))
                    own = []
        self.held = "".join(own) if self.place == RECORD else ""

    def _between(self, sign: str) -> None:
        """A sign outside all records."""
        ok = {"[": (START,), "{": (FIRST, NEXT), ",": (AFTER,), "]": (FIRST, AFTER)}.get(sign, ())
        self.bad |= self.place not in ok
        if sign == "{":
            self.place, self.depth = RECORD, 1
        elif sign == '"':
            self.in_string = True
        elif self.place in ok:
            self.place = {"[": FIRST, ",": NEXT, "]": END}[sign]

    def _record(self, text: str) -> None:
        ok = valid_record(text)
        self.n_complete += 1
        self.n_valid += ok is True
        self.bad |= ok is None
        self.place = AFTER

    def strict_ok(self) -> bool:
        """Whether what was read is a whole list, all of whose records keep the rules."""
        return self.place == END and not self.bad and self.n_valid == self.n_complete


def _step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    lists: dict[int, list] = {}  # next seq, scanner, waiting pieces
    if state.exists:
        for list_id, next_seq, scan, waiting in json.loads(state.get[0]):
            lists[list_id] = [next_seq, ListScanner(*scan), {seq: (delta, last) for seq, delta, last in waiting}]
    out = []
    for frame in frames:
        for list_id, seq, delta, last in zip(frame["list_id"].tolist(), frame["seq"].tolist(), frame["delta"],
                                             frame["is_last"], strict=True):
            one = lists.setdefault(list_id, [0, ListScanner(), {}])
            next_seq, scanner, waiting = one
            if seq >= next_seq and seq not in waiting:
                waiting[seq] = (delta if isinstance(delta, str) else "", last is not None and bool(last))
            while next_seq in waiting:
                delta, last = waiting.pop(next_seq)
                scanner.feed(delta)
                out.append((list_id, next_seq, last, scanner.n_complete, scanner.n_valid, scanner.strict_ok() if last else None))
                next_seq += 1
            one[0] = next_seq
    state.update((json.dumps([(list_id, next_seq, scanner.state(), [(seq, *piece) for seq, piece in waiting.items()])
                              for list_id, (next_seq, scanner, waiting) in lists.items()]),))
    if out:
        yield pd.DataFrame(out, columns=["list_id", "seq", "is_last", "n_complete", "n_valid", "strict_ok"]) \
            .astype({"strict_ok": "object"})


def scan_lists(pieces: DataFrame) -> DataFrame:
    """A stream of ``list_id, seq, delta, is_last`` -> per piece, in order, the complete records so far, how
    many keep the rules, and on the last piece whether the whole list does.  ``seq`` counts from 0."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    slot = F.pmod(F.xxhash64("list_id"), F.lit(SLOTS)).cast("int")
    return pieces.where("list_id IS NOT NULL AND seq IS NOT NULL").withColumn("slot", slot).groupBy("slot").applyInPandasWithState(
        _step, RESULT, STATE, "append", GroupStateTimeout.NoTimeout)
