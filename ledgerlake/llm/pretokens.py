"""Pre-token boundaries by an associative scan over transition functions.

The pattern splits text into contractions, runs of letters, numbers or other marks (each with one leading
space), and white space. A small automaton over codepoint classes tells where its matches begin. Each
class is a function from state to state; functions compose associatively, so all positions are resolved
with a blocked prefix scan in array operations: compose within blocks, scan the blocks' totals, apply.
No regular expression touches the text. Boundaries that only later characters decide (a contraction
that does not come off, the last blank before a word) are reported one position back.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

STATES = START, LETTER, NUMBER, OTHER, APOS, APOS_R, APOS_V, APOS_L, DONE, BLANK, SPACE, BLANKS, SPACES = range(13)
CLASSES = C_LETTER, C_SHORT, C_R, C_V, C_L, C_E, C_NUMBER, C_OTHER, C_APOS, C_BLANK, C_SPACE = range(11)
#: Contractions of the pattern: 's 't 'm 'd (one letter), 're 've 'll (two letters).
SHORT, LONG = "stmd", {"r": (APOS_R, C_E), "v": (APOS_V, C_E), "l": (APOS_L, C_L)}
HERE, BACK = 1, 2  # a match begins at this character; at the one before
_PENDING = {APOS_R: C_E, APOS_V: C_E, APOS_L: C_L}


def _step(state: int, c: int) -> tuple[int, int]:
    """Next state and which boundaries reading class c in this state decides."""
    if state in _PENDING:
        if c == _PENDING[state]:
            return DONE, 0
        nxt, here = _step(LETTER, c)  # the apostrophe stood alone; a run of letters began after it
        return nxt, here | BACK
    if c <= C_E:
        if state == APOS:
            if c == C_SHORT:
                return DONE, 0
            for k, (pending, _) in zip((C_R, C_V, C_L), LONG.values(), strict=True):
                if c == k:
                    return pending, 0
        joined = (LETTER, BLANK)
        nxt = LETTER
    elif c == C_NUMBER:
        joined, nxt = (NUMBER, BLANK), NUMBER
    elif c in (C_OTHER, C_APOS):
        joined = (OTHER, APOS, BLANK)
        nxt = OTHER if c == C_OTHER or state in (OTHER, APOS, BLANK, BLANKS) else APOS
    else:
        if state in (BLANK, SPACE, BLANKS, SPACES):
            return (BLANKS if c == C_BLANK else SPACES), 0
        return (BLANK if c == C_BLANK else SPACE), HERE
    if state == BLANKS:
        return nxt, BACK
    if state == SPACES:
        return nxt, BACK | HERE
    return nxt, 0 if state in joined else HERE


@lru_cache(1)
def _tables():
    """The monoid of transition functions: class -> function, composition, application, boundaries.

    Classes from len(CLASSES) on are the same classes at a document's first character: they forget what came before.
    """
    n = len(CLASSES)
    basic = [tuple(_step(s, c)[0] for s in STATES) for c in CLASSES]
    first = [(f[START],) * len(STATES) for f in basic]
    found: dict[tuple, int] = {}
    for f in [*basic, *first]:
        found.setdefault(f, len(found))
    todo = list(found)
    while todo:
        f = todo.pop()
        for g in [*basic, *first]:
            if (h := tuple(g[x] for x in f)) not in found:
                found[h] = len(found)
                todo.append(h)
    funcs = list(found)
    assert len(funcs) <= 256
    compose = np.zeros((256, 256), np.uint8)
    for a, f in enumerate(funcs):
        for b, g in enumerate(funcs):
            compose[a, b] = found[tuple(g[x] for x in f)]
    apply = np.zeros((256, 16), np.uint8)
    for a, f in enumerate(funcs):
        apply[a, : len(f)] = f
    marks = np.zeros((16, 2 * n), np.uint8)
    for s in STATES:
        for c in CLASSES:
            marks[s, c] = _step(s, c)[1]
            marks[s, n + c] = HERE | (BACK if s in _PENDING else 0)
    of_class = np.array([found[f] for f in [*basic, *first]], np.uint8)
    return of_class, compose.ravel(), apply.ravel(), marks.ravel()


def _scan(f: np.ndarray, block: int = 64) -> np.ndarray:
    """Inclusive prefix composition of an array of functions."""
    _, compose, _, _ = _tables()
    n = len(f)
    if n <= block:
        out = f.copy()
        for k in range(1, n):
            out[k] = compose[int(out[k - 1]) << 8 | int(f[k])]
        return out
    rows = n // block
    body = f[: rows * block].reshape(rows, block).T.copy()
    for k in range(1, block):
        body[k] = compose[body[k - 1].astype(np.uint16) << 8 | body[k]]
    before = _scan(body[-1], block)  # of whole blocks
    # every block but the first is entered with what the blocks before it compose to
    body[:, 1:] = compose[before[None, :-1].astype(np.uint16) << 8 | body[:, 1:]]
    out = np.empty(n, np.uint8)
    out[: rows * block].reshape(rows, block)[:] = body.T
    if rows * block < n:
        last = out[rows * block - 1]
        for k in range(rows * block, n):
            last = compose[int(last) << 8 | int(f[k])]
            out[k] = last
    return out


def class_table(members) -> np.ndarray:
    """Codepoint -> class. members(pattern) gives the codepoints that match: the tokenizer's own tables count."""
    table = np.full(0x110000, C_OTHER, np.uint8)
    table[members(r"\p{L}")] = C_LETTER
    table[members(r"\p{N}")] = C_NUMBER
    table[members(r"\s")] = C_SPACE
    for ch in SHORT:
        table[ord(ch)] = C_SHORT
    for ch, c in (("r", C_R), ("v", C_V), ("l", C_L), ("e", C_E), ("'", C_APOS), (" ", C_BLANK)):
        table[ord(ch)] = c
    return table


def boundaries(points: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where matches begin, as sorted positions in points.

    points: codepoints of documents one after another; starts: where non-empty documents begin (0 first).
    """
    if not len(points):
        return np.zeros(0, np.int64)
    of_class, _, apply, marks = _tables()
    n = len(CLASSES)
    cls = np.append(table[points], np.uint8(C_OTHER))  # one more document after the last, to settle its end
    cls[np.append(starts, len(points))] += n
    state = np.empty(len(cls), np.uint8)
    state[0] = START
    state[1:] = apply[_scan(of_class[cls[:-1]]).astype(np.uint16) << 4]
    mark = marks[state.astype(np.uint16) * (2 * n) + cls]
    begins = (mark & HERE).astype(bool)
    begins[:-1] |= (mark[1:] & BACK).astype(bool)
    return np.flatnonzero(begins[:-1])
