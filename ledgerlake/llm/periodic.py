"""Periodic runs of words: maximal stretches that repeat a root at least twice, found by suffix-tree extensions of Lyndon roots.

Every run has a Lyndon rotation of its root that is, where it begins, the longest Lyndon word of the text over the alphabet or over
the reversed one. So there are at most two candidates a place: the longest Lyndon word from i ends before the next suffix that is
smaller than that from i. Suffixes come in order from the suffix tree of the words (Ukkonen); longest common
extensions to the right from lowest common ancestors in it, by an Euler tour and range minima, and to the left from the tree of the reversed words.
A candidate is a run if both extensions together are as long as its root.

A run of at least ``least`` words holds the same ``least / 2`` words in a row twice, and such windows cover all of it. Trees are
therefore built of the stretches that repeated windows cover, one by one; texts without any have no run and need no tree.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffixtree import Extensions, SuffixTree

LEAST = 12


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one of a smaller rank, or the length."""
    values = rank.tolist()
    out, stack = [len(values)] * len(values), []
    for k, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = k
        stack.append(k)
    return np.array(out, np.int64)


def runs_of(symbols: list[int]) -> np.ndarray:
    """Rows (start, end, period) of all runs of a sequence of numbers from 1, in order of start and period."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    rising, depth = tree.tour()
    right, left = Extensions(tree, rising, depth), Extensions(back, *back.tour())
    suffix_of = np.full(len(depth), -1, np.int64)
    suffix_of[tree.leaf] = np.arange(n + 1)
    found = []
    for tour in (rising, tree.tour(falling=True)[0]):
        order = suffix_of[tour]
        order = order[order >= 0]
        rank = np.empty(n + 1, np.int64)
        rank[order] = np.arange(n + 1)
        i = np.arange(n)
        j = next_smaller(rank[:n])
        more = right(i, j)
        before = np.where(i > 0, left(n - i, n - j), 0)
        ok = more + before >= j - i
        found.append(np.stack([i - before, j + more, j - i], 1)[ok])
    return np.unique(np.concatenate(found), axis=0)


def covered(words: list[bytes], width: int) -> np.ndarray:
    """Which words lie in a window of ``width`` words that occurs twice or more, by hashes: none is missed."""
    n = len(words)
    out = np.zeros(n + 1, np.int64)
    if n < 2:
        return out[:n] > 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    m = n - width + 1
    if m < 2:
        return out[:n] > 0
    window = np.zeros(m, np.uint64)
    for k in range(width):
        window = window * np.uint64(0x9E3779B97F4A7C15) + h[k : k + m]
    window ^= window >> np.uint64(29)
    order = np.argsort(window)
    s = window[order]
    same = s[1:] == s[:-1]
    twice = np.concatenate((order[1:][same], order[:-1][same]))
    again = np.zeros(m, bool)
    again[twice] = True
    again = np.flatnonzero(again)
    np.add.at(out, again, 1)
    np.add.at(out, again + width, -1)
    return np.cumsum(out)[:n] > 0


def runs(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of the runs of at least ``least`` words and two periods, by start, then period."""
    inside = covered(words, least // 2)
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    found = []
    for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if hi - lo >= least:
            ids: dict[bytes, int] = {}
            told = runs_of([ids.setdefault(w, len(ids) + 1) for w in words[lo:hi]])
            told = told[told[:, 1] - told[:, 0] >= least]
            found.append(np.stack([told[:, 0] + lo, told[:, 1] - told[:, 0], told[:, 2]], 1))
    out = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def dropped(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words a run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change)[:n] > 0


SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def told(words: list[bytes]) -> tuple:
    """A row of SCHEMA for the words of one text."""
    found = runs(words)
    if not len(found):
        return 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    start, length, period = found[np.lexsort((found[:, 2], found[:, 0], -found[:, 1]))[0]].tolist()
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found.tolist())
    kept = b" ".join([words[k] for k in np.flatnonzero(~dropped(len(words), found)).tolist()])
    return len(found), start, length, period, 1000 * length // period, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def planted(words: list[bytes], key: str | None) -> list[bytes]:
    """The query's damage: for one key in ten the words from some place on repeat a stretch of them."""
    h, n = zlib.crc32(key.encode()) if key is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (1 + (n - a) // p))[: n - a]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage=None) -> DataFrame:
    """One row per row of docs: id, ``n_runs``, the longest run (``start, length, period, exponent_milli``; ties: smallest start,
    then period; null without a run), ``runs_sha256`` of all runs' lines ``start,length,period`` and ``collapsed_sha256`` of the
    words outside repeated periods, joined by one blank.

    Words are parted by the blanks of ASCII and numbered from 0. A null, empty or blank text has no word and no run; repeated rows get a row
    each; an empty table gives none; other columns are not read. damage: a function of the words and the id's text (null: None)
    applied first, as the query asks. No shuffle: a text is one task's work, at some 1,000 bytes a word of its repeated stretches.
    """
    kept = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("string").alias("key"), F.col(text_col).cast("binary").alias("text"))
    types = [(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.string()) for c in SCHEMA.split(", ")]

    def run(batches):
        for b in batches:
            rows = []
            for key, text in zip(b.column(1), b.column(2), strict=True):
                words = (text.as_py() or b"").split()
                rows.append(told(damage(words, key.as_py()) if damage else words))
            columns = list(zip(*rows, strict=True)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)]], ["id", *[n for n, _ in types]])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, {SCHEMA}").withColumnRenamed("id", id_col)
