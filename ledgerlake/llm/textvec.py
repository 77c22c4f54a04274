"""Word features of texts as 64-bit hashes, in array operations over a run of documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_K = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a multiplicative hash: spread high bits to low ones."""
    h = (h ^ (h >> np.uint64(30))) * _M
    return h ^ (h >> np.uint64(27))


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codepoints of the lower-cased texts (null: empty) one after another, and where each begins and the last ends."""
    parts = [(t or "").lower().encode("utf-32-le", "replace") for t in texts.to_pylist()]
    at = np.concatenate(([0], np.cumsum([len(p) // 4 for p in parts], dtype=np.int64))) if parts else np.zeros(1, np.int64)
    return np.frombuffer(b"".join(parts), np.uint32), at


#: Codepoints that count as letters or digits of a word, by the language's own tables, for the basic plane and beyond.
WORD = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def words(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each run of word characters."""
    return runs_of(WORD[points], at)


def runs_of(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each run of places that are inside and of one document."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[at] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    starts, ends = np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


#: Runs of more word characters than this (of scripts without blanks, or run together) also count by their inner grams.
LONG, GRAM = 24, 4


def span_hash(points: np.ndarray):
    """hash(starts, ends) of any spans of a run of codepoints or bytes, each in a few operations however long it is.

    A polynomial over the mixed codepoints, from prefix sums modulo 2**64: its base is odd, so powers have inverses.
    """
    n = len(points)
    power = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, _K), out=power[1:])
    back = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, np.uint64(pow(int(_K), -1, 1 << 64))), out=back[1:])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(points.astype(np.uint64) * _M + _K) * power[:-1], out=sums[1:])
    return lambda starts, ends: mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _M)


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """span_hash() of spans in order, over some ``most`` characters at a time: memory does not grow with the text."""
    out, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, "right")))
        out[lo:hi] = span_hash(points[base : ends[hi - 1]])(starts[lo:hi] - base, ends[lo:hi] - base)
        lo = hi
    return out


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, shingle hash) of the texts in order: ``width`` words in a row with A-Z lowered, or all words where
    there are fewer. Words are parted by the blanks of ASCII; a null text has none.
    """
    plain = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    raw = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    raw = raw + np.uint8(32) * ((raw >= 65) & (raw <= 90))
    starts, ends, doc = runs_of((raw != 32) & ((raw < 9) | (raw > 13)), at)
    n = len(starts)
    word = np.append(span_hashes(raw, starts, ends), np.zeros(width, np.uint64))
    owner = np.append(doc, np.full(width, -1))
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h += np.where(owner[k : n + k] == doc, mixed(word[k : n + k] + np.uint64(k + 1)) * np.uint64(int(_K) * (2 * k + 1) & (1 << 64) - 1), np.uint64(0))
    whole = (owner[width - 1 : n + width - 1] == doc) | (np.append(-1, doc[:-1]) != doc if n else np.zeros(0, bool))
    doc, h, _ = counted(doc[whole], mixed(h[whole]))
    return doc, h


def word_features(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of each whole word, and of each inner gram of ``GRAM`` characters of words beyond ``LONG``."""
    starts, ends, doc = words(points, at)
    long = ends - starts > LONG
    many = (ends - starts)[long] - GRAM + 1
    inner = np.repeat(starts[long] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return np.concatenate([doc, np.repeat(doc[long], many)]), np.concatenate([span_hashes(points, starts, ends), span_hashes(points, inner, inner + GRAM)])


def counted(doc: np.ndarray, feat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, feature) in order, and how often each occurs."""
    order = np.lexsort((feat, doc))
    doc, feat = doc[order], feat[order]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (feat[1:] != feat[:-1])))) if len(doc) else np.zeros(0, np.int64)
    return doc[new], feat[new], np.diff(np.append(new, len(doc)))
