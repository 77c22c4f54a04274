"""Token counts that follow edits.

A document keeps a segment tree over its pre-tokens: leaves of ``LEAF`` pre-tokens hold their token counts and
first characters, inner nodes the sums below them, the root the document's count. An edit touches the leaves
it overlaps and those whose pre-tokens could see it (a pre-token is decided by at most two characters
after it). Only their text is encoded again, with a few characters of context to the right; if a pre-token begins
where the next old leaf began, everything from there on is as before, else the next leaf joins. The text that was
encoded is cut into leaves anew. Where they are no more than before, their sums replace the old ones on the paths to
the root, and leaves that are left over are empty; else the tree is made again of its leaves' counts, without
encoding the rest. Text, leaves and sums go on to the next batch of edits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe

LEAF, CONTEXT = 32, 3
RUN_BYTES = 1 << 20
EDITS = "array<struct<start:long,length:long,insert:string>>"


def make_tree(leaves: np.ndarray) -> np.ndarray:
    """Heap of sums: node 1 is the root, the children of i are 2i and 2i + 1, leaves fill the last level."""
    width = 1 << max(0, len(leaves) - 1).bit_length()
    tree = np.zeros(2 * width, np.int64)
    tree[width : width + len(leaves)] = leaves
    for lo in (1 << k for k in range(width.bit_length() - 2, -1, -1)):
        tree[lo : 2 * lo] = tree[2 * lo : 4 * lo : 2] + tree[2 * lo + 1 : 4 * lo : 2]
    return tree


def update_tree(tree: np.ndarray, leaf: int, value: int) -> None:
    """Set a leaf and the sums above it."""
    at = len(tree) // 2 + leaf
    more = value - tree[at]
    while at and more:
        tree[at] += more
        at //= 2


def build(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, starts, tree`` per row of docs: the text (null: empty), each leaf's first character, the sums."""
    raw = bpe.shipped(docs.sparkSession, ranks_path)
    kept = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        codec = bpe.codec_of(raw.value)
        for b in batches:
            for lo, hi in bpe.runs(b.column(1)):
                e = codec.encode(b.column(1).slice(lo, hi - lo))
                starts, trees = [], []
                for s, z in zip(e.doc_slices[:-1].tolist(), e.doc_slices[1:].tolist(), strict=True):
                    at = np.arange(s, z, LEAF)
                    starts.append(e.slice_points[at] - e.slice_points[s])
                    trees.append(make_tree(np.diff(np.append(e.slice_ids[at], e.slice_ids[z]))))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(starts, pa.list_(pa.int64())), pa.array(trees, pa.list_(pa.int64()))], ["id", "text", "starts", "tree"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, text string, starts array<long>, tree array<long>")


def tidy(edits: list | None, size: int) -> list[tuple[int, int, str]]:
    """Edits as (start, end, insert) in order, cut to the text and to where the edit before ends. Edits with a null start are left out."""
    out, last = [], 0
    for e in sorted((e for e in edits or [] if e and e["start"] is not None), key=lambda e: e["start"]):
        start = min(max(e["start"], last), size)
        last = min(max(start, e["start"] + max(e["length"] or 0, 0)), size)
        out.append((start, last, e["insert"] or ""))
    return out


def edited(text: str, edits: list[tuple[int, int, str]], lo: int, hi: int) -> str:
    """text[lo:hi] with the edits, all of which lie within."""
    parts = []
    for start, end, insert in edits:
        parts += [text[lo:start], insert]
        lo = end
    return "".join([*parts, text[lo:hi]])


class _Region:
    """Leaves a to b of one document whose text is encoded again, and the edits within; then its new text and leaves."""

    def __init__(self, doc: int, a: int, b: int, edits: list):
        self.doc, self.a, self.b, self.edits, self.size = doc, a, b, edits, 0
        self.text, self.starts, self.counts = "", np.zeros(0, np.int64), np.zeros(0, np.int64)


def _regions(doc: int, edits: list, starts: np.ndarray) -> list[_Region]:
    found: list[_Region] = []
    for e in edits:
        a = max(0, int(np.searchsorted(starts, e[0] - CONTEXT, "right")) - 1)
        b = int(np.searchsorted(starts, e[1], "left"))
        b = max(b, a + 1) if len(starts) else 0
        if found and (a < found[-1].b or not len(starts)):
            found[-1].b = max(found[-1].b, b)
            found[-1].edits.append(e)
        else:
            found.append(_Region(doc, a, b, [e]))
    return found


def _settle(codec: bpe.Codec, texts: list[str], starts: list[np.ndarray], regions: list[list[_Region]], leaf: int = LEAF) -> None:
    """Encode every region anew and cut it into leaves; one whose end no longer is a boundary takes the next leaf in."""
    todo = [r for rs in regions for r in rs]
    while todo:
        news, tails = [], []
        for r in todo:
            text, s = texts[r.doc], starts[r.doc]
            lo, hi = (int(s[r.a]) if len(s) else 0), (int(s[r.b]) if r.b < len(s) else len(text))
            news.append(edited(text, r.edits, lo, hi))
            tails.append(text[hi : hi + CONTEXT])
        e = codec.encode(pa.array([n + t for n, t in zip(news, tails, strict=True)], pa.string()))
        again: list[_Region] = []
        for k, r in enumerate(todo):
            s, z = e.doc_slices[k], e.doc_slices[k + 1]
            points = e.slice_points[s : z + 1] - (e.slice_points[s] if z > s else 0)
            at = int(np.searchsorted(points, len(news[k]))) if z > s else 0
            r.size += len(news[k])
            if not tails[k] or points[at] == len(news[k]):
                first = np.arange(s, s + at, leaf)
                r.text, r.starts = news[k], e.slice_points[first] - e.slice_points[s] if at else np.zeros(0, np.int64)
                r.counts = np.diff(e.slice_ids[np.append(first, s + at)]) if at else np.zeros(0, np.int64)
            else:
                r.b += 1
                again.append(r)
        for r in again:
            mine = regions[r.doc]
            k = mine.index(r) if r in mine else -1
            while 0 <= k < len(mine) - 1 and mine[k + 1].a < r.b:
                nxt = mine.pop(k + 1)
                r.b, r.edits, r.size = max(r.b, nxt.b), r.edits + nxt.edits, r.size + nxt.size
        todo = [r for r in again if r in regions[r.doc]]


def _renewed(text: str, starts: np.ndarray, tree: np.ndarray, regions: list[_Region]) -> tuple[str, np.ndarray, np.ndarray]:
    """Text, leaves and sums of one document after its regions have been settled."""
    if not regions:
        return text, starts, tree
    fits = all(len(r.starts) <= r.b - r.a for r in regions)
    leaves = tree[len(tree) // 2 :][: len(starts)]
    parts, firsts, counts, at, leaf, shift = [], [], [], 0, 0, 0
    for r in regions:
        lo = int(starts[r.a]) if r.a < len(starts) else len(text)
        hi = int(starts[r.b]) if r.b < len(starts) else len(text)
        parts += [text[at:lo], r.text]
        spare = r.b - r.a - len(r.starts) if fits else 0  # empty leaves at the region's end
        firsts += [starts[leaf : r.a] + shift, r.starts + lo + shift, np.full(spare, lo + shift + len(r.text))]
        counts += [leaves[leaf : r.a], r.counts, np.zeros(spare, np.int64)]
        shift += len(r.text) - (hi - lo)
        at, leaf = hi, r.b
    text = "".join([*parts, text[at:]])
    firsts, counts = np.concatenate([*firsts, starts[leaf:] + shift]), np.concatenate([*counts, leaves[leaf:]])
    if not fits or 2 * np.count_nonzero(counts) < len(counts):
        firsts, counts = firsts[counts > 0], counts[counts > 0]
        return text, firsts, make_tree(counts)
    for r in regions:
        for k in range(r.a, r.b):
            update_tree(tree, k, int(counts[k]))
    return text, firsts, tree


def recount(trees: DataFrame, edits: str | list[str] = "edits", ranks_path: str = "", state: bool = True) -> DataFrame:
    """Apply each row's edits (EDITS: start and length in characters of the text, and what to insert).

    trees: rows of build() or of recount() with one more column of edits, or several: batches that are applied in turn,
    each to the text that the one before left. Returns ``id, n_tokens, n_tokens_edited, n_chars_edited, n_chars_encoded``
    (counts before and after, the length of the new text, how many characters were encoded for it) and, unless state is
    False, the new ``text, starts, tree`` for further edits. Null or empty edits change nothing. The edits of a batch are
    taken in order of start; one that begins within the one before starts at its end.
    """
    raw = bpe.shipped(trees.sparkSession, ranks_path)
    batches_of = [edits] if isinstance(edits, str) else edits
    kept = trees.select("id", "text", "starts", "tree", *[F.col(c).cast(EDITS).alias(f"e{k}") for k, c in enumerate(batches_of)])

    def run(batches):
        codec = bpe.codec_of(raw.value)
        for b in batches:
            for lo, hi in bpe.runs(b.column(1), RUN_BYTES):
                part = b.slice(lo, hi - lo)
                texts = part.column(1).to_pylist()
                starts = [np.array(x, np.int64) for x in part.column(2).to_pylist()]
                sums = [np.array(x, np.int64) for x in part.column(3).to_pylist()]
                before, encoded = [int(t[1]) for t in sums], [0] * len(texts)
                for batch in part.columns[4:]:
                    cuts = [tidy(e, len(t)) for e, t in zip(batch.to_pylist(), texts, strict=True)]
                    regions = [_regions(d, e, s) for d, (e, s) in enumerate(zip(cuts, starts, strict=True))]
                    _settle(codec, texts, starts, regions)
                    encoded = [n + sum(r.size for r in rs) for n, rs in zip(encoded, regions, strict=True)]
                    new = [_renewed(*row) for row in zip(texts, starts, sums, regions, strict=True)]
                    texts, starts, sums = (list(x) for x in zip(*new, strict=True))
                columns = [part.column(0), *(pa.array(c, pa.int64()) for c in (before, [int(t[1]) for t in sums], [len(t) for t in texts], encoded))]
                if state:
                    columns += [pa.array(texts, pa.string()), pa.array(starts, pa.list_(pa.int64())), pa.array(sums, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = [f"id {kept.schema[0].dataType.simpleString()}", *(f"{c} long" for c in ("n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded"))]
    schema += ["text string", "starts array<long>", "tree array<long>"] * state
    names = [c.split()[0] for c in schema]
    return kept.mapInArrow(run, ", ".join(schema))
