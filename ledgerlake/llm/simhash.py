"""SimHash near-duplicates by bit-sliced comparison.

``near_duplicates``: a fingerprint is the bitwise majority over the XXH64 hashes of a document's word shingles. Two texts
are linked when their fingerprints differ in at most ``radius`` bits. Plan:

1. fingerprints in Arrow batches; equal fingerprints collapse to one representative (an aggregate that
   combines before the shuffle), so a group of copies of any size is one row from here on;
2. the 64 bits are cut into bands so that two fingerprints within the radius must agree on ``match`` of
   them; each choice of ``match`` bands is a key. More distinct fingerprints take more key bits, so
   buckets stay small; every scheme is lossless;
3. within a bucket, fingerprints are stored as vertical bit planes, 64 to a word. All distances of a
   fingerprint to 64 others advance by one plane with carry-save bitwise counters; a block is abandoned
   as soon as all of its lanes exceed the radius;
4. a bucket above ``chunk`` is split into chunks that are joined pair by pair in separate groups, so no
   task holds a whole hot bucket; each group returns a spanning forest of its links, never all pairs;
5. components over the forest edges, then a join back to the documents.

``similar``: texts are linked when the sets of their shingles have a Jaccard similarity of ``similarity`` or more, as
near-duplicate stages of a pipeline ask. A fingerprint bit of two such sets differs with a chance of p at most (the angle
between them), which at 0.8 is 0.15: bands must be met by chance, not by force. Each set gets more majority bits, enough
for so many bands of 12 bits or more that a pair just at the threshold misses all of them once in 500 times, and 128 bits
of its own for step 3, with a radius four deviations above the mean. That leaves candidates: components of them are
compared on the sets themselves, exactly, so nothing below the threshold links.
"""

from __future__ import annotations

from itertools import combinations
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import bpe, textvec
from .graph import components
from .scratch import cut, fresh, tasks_for

SEED = 42
#: (bands, bands that must agree for radius 4): bands - match = radius, key bits about 64 * match / bands.
SCHEMES = ((5, 1), (6, 2), (7, 3), (8, 4), (9, 5))
#: Fingerprints of a bucket that are compared as one chunk. Each row of a bucket of n is copied n / CHUNK times; a pair of chunks is a second's work.
CHUNK = 8192
_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, width: int = 4, piece: int = 1 << 16) -> int:
    """Majority fingerprint of one UTF-8 text; 0 where it has no word. Long texts go in pieces of shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = max(1, n - width + 1)
    lo, hi = starts[:k].tolist(), ends[min(width, n) - 1 :].tolist()
    ones, h64 = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, k, piece):
        h = np.array([h64(joined[s:e], SEED) for s, e in zip(lo[at : at + piece], hi[at : at + piece], strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > k, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """``id, fp`` per row of docs, fp the fingerprint as a signed long. Null texts count as empty (fp 0)."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py() or b"", width) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, fp long")


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the classes of i[k] and j[k]; labels holds, and goes on holding, the smallest index of a class."""
    while len(i):
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := labels[labels], labels):
            labels = up
    return labels


def sliced_links(group: np.ndarray, fp: np.ndarray, radius: int, slab: int = 1 << 16, step: int = 8):
    """Yield arrays (i, j) of positions with i < j in one group whose fingerprints differ in <= radius bits.

    group: sorted group numbers; fp: uint64, one or more words a row. Blocks are words of 64 fingerprints of one group.
    """
    fp = fp.reshape(len(group), -1)
    n = len(fp)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, n))
    words = -(-size // 64)
    within = np.arange(n) - np.repeat(first, size)
    own = np.repeat(np.cumsum(words) - words, size) + within // 64
    lane = (within % 64).astype(np.uint64)
    word_at = np.flatnonzero(within % 64 == 0)
    planes = np.empty((64 * fp.shape[1], len(word_at)), np.uint64)
    for b in range(len(planes)):
        planes[b] = np.bitwise_or.reduceat(((fp[:, b // 64] >> np.uint64(b % 64)) & _ONE) << lane, word_at)
    valid = np.bitwise_or.reduceat(_ONE << lane, word_at)
    todo = np.repeat(np.cumsum(words), size) - own  # own word and those after it
    upto = np.cumsum(todo)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + slab, "right")))
        many = todo[at:end]
        q = np.repeat(np.arange(at, end), many)
        w = np.repeat(own[at:end], many) + np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        at = end
        counters = [np.zeros(len(q), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = np.zeros(len(q), np.uint64)
        for b in range(len(planes)):
            carry = planes[b][w] ^ (-((fp[q, b // 64] >> np.uint64(b % 64)) & _ONE).astype(np.int64)).view(np.uint64)
            for c in counters:
                more = c & carry
                c ^= carry
                carry = more
            over |= carry  # beyond what the counters hold, so beyond the radius
            if b % step == step - 1:
                over |= _beyond(counters, radius)
                live = (~over & valid[w]) != 0
                if not live.all():
                    q, w, over, *counters = (a[live] for a in (q, w, over, *counters))
        hit = ~over & valid[w]
        bits = np.unpackbits(hit.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        e, lanes = np.nonzero(bits)
        i, j = q[e], word_at[w[e]] + lanes
        yield i[j > i], j[j > i]


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds radius, compared from the highest counter down."""
    more, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ALL)
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def _groups(forest, buffer: int, keys: int = 4):
    """mapInArrow body: rows sorted by their first ``keys`` columns -> forest(columns) of runs of whole groups.

    Some ``buffer`` rows at a time, or one larger group.
    """

    def run(batches):
        held = None
        for b in batches:
            now = pa.Table.from_batches([b])
            held = now if held is None else pa.concat_tables([held, now])
            if held.num_rows >= buffer:
                cols = [held.column(c).to_numpy() for c in range(keys)]
                last = np.logical_and.reduce([c == c[-1] for c in cols])
                cutoff = int(np.argmax(last))  # the last group may go on in the next batch
                if cutoff:
                    yield from forest(held.slice(0, cutoff).combine_chunks())
                    held = held.slice(cutoff)
        if held is not None and held.num_rows:
            yield from forest(held.combine_chunks())

    return run


def _group_numbers(t: pa.Table, keys: int = 4) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    for k in range(keys):
        c = t.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def _edges(ids: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[labels[linked]])], ["a", "b"])


def _near(radius: int, buffer: int = 1 << 17):
    """Rows (four group columns, id, fingerprint words) -> spanning forest of the links within each group."""

    def forest(t: pa.Table):
        ids = t.column(4).to_numpy()
        fp = np.stack([t.column(c).to_numpy() for c in range(5, t.num_columns)], axis=1).view(np.uint64)
        labels = np.arange(len(ids))
        for i, j in sliced_links(_group_numbers(t), fp, radius):
            labels = merge_labels(labels, i, j)
        yield _edges(ids, labels)

    return _groups(forest, buffer)


def _dealt(rows: DataFrame, keys: list[str], by: str, chunk: int, load: Column | None = None, most: int = 1) -> DataFrame:
    """rows with ``c, d``, sorted by keys, c, d within partitions that hold whole groups of them.

    A key of more than ``chunk`` rows, or whose ``load`` sums up to more than ``most``, is dealt to chunks; each pair of
    chunks (c, d) is a group of its own.
    """
    parts = F.ceil(F.count("*") / chunk)
    parts = parts if load is None else F.greatest(parts, F.ceil(F.sum(load) / most))
    hot = cut(rows.groupBy(*keys).agg(parts.cast("int").alias("parts")).where("parts > 1"), "hot-keys")
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64(by, F.lit(7)), parts).cast("int")
    out = rows.join(hot, keys, "left").withColumn("c", mine).withColumn("d", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    out = out.withColumns({"c": F.least("c", "d"), "d": F.greatest("c", "d")})
    return out.repartition(tasks_for(rows.sparkSession), *keys, "c", "d").sortWithinPartitions(*keys, "c", "d", by)


def links(reps: DataFrame, radius: int = 4, chunk: int = CHUNK, bucket: int = 64, scheme: int | None = None, n: int | None = None) -> DataFrame:
    """Forest edges ``a, b`` between distinct fingerprints (column fp) within radius bits.

    scheme: index into SCHEMES; by default the first whose expected bucket holds at most ``bucket``.
    """
    n = reps.count() if n is None else n
    if scheme is None:
        scheme = next((k for k, (bands, m) in enumerate(SCHEMES) if n <= bucket << (64 * m // bands)), len(SCHEMES) - 1)
    bands, match = SCHEMES[scheme]
    bands += radius - 4
    cuts = [round(k * 64 / bands) for k in range(bands + 1)]
    keys = []
    for pick in combinations(range(bands), match):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in pick)
        keys.append(F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")))
    rows = reps.select("fp", F.posexplode(F.array(*keys)).alias("band", "key"))
    dealt = _dealt(rows, ["band", "key"], "fp", chunk)
    return dealt.select("band", "key", "c", "d", "fp", F.col("fp").alias("f0")).mapInArrow(_near(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, **how) -> DataFrame:
    """One row per document: id column, ``fingerprint`` (16 hex digits), ``component_id``.

    component_id is the smallest id of the documents reachable by links. Null and empty texts have
    fingerprint zero and are linked with each other; repeated rows each get a row; a null id is never
    the smallest unless all are null; an empty table gives an empty one. Other columns are not read.
    """
    fps = cut(fingerprints(docs, id_col, text_col, width), "fingerprints")
    reps = cut(fps.groupBy("fp").agg(F.min("id").alias("low")), "reps")
    n = reps.count()
    comp = components(links(reps, radius, n=n, **how)).withColumnsRenamed({"vertex": "fp"})
    root = cut(reps.join(comp, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "rooted", n)
    low = cut(root.groupBy("root").agg(F.min("low").alias("component_id")), "lowest", n)
    member = cut(root.select("fp", "root").join(low, "root").select("fp", "component_id"), "members", n)
    return fps.join(member, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Bits of a set's own fingerprint beside those of its bands, and the bits that each byte's value adds to eight counts in a word.
OWN_BITS = 128
_SPREAD = np.array([sum((v >> k & 1) << 8 * k for k in range(8)) for v in range(256)], np.uint64)


def bands_for(n: int, similarity: float, miss: float = 0.002) -> tuple[int, int, int]:
    """(bands, bits of a band, radius of OWN_BITS) for n sets: a pair at ``similarity`` meets in no band with a chance of ``miss``."""
    p = acos(2 * similarity / (1 + similarity)) / pi
    bits = min(24, max(12, ceil(log2(max(n, 1) / 2048))))  # buckets of some thousand at most: comparing is cheaper than more bands
    bands = ceil(log(miss) / log(1 - (1 - p) ** bits))
    return bands, bits, ceil(OWN_BITS * p + 4 * sqrt(OWN_BITS * p * (1 - p)))


def majority(doc: np.ndarray, h: np.ndarray, n: int, words: int, step: int = 8192) -> np.ndarray:
    """Majority bits (n by 64 * words) over each document's hashes; h in order of documents. Of none or a tie: zeros.

    A hash gives 64 bits a word, each word mixed anew. Eight counts advance with one addition: each byte of
    a word adds its bits to the eight bytes of a counter, for up to 255 hashes at a time.
    """
    size = np.bincount(doc, minlength=n)
    ends = np.cumsum(size)
    place = np.arange(len(h)) - np.repeat(ends - size, size)
    segments = np.flatnonzero(place % 255 == 0)
    sums = np.zeros((len(segments), words * 8), np.uint64)
    lo = 0
    while lo < len(segments):
        hi = max(lo + 1, int(np.searchsorted(segments, segments[lo] + step)))
        some = h[segments[lo] : segments[hi] if hi < len(segments) else len(h)]
        for k in range(words):
            m = textvec.mixed((some + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            sums[lo:hi, 8 * k : 8 * k + 8] = np.add.reduceat(_SPREAD.take(m.view(np.uint8)).reshape(-1, 8), segments[lo:hi] - segments[lo], axis=0)
        lo = hi
    counts = np.zeros((n, words * 64), np.int64)
    some = np.flatnonzero(size)
    if len(some):
        counts[some] = np.add.reduceat(sums.view(np.uint8), np.searchsorted(segments, (ends - size)[some]), axis=0, dtype=np.int64)
    return 2 * counts > size[:, None]


def _set_digests(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit digest of each document's set of hashes; of none: 0."""
    out = np.zeros(n, np.uint64)
    at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    if len(at):
        out[doc[at]] = textvec.mixed(np.add.reduceat(textvec.mixed(h), at))
    return out.view(np.int64)


def _runs(texts: pa.Array, docs: int = 512, size: int = 2 << 20):
    for lo, hi in bpe.runs(texts, size):
        yield from ((a, min(a + docs, hi)) for a in range(lo, hi, docs))


def signatures(docs: DataFrame, bands: int, bits: int, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """``id, set, f0, f1, keys`` per row of docs: a digest of its set of shingles, its own fingerprint, a key for each band."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    words = -(-(OWN_BITS + bands * bits) // 64)

    def run(batches):
        weight = 1 << np.arange(bits)
        for b in batches:
            for lo, hi in _runs(b.column(1)):
                n = hi - lo
                doc, h = textvec.shingles(b.column(1).slice(lo, n), width)
                bit = majority(doc, h, n, words)
                own = np.packbits(bit[:, :OWN_BITS], axis=1, bitorder="little").view(np.int64)
                keys = (bit[:, OWN_BITS : OWN_BITS + bands * bits].reshape(n * bands, bits) @ weight).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n), pa.array(_set_digests(doc, h, n)), pa.array(own[:, 0]), pa.array(own[:, 1]), keys], ["id", "set", "f0", "f1", "keys"])

    return kept.mapInArrow(run, f"id {kept.schema[0].dataType.simpleString()}, set long, f0 long, f1 long, keys array<int>")


def _alike(similarity: float, buffer: int = 512, step: int = 4096):
    """Rows (root, c, d, set, sorted hashes) -> spanning forest of the pairs within a group whose sets are similar enough."""

    def forest(t: pa.Table):
        ids, group = t.column(3).to_numpy(), _group_numbers(t, 3)
        lists = t.column(4).combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        labels = np.arange(len(ids))
        begins = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(ids))
        for lo, hi in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            n, size = hi - lo, np.diff(at[lo : hi + 1])
            names, place, times = np.unique(flat[at[lo] : at[hi]], return_inverse=True, return_counts=True)
            owner = np.repeat(np.arange(n), size)
            shared = times > 1  # what only one set holds is in common with none
            owner, place = owner[shared[place]], (np.cumsum(shared) - 1)[place[shared[place]]]
            names = names[shared]
            order = np.argsort(place, kind="stable")
            place, owner = place[order], owner[order]
            common = np.zeros((n, n), np.float32)
            for first in range(0, len(names), step):  # sets as rows of a matrix, some columns at a time
                a, z = np.searchsorted(place, (first, first + step))
                x = np.zeros((n, step), np.float32)
                x[owner[a:z], place[a:z] - first] = 1
                common += x @ x.T
            either = size[:, None] + size[None, :] - common
            i, j = np.nonzero(np.triu(common >= similarity * either - 1e-6 * either, 1) & (either > 0))
            labels = merge_labels(labels, lo + i, lo + j)
        yield _edges(ids, labels)

    return _groups(forest, buffer, 3)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, chunk: int = 512, exact_chunk: int = 1024, exact_load: int = 1 << 20) -> DataFrame:
    """``id, set, component_id`` per row of docs: a digest of its set of shingles, and the smallest id reachable by links.

    Texts link when their sets have a Jaccard similarity of ``similarity`` or more; texts of fewer than ``width`` words have
    one shingle, texts without a word (null, empty, blank) the empty set, and equal sets always link. A null id is never the
    smallest unless all are null; repeated rows each get a row; an empty table gives an empty one. Sets that are compared
    exactly meet in groups of up to 2 * exact_chunk sets and about 2 * exact_load shingles.
    """
    n = docs.count()
    bands, bits, radius = bands_for(n, similarity)
    told = cut(signatures(docs, bands, bits, id_col, text_col, width), "signatures")
    reps = told.groupBy("set").agg(F.min("id").alias("low"), *[F.first(c).alias(c) for c in ("f0", "f1", "keys")])  # equal sets have equal ones
    reps = cut(reps, "sets")
    rows = reps.where("set <> 0").select("set", "f0", "f1", F.posexplode("keys").alias("band", "key"))
    near = _dealt(rows, ["band", "key"], "set", chunk).select("band", "key", "c", "d", "set", "f0", "f1").mapInArrow(_near(radius), "a long, b long")
    close = cut(components(near).select(F.col("vertex").alias("set"), "root"), "candidates", n)
    want = reps.select("set", "low").join(close, "set").select(F.col("set").alias("want"), "low", "root").hint("merge")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(want, F.col("id").eqNullSafe(F.col("low"))).select("root", "want", "text")

    def sets(batches):
        for b in batches:
            for lo, hi in _runs(b.column(2)):
                doc, h = textvec.shingles(b.column(2).slice(lo, hi - lo), width)
                at = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)), pa.int32())
                lists = pa.ListArray.from_arrays(at, pa.array(h.view(np.int64)))
                out = pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), lists], ["root", "set", "h"])
                yield out.filter(pa.array(_set_digests(doc, h, hi - lo) == out.column(1).to_numpy()))  # another text of the same id

    held = texts.mapInArrow(sets, "root long, set long, h array<long>").groupBy("root", "set").agg(F.first("h").alias("h"))
    held = cut(held, "shingles")
    pairs = _dealt(held, ["root"], "set", exact_chunk, F.size("h"), exact_load).select("root", "c", "d", "set", "h").mapInArrow(_alike(similarity), "a long, b long")
    comp = components(pairs).withColumnRenamed("vertex", "set")
    root = cut(reps.select("set", "low").join(comp, "set", "left").select("set", "low", F.coalesce("root", "set").alias("root")), "rooted", n)
    low = cut(root.groupBy("root").agg(F.min("low").alias("component_id")), "lowest", n)
    member = cut(root.select("set", "root").join(low, "root").select("set", "component_id"), "members", n)
    return told.select("id", "set").join(member, "set").select("id", "set", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, **how) -> DataFrame:
    """The rows of docs whose id is the smallest of its component, with all their columns.

    The ids that go are joined away, in one shuffle of the rows. Only rows that share their id with another row, or have none, are looked at one by
    one: of those of one id and one set of shingles the least row stays.
    """
    told = cut(similar(docs, id_col, text_col, width, similarity, **how), "similar")
    id_name, set_name = fresh(docs, "id"), fresh(docs, "set")
    gone = told.where("NOT id <=> component_id").select("id")  # shuffled at every size: cost grows in proportion
    again = cut(told.groupBy("id").count().where("count > 1 OR id IS NULL").select(F.col("id").alias(id_name)), "repeated")
    if again.isEmpty():
        return docs.join(gone.select(F.col("id").alias(id_name)).hint("merge"), F.col(id_col) == F.col(id_name), "left_anti")
    same = F.col(id_col).eqNullSafe(F.col(id_name))
    once = docs.join(again, same, "left_anti").join(gone.select(F.col("id").alias(id_name)).hint("merge"), F.col(id_col) == F.col(id_name), "left_anti")
    rows = docs.join(again, same, "left_semi")
    at = docs.columns.index(text_col)

    def digests(batches):
        for b in batches:
            for lo, hi in _runs(b.column(at)):
                part = b.slice(lo, hi - lo)
                doc, h = textvec.shingles(part.column(at).cast(pa.string()), width)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_set_digests(doc, h, hi - lo))], [*b.schema.names, set_name])

    rows = rows.mapInArrow(digests, StructType([*docs.schema.fields, StructField(set_name, LongType())]))
    stay = told.where("id <=> component_id").select(F.col("id").alias(id_name), F.col("set").alias(fresh(rows, "set"))).distinct()
    rows = rows.join(stay, same & (F.col(set_name) == F.col(stay.columns[1])), "left_semi")
    order = [c for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    least = rows.groupBy(F.col(id_col).alias("i"), F.col(set_name).alias("s")).agg(F.min_by(F.struct(*docs.columns), F.struct(*order)).alias("r"))
    return once.unionByName(least.select("r.*"))
