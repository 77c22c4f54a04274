"""Byte-level BPE encoding and decoding in Arrow batches.

Texts are cut into bounded runs of documents. Pre-token boundaries come from ``pretokens`` and are used
as the offsets of an Arrow string array over the very same bytes, so slicing copies nothing. Distinct
slices are found by Arrow's hash, looked up in a bounded cache, and only new ones are merged, all at
once, in rounds of array operations. Ids are gathered back by slice; the slices' byte offsets are kept
for decoding.
"""

from __future__ import annotations

import base64
import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens

#: Bytes of text that are encoded at a time, and distinct slices that a worker remembers.
RUN_BYTES, CACHE_SLICES = 2 << 20, 250_000
NEVER = 1 << 30  # the rank of a pair that does not merge


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file's lines (base64 token, blank, rank)."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}


@lru_cache(1)
def _classes() -> np.ndarray:
    """Classes as the tokenizer's own regular expressions see them, asked once in each worker."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    octets = {bytes([i]): i for i in range(256)}

    def members(pattern: str) -> np.ndarray:
        found = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=octets, special_tokens={}).encode_ordinary(every)
        return np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)

    return pretokens.class_table(members)


@dataclass
class Encoded:
    """ids: flat int32; docs: first id of each document and the end. Slices: first byte, codepoint and id of
    each, and the ends; doc_slices: first slice of each document and the end.
    """

    ids: np.ndarray
    docs: np.ndarray
    slice_bytes: np.ndarray
    slice_points: np.ndarray
    slice_ids: np.ndarray
    doc_slices: np.ndarray


class Codec:
    """Encoder and decoder for one rank table; keeps the merged ids of slices it has seen."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        if size > 1 << 20:
            raise ValueError("ranks of up to 2**20 tokens")
        tokens = [b""] * size
        for t, r in ranks.items():
            tokens[r] = t
        self.tokens = tokens
        self.octet = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[t[:k]] << 20 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self._fill(np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int32))
        octets = np.repeat(self.octet, 256), np.tile(self.octet, 256)
        self.octet_pairs = self._ranks_of(*octets)
        self.token_bytes = pa.array(tokens, pa.large_binary())
        self.token_text = pa.array([b"%d " % i for i in range(size)], pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.flat, self.at, self.many = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """An open-addressing table of pairs, at most half full, built and searched in array operations."""
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slot_key, self.slot_rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NEVER, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.slot_key[slot[todo]] < 0
            self.slot_key[slot[todo[free]]] = keys[todo[free]]
            got = self.slot_key[slot[todo]] == keys[todo]
            self.slot_rank[slot[todo[got]]] = ranks[todo[got]]
            todo = todo[~got]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 20 | right
        slot = self._slot(key)
        found = self.slot_key[slot]
        out = np.where(found == key, self.slot_rank[slot], np.int32(NEVER))
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.slot_key[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_rank[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def merge(self, slices: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each slice (flat, and how many): every round merges the lowest-ranked pair of every slice.

        Equal pairs of a slice merge left to right in one round, as one after another they would. Only
        pairs beside a merge are looked up again.
        """
        offsets = np.frombuffer(slices.buffers()[1], np.int64)[slices.offset : slices.offset + len(slices) + 1]
        data = np.frombuffer(slices.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        ids, owner = self.octet[data], np.repeat(np.arange(len(slices), dtype=np.int32), np.diff(offsets))
        rank = np.full(len(ids), NEVER, np.int32)
        rank[:-1] = np.where(owner[1:] == owner[:-1], self.octet_pairs[data[:-1].astype(np.int32) << 8 | data[1:]], np.int32(NEVER))
        done_ids, done_owner = [], []
        while len(ids):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(first, len(ids)))
            low = np.minimum.reduceat(rank, first)
            if (low == NEVER).any():
                live = np.repeat(low != NEVER, size)
                done_ids.append(ids[~live])
                done_owner.append(owner[~live])
                ids, owner, rank = ids[live], owner[live], rank[live]
                size, low = size[low != NEVER], low[low != NEVER]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            # in a run of overlapping hits (aaa), every other one from the left merges
            begins = np.flatnonzero(np.append(True, np.diff(at) > 1))
            at = at[(np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))) % 2 == 0]
            ids[at] = rank[at]
            rank[at] = rank[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # where the merged ones stand once their right halves are gone
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            beside = np.concatenate([at, at[at > 0] - 1])
            beside = beside[beside + 1 < len(ids)]
            beside = beside[owner[beside] == owner[beside + 1]]
            rank[beside] = self._ranks_of(ids[beside], ids[beside + 1])
            # a merged id that now ends its slice keeps the NEVER it took over
        ids, owner = np.concatenate([*done_ids, ids]), np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.int32), np.bincount(owner, minlength=len(slices))

    def _lookup(self, distinct: pa.Array) -> np.ndarray:
        """Row of the cache for each distinct slice; merges those it lacks."""
        if len(self.seen) + len(distinct) > CACHE_SLICES:
            self._forget()
        keys = distinct.to_pylist()
        row = np.array([self.seen.get(k, -1) for k in keys], np.int64)
        if (new := np.flatnonzero(row < 0)).size:
            flat, many = self.merge(distinct.take(pa.array(new)))
            base = len(self.at)
            self.seen.update((keys[k], base + i) for i, k in enumerate(new.tolist()))
            row[new] = base + np.arange(len(new))
            self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(many) - many])
            self.many = np.concatenate([self.many, many])
            self.flat = np.concatenate([self.flat, flat])
        return row

    def encode(self, texts: pa.Array, most: int | None = None) -> Encoded:
        """Encode each text (null: empty) of a string array.

        A text of more than ``most`` bytes (by default twice RUN_BYTES) goes in pieces that end where a match ends whatever comes next,
        so what is kept per character is small however long it is.
        """
        most = 2 * RUN_BYTES if most is None else most
        plain = texts.cast(pa.large_binary()).fill_null(b"")
        sizes = np.diff(np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]) if len(plain) else np.zeros(0, np.int64)
        if not (sizes > most).any():
            return self._encode(plain)
        coded, of = [], [0]  # pieces, and where those of each text end
        for k in range(len(plain)):
            coded += self.pieces(plain[k], most)
            of.append(len(coded))
        whole = lambda name, base: np.concatenate([getattr(e, name)[:-1] + at for e, at in zip(coded, base[:-1], strict=True)] + [[base[-1]]])
        total = lambda name: np.append(0, np.cumsum([getattr(e, name)[-1] for e in coded]))
        slices = np.append(0, np.cumsum([e.doc_slices[-1] for e in coded]))
        ids, octets, points = total("docs"), total("slice_bytes"), total("slice_points")
        return Encoded(np.concatenate([e.ids for e in coded]), ids[of], whole("slice_bytes", octets), whole("slice_points", points), whole("slice_ids", ids), slices[of])

    def pieces(self, text: pa.Scalar, most: int):
        """Encoded pieces of one binary text, in order; each is of one text, and has what the whole would have there."""
        raw = np.frombuffer(text.as_buffer(), np.uint8)
        at = 0
        for end in [*safe_ends(raw, most), len(raw)]:
            yield self._encode(pa.array([memoryview(text.as_buffer())[at:end]], pa.large_binary()))
            at = end

    def _encode(self, plain: pa.Array) -> Encoded:
        """Encode binary texts without nulls in one piece."""
        offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
        data = (plain.buffers()[2] or pa.py_buffer(b""))[int(offsets[0]) : int(offsets[-1])].to_pybytes()
        offsets = offsets - offsets[0]
        raw = np.frombuffer(data, np.uint8)
        points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        byte_at = np.flatnonzero((raw & 0xC0) != 0x80) if len(points) != len(raw) else np.arange(len(raw))
        if len(byte_at) != len(points):
            raise ValueError("texts must be valid UTF-8")
        begins = offsets[:-1][offsets[1:] > offsets[:-1]]
        point = pretokens.boundaries(points, np.searchsorted(byte_at, begins), _classes())
        cut = byte_at[point]
        slices = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(np.append(cut, len(raw)).astype(np.int64)), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        row = self._lookup(coded.dictionary)[coded.indices.to_numpy()]
        many = self.many[row]
        end = np.cumsum(many)
        total = int(end[-1]) if len(end) else 0
        ids = self.flat[np.repeat(self.at[row] - (end - many), many) + np.arange(total)]
        slice_ids = np.append(0, end)
        doc_slices = np.searchsorted(cut, offsets)
        return Encoded(ids, slice_ids[doc_slices], np.append(cut, len(raw)), np.append(point, len(points)), slice_ids, doc_slices)

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of the ids one after another, and where each id's bytes begin."""
        return _joined(self.token_bytes, ids)

    def texts(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Decimal ids, each followed by one blank, and where each begins."""
        return _joined(self.token_text, ids)


def _joined(table: pa.Array, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    got = table.take(pa.array(ids))
    at = np.frombuffer(got.buffers()[1], np.int64)[: len(got) + 1] if len(got) else np.zeros(1, np.int64)
    return memoryview(got.buffers()[2] or b""), at


def safe_ends(raw: np.ndarray, most: int):
    """Where to part a long text: before a single blank between two visible characters of ASCII, about every ``most`` bytes.

    There a match ends and the next one begins, and what follows does not change the matches before, nor the other way round. Where
    there is no such blank (a script without blanks, one endless word) the piece goes on to the next one.
    """
    at = 0
    while len(raw) - at > most:
        lo = at + 1
        found = None
        while found is None and lo < len(raw) - 1:
            hi = min(lo + most, len(raw) - 1)
            here = np.flatnonzero((raw[lo:hi] == 32) & (raw[lo - 1 : hi - 1] > 32) & (raw[lo - 1 : hi - 1] < 127) & (raw[lo + 1 : hi + 1] > 32) & (raw[lo + 1 : hi + 1] < 127))
            if len(here):
                found = lo + int(here[-1] if lo == at + 1 else here[0])
            lo = hi
        if found is None:
            return
        yield found
        at = found


_codecs: dict[str, Codec] = {}


def codec_of(raw: bytes) -> Codec:
    """This worker's codec for a rank file's contents."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(parse_ranks(raw))
    return _codecs[key]


def runs(texts: pa.Array, most: int = RUN_BYTES):
    """Bounds of runs of rows with at most ``most`` bytes of text; a longer text is a run of its own."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
        yield at, end
        at = end


def shipped(spark, path: str):
    """A vocabulary file's bytes (some MB, fixed) as a broadcast: executors need not have the file."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, slice_bytes array<long>, slice_ids array<int>`` for each row of docs.

    slice_bytes holds the first byte of each pre-token and the text's length, slice_ids the number of ids
    before each: any span of ids maps back to bytes and the other way. Null texts encode as empty;
    repeated rows and null ids are kept as they are; other columns are not read.
    """
    raw = shipped(docs.sparkSession, ranks_path)
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = codec_of(raw.value)
        for b in batches:
            for lo, hi in runs(b.column(1)):
                part = b.column(1).slice(lo, hi - lo)
                e = codec.encode(part)
                s = e.doc_slices
                rows = [(e.ids[e.docs[k] : e.docs[k + 1]], e.slice_bytes[s[k] : s[k + 1] + 1] - e.slice_bytes[s[k]], e.slice_ids[s[k] : s[k + 1] + 1] - e.docs[k]) for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), *(pa.array([r[c] for r in rows], pa.list_(t)) for c, t in enumerate((pa.int32(), pa.int64(), pa.int32())))],
                    ["id", "ids", "slice_bytes", "slice_ids"],
                )

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, ids array<int>, slice_bytes array<long>, slice_ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, bytes`` for each row: the bytes of its ids (null ids: null)."""
    raw = shipped(encoded.sparkSession, ranks_path)
    kept = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        codec = codec_of(raw.value)
        for b in batches:
            out = [None if x is None else b"".join(codec.tokens[i] for i in x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "bytes"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, bytes binary")


def _digests(codec: Codec, texts: pa.Array) -> list[tuple[int, str, str]]:
    """How many ids each of some texts has, the digest of these as text, and that of the bytes that they decode to."""
    e, sha = codec.encode(texts), hashlib.sha256
    text, text_at = codec.texts(e.ids)
    back, back_at = codec.decode(e.ids)
    t, d = text_at[e.docs].tolist(), back_at[e.docs].tolist()
    return [(n, sha(text[a : max(a, z - 1)]).hexdigest(), sha(back[c:f]).hexdigest()) for n, a, z, c, f in zip(np.diff(e.docs).tolist(), t, t[1:], d, d[1:], strict=False)]


def _one_digest(codec: Codec, text: pa.Scalar) -> tuple[int, str, str]:
    """_digests() of one text of any length, in pieces: neither its ids nor its bytes are held at once."""
    n, ids, back = 0, hashlib.sha256(), hashlib.sha256()
    for e in codec.pieces(text.cast(pa.large_binary()) if text.is_valid else pa.scalar(b"", pa.large_binary()), RUN_BYTES):
        told, _ = codec.texts(e.ids)
        if len(e.ids):
            ids.update(told[:-1] if not n else b" " + bytes(told[:-1]))
        back.update(codec.decode(e.ids)[0])
        n += len(e.ids)
    return n, ids.hexdigest(), back.hexdigest()


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and digest both: ``id_col, n_tokens, ids_sha256, decoded_sha256`` per row of docs.

    One pass without a shuffle; ids and bytes never leave the worker. Null and empty texts have no ids.
    """
    raw = shipped(docs.sparkSession, ranks_path)
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = codec_of(raw.value)
        for b in batches:
            for lo, hi in runs(b.column(1)):
                texts = b.column(1).slice(lo, hi - lo)
                rows = [_one_digest(codec, texts[0])] if hi - lo == 1 else _digests(codec, texts)
                n, ids, back = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    made = kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("id", id_col)
