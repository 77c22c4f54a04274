"""Packing token sequences by shortest-pack-first over the length histogram.

1. Documents are encoded once and cut at multiples of the row length; a piece is ids ``start`` to
   ``start + length``. Pieces are stored, ids are not: 60 bytes a piece.
2. The histogram of piece lengths has at most ``width`` rows whatever the corpus holds. Lengths are placed
   longest first; each goes to the open pattern with the shortest filling that still has room, and the
   counts of patterns are split as needed. All pieces of a length are placed at once.
3. A pattern's slots become ranges of ranks within a length. Each piece gets its rank within its length
   (rank within a hashed share of the length, plus the sizes of the shares before it, so that a length
   which holds a third of all pieces is still ranked by many tasks) and looks its range up.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .scratch import cut, tasks_for


def pack_histogram(counts: dict[int, int], width: int) -> list[tuple[int, list[int]]]:
    """Patterns as (how often, lengths in placing order) for the counts of lengths 1..width.

    Shortest pack first: of the open patterns, the one with the most room takes the next length.
    """
    heap: list[tuple[int, int, int, list[int]]] = []  # (-room, tie, how often, lengths)
    full: list[tuple[int, list[int]]] = []
    tie = 0

    def put(room: int, many: int, lengths: list[int]) -> None:
        nonlocal tie
        if room:
            tie += 1
            heapq.heappush(heap, (-room, tie, many, lengths))
        else:
            full.append((many, lengths))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not heap or -heap[0][0] < length:
                put(width - length, left, [length])
                break
            room, _, many, lengths = heapq.heappop(heap)
            used = min(left, many)
            if used < many:
                put(-room, many - used, lengths)
            put(-room - length, used, [*lengths, length])
            left -= used
    return full + [(many, lengths) for _, _, many, lengths in heap]


def rank_ranges(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Slots of all patterns, sorted by (length, lowest rank): rank range -> first sequence and offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for many, lengths in patterns:
        offset = 0
        for length in lengths:
            low = taken.get(length, 0)
            rows.append((length, low, sequence, offset))
            taken[length] = low + many
            offset += length
        sequence += many
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "low", "sequence", "offset"), cols, strict=True))


def added_tokens(json_path: str) -> dict[str, int]:
    """The tokens that a ``tokenizers`` json adds to its vocabulary and matches in texts, with their ids."""
    with open(json_path, encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in found):
        raise ValueError("added tokens that match whole words or take in blanks are not supported")
    return {t["content"]: t["id"] for t in found}


def ids_of(codec: bpe.Codec, texts: pa.Array, added: dict[str, int]):
    """Ids of each text (null: none): one for each added token in it, the longest where several begin, and ordinary ids between."""
    plain = texts.to_pylist() if added else []
    if not any(t in x for x in plain if x for t in added):
        if len(texts) == 1 and texts[0].is_valid:  # it may be a very long one: of its pieces only the ids are kept
            yield np.concatenate([e.ids for e in codec.pieces(texts[0].cast(pa.large_binary()), bpe.RUN_BYTES)])
            return
        e = codec.encode(texts)
        yield from (e.ids[a:z] for a, z in zip(e.docs[:-1].tolist(), e.docs[1:].tolist(), strict=True))
        return
    mark = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    parts = [mark.split(x or "") for x in plain]  # every second one is an added token
    e = codec.encode(pa.array([s for p in parts for s in p[::2]], pa.large_string()))
    at = 0
    for p in parts:
        out = []
        for k, s in enumerate(p):
            if k % 2:
                out.append(np.array([added[s]], np.int32))
            else:
                out.append(e.ids[e.docs[at] : e.docs[at + 1]])
                at += 1
        yield np.concatenate(out)


def pieces(docs: DataFrame, ranks_path: str, width: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` for each piece of each document's ids plus the end id."""
    raw = bpe.shipped(docs.sparkSession, ranks_path)
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        codec = bpe.codec_of(raw.value)
        for b in batches:
            for lo, hi in bpe.runs(b.column(1)):
                out: list[tuple] = []
                for k, own in enumerate(ids_of(codec, b.column(1).slice(lo, hi - lo), added or {})):
                    ids = np.append(own, end_id).astype("<u4")
                    view, n = memoryview(ids).cast("B"), len(ids)
                    out += [(lo + k, s, min(width, n - s), zlib.crc32(view[4 * s : 4 * min(s + width, n)]), n) for s in range(0, n, width)]
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(cols[0])), *(pa.array(c, pa.int64()) for c in cols[1:])], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(rows: DataFrame, shares: int) -> DataFrame:
    """rows with ``rank``: 0, 1, ... within each length, in an order that the rows' own values fix."""
    share = F.pmod(F.xxhash64("id", "start", "ids_crc32", "length"), F.lit(shares)).cast("int")
    rows = rows.withColumn("share", share)
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("length", "share").agg(F.count("*").alias("n"))
    base = cut(base.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "ranks")
    own = Window.partitionBy("length", "share").orderBy("id", "start", "ids_crc32", "doc_tokens")
    rows = rows.withColumn("own", F.row_number().over(own) - 1)
    return rows.join(base, ["length", "share"]).withColumn("rank", F.col("own") + F.col("base")).drop("own", "base", "share")


def pack(docs: DataFrame, ranks_path: str, width: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """Sequences of at most ``width`` tokens out of all documents' ids, each document closed by ``end_id``.

    One row per piece: id column, ``start, length, ids_crc32, doc_tokens, sequence_id, offset``. Null and empty
    texts give the end id alone. Repeated rows and equal or null ids are packed as documents of their
    own. An empty table gives an empty one. Other columns are not read. added: tokens beyond the ranks, with their
    ids, that are matched in texts.
    """
    spark = docs.sparkSession
    rows = cut(pieces(docs, ranks_path, width, end_id, id_col, text_col, added), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `width` rows
    slots = spark.sparkContext.broadcast(rank_ranges(pack_histogram(counts, width)))  # bounded by the histogram
    placed = ranked(rows, tasks_for(spark, 64))

    def place(batches):
        s = slots.value
        key = s["length"] << 44 | s["low"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, length << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(s["sequence"][at] + rank - s["low"][at]), pa.array(s["offset"][at])], ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = dict(rows.dtypes)["id"]
    out = placed.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(place, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
