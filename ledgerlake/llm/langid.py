"""Language identification by nearest centroid.

A text is a vector of its character n-grams (one to three characters, words apart), hashed into ``DIMS``
buckets, weighed by TF-IDF and normalised. The idf counts every learning document. Each language's
vectors, a bounded sample of them, are clustered into several centroids by spherical k-means, so that a
language may have several kinds of text. A small cluster that another language's centroid would take in, and that lies
nearer to it than to its own language, holds texts with a wrong label and is left out; other small ones stay. A text takes the language of the centroid of largest cosine; one
farther from it than nearly all learning texts are from theirs is marked as rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec

DIMS, UNKNOWN = 4096, "und"
_LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
_RUN_DOCS, _RUN_BYTES = 256, 1 << 20


def _runs(texts: pa.Array):
    """Bounds of runs of rows, few enough for their vectors and texts to stay small."""
    from .bpe import runs

    for lo, hi in runs(texts, _RUN_BYTES):
        yield from ((a, min(a + _RUN_DOCS, hi)) for a in range(lo, hi, _RUN_DOCS))


def grams(texts: pa.Array, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams (rows by DIMS), and whether the text has a letter.

    A text of more than ``most`` characters is counted in pieces that overlap by the two characters that a gram may reach beyond its first;
    grams within an overlap are counted by both pieces and taken off once.
    """
    out = []
    for lo, hi in _runs(texts):
        part = texts.slice(lo, hi - lo)
        text = part[0].as_py() if hi - lo == 1 else None
        if text is None or len(text) <= most:
            out.append(_grams(part))
            continue
        counts, letter = np.zeros((1, DIMS), np.int64), np.zeros(1, bool)
        for at in range(0, len(text), most):
            piece, both = text[at : at + most + 2], text[at + most : at + most + 2]
            more, found = _grams(pa.array([piece, both], pa.large_string()))
            counts, letter = counts + more[:1] - more[1:], letter | found[:1]
        out.append((counts, letter))
    return (np.concatenate([c for c, _ in out]), np.concatenate([x for _, x in out])) if out else _grams(texts)


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    points, at = textvec.lowered(texts)
    n = len(at) - 1
    letter = _LETTER[points]
    doc = np.repeat(np.arange(n), np.diff(at))
    p = np.where(letter, points, 0).astype(np.uint64)
    h, cells = np.zeros(len(p), np.uint64), []
    live = letter.copy()
    for k in range(3):
        m = len(p) - k
        if m <= 0:
            break
        h = (h[:m] + p[k : k + m] + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        if k:
            live = (live[:m] | letter[k : k + m]) & (doc[:m] == doc[k : k + m])
        cells.append((doc[:m] * DIMS + (textvec.mixed(h) >> np.uint64(52)).astype(np.int64))[live])
    flat = np.bincount(np.concatenate(cells) if cells else np.zeros(0, np.int64), minlength=n * DIMS)
    return flat.reshape(n, DIMS), np.bincount(doc[letter], minlength=n) > 0


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids, seeded by the farthest-first rule from the vector nearest to the mean; repeatable."""
    mean = x.mean(0)
    seeds = [int(np.argmax(x @ mean))]
    near = x @ x[seeds[0]]
    for _ in range(min(k, len(x)) - 1):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floor: np.ndarray):
        self.idf, self.langs, self.centroids, self.floor = idf, langs, centroids, floor

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine to its nearest centroid, and whether that is too far, per text."""
        counts, letters = grams(texts)
        if not self.langs:
            return [UNKNOWN] * len(letters), np.zeros(len(letters)), np.ones(len(letters), bool)
        near = vectors(counts, self.idf) @ self.centroids.T
        best = np.argmax(near, 1)
        cosine = np.clip(near[np.arange(len(best)), best].astype(np.float64), 0, 1)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)], np.where(letters, cosine, 0), ~letters | (cosine < self.floor[best])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", per_lang: int = 1000, clusters: int = 4, reject: float = 0.002, stray: float = 0.08) -> Model:
    """Learn from rows with text and language. per_lang: expected number of rows of a language (those of
    the smallest hashes) that its centroids are clustered from; idf counts all rows. reject: share of a
    centroid's own learning texts that its distance bound would reject. stray: clusters of up to this share of their
    language's sample are checked for wrong labels (0: none; the largest cluster always stays). Rows that repeat an
    id with its text count once in the sample.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("h"))

    def tally(batches):
        total, n = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for lo, hi in _runs(b.column(0)):
                total += (grams(b.column(0).slice(lo, hi - lo))[0] > 0).sum(0)
                n += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1), pa.int32()), pa.array(np.append(total, n))], ["bucket", "n"])

    found = rows.select("text").mapInArrow(tally, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # DIMS + 1 rows
    df = np.zeros(DIMS + 1)
    for r in found:
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1
    share = F.broadcast(rows.groupBy("lang").count().select("lang", (F.lit(2.0**32 * per_lang) / F.col("count")).alias("below")))  # one row a language
    sample = rows.join(share, "lang").where(F.pmod("h", F.lit(1 << 32)) < F.col("below")).select("lang", "h", "text")

    def count(batches):  # a sampled text travels as its counts
        for b in batches:
            for lo, hi in _runs(b.column(2)):
                c = grams(b.column(2).slice(lo, hi - lo))[0]
                at, of = np.nonzero(c)[::-1], pa.array(np.append(0, np.cumsum((c > 0).sum(1))), pa.int32())
                lists = [pa.ListArray.from_arrays(of, pa.array(v)) for v in (at[0].astype(np.int32), c[c > 0])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), *lists], ["lang", "h", "bucket", "n"])

    sample = sample.mapInArrow(count, "lang string, h long, bucket array<int>, n array<long>").dropDuplicates(["lang", "h"])

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by("h").combine_chunks()
        bucket, n = (table.column(k).combine_chunks() for k in ("bucket", "n"))
        counts = np.zeros((len(table), DIMS), np.int64)
        counts[np.repeat(np.arange(len(table)), bucket.value_lengths().to_numpy()), bucket.flatten().to_numpy()] = n.flatten().to_numpy()
        x = vectors(counts, idf)
        x = x[x.any(1)] if x.any() else x
        c = spherical_kmeans(x, clusters)
        near = x @ c.T
        own = np.argmax(near, 1)
        share = np.bincount(own, minlength=len(c)) / len(x)
        floor = [float(np.quantile(near[own == j, j], reject)) * 0.9 if (own == j).any() else 0.0 for j in range(len(c))]
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(c)), "centroid": pa.array([v.tolist() for v in c], pa.list_(pa.float32())), "floor": pa.array(floor), "share": pa.array(share)})

    got = sample.groupBy("lang").applyInArrow(cluster, "lang string, centroid array<float>, floor double, share double").collect()  # clusters rows a language
    got = sorted(got, key=lambda r: (r["lang"], r["centroid"]))
    langs, floor, share = ([r[c] for r in got] for c in ("lang", "floor", "share"))
    c = np.array([r["centroid"] for r in got], np.float32).reshape(-1, DIMS)
    stay = sound_clusters(langs, c, np.array(floor), np.array(share), stray)
    return Model(idf, [langs[k] for k in stay], c[stay], np.array(floor)[stay])


def sound_clusters(langs: list[str], c: np.ndarray, floor: np.ndarray, share: np.ndarray, stray: float) -> np.ndarray:
    """Numbers of the clusters that stand for their language."""
    near = c @ c.T
    names = np.array(langs, object)
    out = []
    for k in range(len(c)):
        large = share > stray
        own, other = large & (names == names[k]), large & (names != names[k])
        own[k] = other[k] = False
        wrong = share[k] <= stray and own.any() and other.any() and near[k, other].max() > near[k, own].max() and (near[k] >= floor)[other].any()
        if not wrong:
            out.append(k)
    return np.array(out, np.int64)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``lang_pred, score`` (cosine, 0 to 1) and ``rejected`` per row of docs, in one pass.

    Null texts and texts without a letter get ``und`` and score 0, as all do if nothing was learned.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # DIMS floats for each centroid
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        m = shipped.value
        for b in batches:
            for lo, hi in _runs(b.column(1)):
                lang, score, far = m.predict(b.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(lang, pa.string()), pa.array(score), pa.array(far)], ["id", "lang_pred", "score", "rejected"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)
