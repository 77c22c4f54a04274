"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its score into grades:
P(grade > j) = logistic(score - threshold_j). Fitted by gradient steps on a bounded sample of each grade (a few seconds on
the driver, whatever the corpus holds), it gives a document's expected grade and the probability of the highest grades, by which documents are selected.
Features are the characters' n-grams as written (case and marks count), words that repeat the one before, and
the text's length class, hashed into ``DIMS`` buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, textvec

DIMS = 1 << 13
_RUN_DOCS, _RUN_BYTES = 256, 1 << 20


def _runs(texts: pa.Array):
    for lo, hi in bpe.runs(texts, _RUN_BYTES):
        yield from ((a, min(a + _RUN_DOCS, hi)) for a in range(lo, hi, _RUN_DOCS))


def features(texts: pa.Array) -> np.ndarray:
    """Unit rows of DIMS hashed features per text (null: empty)."""
    words = [(t or "").split() for t in texts.to_pylist()]
    parts = [(t or "").encode("utf-32-le", "replace") for t in texts.to_pylist()]
    n = len(parts)
    size = np.array([len(p) // 4 for p in parts], np.int64)
    p, doc = np.frombuffer(b"".join(parts), np.uint32).astype(np.uint64), np.repeat(np.arange(n), size)
    h, cells = np.zeros(len(p), np.uint64), []
    for k in range(3):
        m = max(len(p) - k, 0)
        h = (h[:m] + p[k : k + m] + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        cells.append((doc[:m] * DIMS + (textvec.mixed(h) >> np.uint64(51)).astype(np.int64))[doc[:m] == doc[k : k + m]])
    x = np.log1p(np.bincount(np.concatenate(cells), minlength=n * DIMS).reshape(n, DIMS))
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    # two dense signals in buckets of their own: share of words that repeat, and length
    x[:, 0] = [sum(a == b for a, b in zip(w, w[1:], strict=False)) / max(1, len(w)) for w in words]
    x[:, 1] = [np.log1p(len(w)) / 10 for w in words]
    return x.astype(np.float32)


class Model:
    """weights: one per bucket; thresholds: ascending, one fewer than grades. A text without a word is of the lowest grade."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float64), thresholds

    def above(self, texts: pa.Array) -> np.ndarray:
        """P(grade > j) per text and threshold."""
        x = features(texts)
        score = x.astype(np.float64) @ self.weights
        return np.where(x[:, 1:2] > 0, 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40))), 0.0)  # no word: the lowest grade


def fit_ordinal(rows: list[np.ndarray], cols: list[np.ndarray], grade: np.ndarray, grades: int, rounds: int = 200, ridge: float = 5e-5, rate: float = 0.3) -> Model:
    """Maximum likelihood with a ridge by Adam steps. rows, cols: sparse rows as bucket numbers and values.

    Thresholds are kept ordered as a first one plus positive gaps (their logarithms are free).
    """
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    val = np.concatenate(cols).astype(np.float64) if cols else np.zeros(0)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    theta = np.concatenate([np.zeros(DIMS), [-1.0], np.zeros(max(0, grades - 2))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        _, g = loss(theta, doc, at, val, grade, grades, ridge)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(theta[:DIMS], theta[DIMS] + np.concatenate([[0.0], np.cumsum(np.exp(theta[DIMS + 1 :]))]))


def loss(theta: np.ndarray, doc: np.ndarray, at: np.ndarray, val: np.ndarray, grade: np.ndarray, grades: int, ridge: float) -> tuple[float, np.ndarray]:
    """Negative log likelihood with ridge, every grade of the same weight, and its gradient.

    theta: DIMS weights, the first threshold, logarithms of the gaps to the next ones. doc, at, val: sparse rows in order.
    """
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    weight = 1 / np.maximum(np.bincount(grade, minlength=grades), 1)[grade] / grades
    w, gaps = theta[:DIMS], np.exp(theta[DIMS + 1 :])
    cuts = theta[DIMS] + np.concatenate([[0.0], np.cumsum(gaps)])
    score = np.bincount(doc, val * w[at], len(grade))
    edge = np.concatenate([[-np.inf], cuts, [np.inf]])
    lo, hi = logistic(edge[grade + 1] - score), logistic(edge[grade] - score)
    lo[grade == grades - 1], hi[grade == 0] = 1.0, 0.0
    p = np.maximum(lo - hi, 1e-12)
    dlo, dhi = lo * (1 - lo) / p * weight, hi * (1 - hi) / p * weight
    g_score = dlo - dhi
    g_cut = np.bincount(grade, -dlo, grades + 1)[: grades - 1] + np.bincount(grade, dhi, grades + 1)[1:grades]
    g = np.concatenate([np.bincount(at, val * g_score[doc], DIMS) + ridge * w, [g_cut.sum()], np.cumsum(g_cut[::-1])[::-1][1:] * gaps])
    return float(-(weight * np.log(p)).sum() + ridge * (w @ w) / 2), g


def fit(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade", examples: int = 1500) -> Model:
    """Fit on the ``examples`` rated documents of each grade 0 .. grades - 1 with the smallest hash of their id.

    ratings: id and grade; null and other grades, null ids, ids that are rated in two ways, and ids without a document are
    left out; of rows of docs that share an id the text with the smallest hash counts, once. Features are made in
    tasks; at most grades * examples sparse rows reach the driver. Without ratings every grade is as likely.
    """
    ids = docs.select(F.col(id_col).alias("id"))
    known = ratings.where(F.col(grade_col).between(0, grades - 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast(ids.schema[0].dataType).alias("id"), F.col(grade_col).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").select("id", "y").join(ids, "id", "left_semi")
    picked = None
    for y in range(grades):
        some = known.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(examples)
        picked = some if picked is None else picked.unionByName(some)
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(picked), "id").select("y", F.col("id").cast("string").alias("id"), "text", F.xxhash64("text").alias("h"))

    def sparse(batches):
        for b in batches:
            for lo, hi in _runs(b.column(2)):
                x = features(b.column(2).slice(lo, hi - lo))
                at = [np.flatnonzero(r) for r in x]
                lists = [pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), pa.array([r[a] for r, a in zip(x, at, strict=True)], pa.list_(pa.float32()))]
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), *lists], ["y", "id", "h", "at", "val"])

    made = chosen.mapInArrow(sparse, "y int, id string, h long, at array<int>, val array<float>")
    found = made.groupBy("y", "id").agg(F.min(F.struct("h", "at", "val")).alias("c")).select("y", "id", "c.at", "c.val").toArrow().sort_by([("y", "ascending"), ("id", "ascending")])
    at, val = (found.column(c).to_pylist() for c in ("at", "val"))
    return fit_ordinal([np.array(a, np.int64) for a in at], [np.array(v, np.float32) for v in val], found.column("y").to_numpy().astype(np.int64), grades)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", tail: int | None = None) -> DataFrame:
    """Id, ``expected_grade`` and ``tail_probability`` (of grade ``tail`` or more; by default the highest) per row of docs.

    Texts without a word (null, empty or blank) have nothing to be rated by and get the lowest grade, 0, with a tail probability of 0.
    Rows repeat as given; an empty table gives none; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # DIMS weights
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        m = shipped.value
        j = (len(m.thresholds) if tail is None else tail) - 1
        for b in batches:
            for lo, hi in _runs(b.column(1)):
                p = m.above(b.column(1).slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(p.sum(1)), pa.array(p[:, j])], ["id", "expected_grade", "tail_probability"])

    return kept.mapInArrow(run, f"id {dict(kept.dtypes)['id']}, expected_grade double, tail_probability double").withColumnRenamed("id", id_col)
