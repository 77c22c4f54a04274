"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Learning takes a bounded sample of labelled documents of each label (``examples``, those with the smallest hash of
their id). Every term of the examples is kept: a term is a whole word. The cosine is that of the whole texts: words that no
example holds count in a text's length. A term weighs (1 + log tf) * idf * relevance, where idf counts the examples that hold it and relevance (the
relevance frequency of text categorisation) rises with how much oftener examples of label 1 hold it than others do; it
is 1 for a term that tells nothing.

The examples form an inverted index in blocks of ``BLOCK``. Terms of few examples have their postings added up at once.
For terms of many examples the largest weight in each block is stored: the sum of these bounds and of the best sum so
far in the block bounds every cosine in it. A document's two most promising blocks are scored first, then those whose
bound reaches its k-th best cosine by then, and no others; so the k neighbours are exact. Neighbours vote with a weight that falls
with their distance; a logistic curve fitted on the examples' own leave-one-out votes turns the vote into a calibrated
score. The neighbours' ids and cosines are returned as evidence. The index is some MB, bounded by the sample.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe, textvec

BLOCK = 64
#: Terms of more examples than this are scored by block products instead of postings; either gives the same cosine.
FREQUENT = 256
_RUN_DOCS, _RUN_BYTES = 256, 1 << 20


def _runs(texts: pa.Array):
    for lo, hi in bpe.runs(texts, _RUN_BYTES):
        yield from ((a, min(a + _RUN_DOCS, hi)) for a in range(lo, hi, _RUN_DOCS))


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, term hash) of the texts in order, and how often each occurs."""
    return textvec.counted(*textvec.word_features(*textvec.lowered(texts)))


def term_weight(a: np.ndarray, df: np.ndarray, n: int, toxic: float) -> np.ndarray:
    """idf times relevance of terms that df of n examples hold, a of the ``toxic`` ones of label 1 among them.

    Two examples of label 1 that hold a term may do so by chance: relevance counts those beyond two.
    """
    odds = np.maximum(toxic, 1) / np.maximum(n - toxic, 1)
    relevance = np.log2(2 + np.maximum(a - 2, 0) / odds / np.maximum(df - a, 1))
    return (np.log((1 + n) / (1 + df)) + 1) * relevance**1.5


class Index:
    """Block-max inverted index over unit vectors of the examples; rows are examples in the order of their blocks."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, labels: np.ndarray):
        self.n = len(labels)
        self.names, at, self.df = np.unique(term, return_inverse=True, return_counts=True)
        self.toxic, self.labels = np.bincount(at, labels[doc], len(self.names)), labels
        self.idf = term_weight(self.toxic, self.df, self.n, labels.sum())
        self.unseen = float(term_weight(np.zeros(1), np.zeros(1), self.n, labels.sum())[0])
        doc, at, w = self.weigh(doc, term, tf, self.n)
        # examples whose heaviest term is the same share a block, which keeps bounds tight
        main = np.full(self.n, len(self.names))
        order = np.lexsort((w, doc))
        main[doc[order]] = at[order]  # the last one written is the heaviest
        self.order = np.lexsort((np.arange(self.n), main))
        self.row = np.empty(self.n, np.int64)
        self.row[self.order] = np.arange(self.n)
        doc = self.row[doc]
        df = np.bincount(at, minlength=len(self.names))
        self.column = np.full(len(self.names), -1)
        self.column[df > FREQUENT] = np.arange(int((df > FREQUENT).sum()))
        often = self.column[at] >= 0
        self.blocks = -(-self.n // BLOCK)
        self.dense = np.zeros((int((df > FREQUENT).sum()), self.blocks * BLOCK))
        self.dense[self.column[at[often]], doc[often]] = w[often]
        self.bound = self.dense.reshape(len(self.dense), self.blocks, BLOCK).max(2) if self.n else np.zeros((0, 0))
        order = np.lexsort((doc[~often], at[~often]))
        self.doc, self.weight = doc[~often][order], w[~often][order]
        self.first = np.searchsorted(at[~often][order], np.arange(len(self.names) + 1))

    def weigh(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n: int, examples: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unit vectors of n documents: (document, place of the term, weight) of the terms that the index has.

        Terms that no example holds count in a document's length, with the idf of none: they meet nothing, but take their share.
        examples: the documents are the index's own, in order, each to be held against the others: a term weighs what it would
        without this document's own count and label.
        """
        at = np.minimum(np.searchsorted(self.names, term), max(len(self.names) - 1, 0))
        hit = self.names[at] == term if len(self.names) else np.zeros(len(term), bool)
        w = np.full(len(term), self.unseen)
        met = ones = np.ones(int(hit.sum()))
        if len(ones):
            here = at[hit]
            w[hit] = self.idf[here]
            if examples:
                y = self.labels[doc[hit]]
                w[hit] = term_weight(self.toxic[here] - y, self.df[here] - 1, self.n - 1, self.labels.sum() - y)
                met = w[hit] / self.idf[here]  # the other side's weights hold this document's count too
        w *= 1 + np.log(tf)
        w /= np.maximum(np.sqrt(np.bincount(doc, w * w, n)), 1e-300)[doc]
        return doc[hit], at[hit], w[hit] * met

    def nearest(self, doc: np.ndarray, at: np.ndarray, weight: np.ndarray, n: int, k: int, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Per document the k examples of largest cosine (n by k: their numbers, and cosines; 0 where none is left).

        Ties go to the example of the smaller row. leave: an example for each document that is left out.
        """
        if not self.n:
            return np.zeros((n, 0), np.int64), np.zeros((n, 0))
        k = min(k, self.n)
        often = self.column[at] >= 0
        rare_doc, rare_at, rare_w = doc[~often], at[~often], weight[~often]
        many = self.first[rare_at + 1] - self.first[rare_at]
        post = np.repeat(self.first[rare_at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        width = self.blocks * BLOCK
        sums = np.bincount(np.repeat(rare_doc, many) * width + self.doc[post], self.weight[post] * np.repeat(rare_w, many), n * width).astype(np.float64).reshape(n, width)
        if leave is not None:
            sums[np.arange(n), leave] = -np.inf
        sums[:, self.n :] = -np.inf
        query = np.zeros((n, len(self.dense)))
        query[doc[often], self.column[at[often]]] = weight[often]
        bounds = sums.reshape(n, self.blocks, BLOCK).max(2) + query @ self.bound
        score = np.full((n, width), -np.inf)

        def fill(want: np.ndarray) -> None:
            for b in np.flatnonzero(want.any(0)):
                q, rows = np.flatnonzero(want[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                score[q, rows] = sums[q, rows] + query[q] @ self.dense[:, rows]

        best = np.zeros((n, self.blocks), bool)
        np.put_along_axis(best, np.argsort(-bounds, axis=1)[:, :2], True, 1)
        fill(best)
        fill((bounds >= -np.partition(-score, k - 1, axis=1)[:, k - 1 : k] - 1e-12) & ~best)  # blocks that may hold one of the k
        least = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
        of, row = np.nonzero((score >= least) & (score > 0))
        value = score[of, row]
        order = np.lexsort((row, -value, of))
        of, row, value = of[order], row[order], value[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        top = place < k
        found, cosine = np.zeros((n, k), np.int64), np.zeros((n, k))
        found[of[top], place[top]], cosine[of[top], place[top]] = self.order[row[top]], np.minimum(value[top], 1)
        return found, cosine


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a ridge-held logistic curve by Newton steps."""
    theta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(theta @ design, -30, 30)))
        grad = design @ (w * (p - y)) + np.array([0.01, 0.001]) * theta * w.sum() * 0.01
        hess = (design * (w * p * (1 - p))) @ design.T + np.diag([0.01, 0.001]) * w.sum() * 0.01
        theta -= np.linalg.solve(hess, grad)
    return float(theta[0]), float(theta[1])


class Scorer:
    """Index, vote and calibration. doc, term, tf: the counted terms of the examples, whose labels and ids follow."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, labels: np.ndarray, ids: pa.Array, share: float, k: int = 10):
        self.k, self.prior, self.ids, self.labels = k, share, ids, labels.astype(np.float64)
        self.index = Index(doc, term, tf, self.labels)
        self.slope = self.intercept = 0.0
        n = len(labels)
        if 0 < labels.sum() < n:
            votes = []
            doc, at, w = self.index.weigh(doc, term, tf, n, examples=True)
            begin = np.searchsorted(doc, np.arange(n + 1))
            for lo in range(0, n, _RUN_DOCS):
                hi = min(lo + _RUN_DOCS, n)
                part = slice(begin[lo], begin[hi])
                votes.append(self.vote(*self.index.nearest(doc[part] - lo, at[part], w[part], hi - lo, k, self.index.row[lo:hi])))
            weight = np.where(self.labels == 1, share / self.labels.mean(), (1 - share) / (1 - self.labels.mean()))
            self.slope, self.intercept = logistic(np.concatenate(votes), self.labels, weight)

    def vote(self, found: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours of each document, weighted by the squares of their cosines.

        The overall share has the weight of a cosine of 0.01, so it decides where no example has a term in common.
        """
        w = cosine**2
        return ((w * self.labels[found]).sum(1) + 1e-4 * self.prior) / (w.sum(1) + 1e-4)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, neighbours (numbers of examples, best first) and cosines of each text."""
        n = len(texts)
        found, cosine = self.index.nearest(*self.index.weigh(*terms(texts), n), n, self.k)
        z = self.slope * self.vote(found, cosine) + self.intercept
        return (1 / (1 + np.exp(-np.clip(z, -30, 30))) if self.slope else np.full(n, self.prior)), found, cosine


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", examples: int = 1500) -> Scorer:
    """Fit on the ``examples`` labelled documents of each label (0 and 1) with the smallest hash of their id.

    labels: id and label. Rows with another or null label or a null id, ids that are labelled both ways, and ids without
    a document are left out; of rows of docs that share an id the text with the smallest hash counts, once. Only ids are
    shuffled to pick the examples; the texts of at most 2 * examples ids are then found by a broadcast of these, counted
    in tasks, and only their distinct terms with counts reach the driver. The share of label 1 is counted over all labels.
    """
    ids = docs.select(F.col(id_col).alias("id"))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast(ids.schema[0].dataType).alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most").select("id", "y").join(ids, "id", "left_semi")
    n = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(examples) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chosen = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "id").withColumn("h", F.xxhash64("text"))

    def count(batches):
        for b in batches:
            for lo, hi in _runs(b.column(3)):
                part = b.slice(lo, hi - lo)
                doc, term, tf = terms(part.column(3))
                at = pa.array(np.searchsorted(doc, np.arange(hi - lo + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (term.view(np.int64), tf)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *lists], ["id", "y", "h", "term", "tf"])

    kind = ids.schema[0].dataType.simpleString()
    counted = chosen.select("id", "y", "h", "text").mapInArrow(count, f"id {kind}, y int, h long, term array<long>, tf array<long>")
    one = counted.groupBy("id", "y").agg(F.min(F.struct("h", "term", "tf")).alias("c")).select("id", "y", "c.term", "c.tf")
    found = one.toArrow().sort_by([("y", "ascending"), ("id", "ascending")]).combine_chunks()  # at most 2 * examples rows
    term, tf = (found.column(c).combine_chunks() if found.num_rows else pa.array([], pa.list_(pa.int64())) for c in ("term", "tf"))
    size = term.value_lengths().to_numpy(zero_copy_only=False) if len(term) else np.zeros(0, np.int64)
    ids = found.column("id").combine_chunks()
    return Scorer(np.repeat(np.arange(found.num_rows), size), term.flatten().to_numpy().view(np.uint64), tf.flatten().to_numpy(), found.column("y").to_numpy(), ids, n.get(1, 0) / max(1, sum(n.values())))


def score(docs: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text", evidence: int = 3) -> DataFrame:
    """Id, ``score, neighbours`` (ids of the nearest examples, best first) and their ``cosines`` per row of docs.

    Null and empty texts, and others without a term of any example, have no neighbours; the share of label 1 stands for
    their vote. Without examples of both labels every score is the share of label 1. Ids may be of any type, rows repeat
    as given, and other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # some MB, bounded by the sample
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        m = shipped.value
        for b in batches:
            for lo, hi in _runs(b.column(1)):
                scores, found, cosine = m.score(b.column(1).slice(lo, hi - lo))
                found, cosine = found[:, :evidence], cosine[:, :evidence]
                near = cosine > 0
                at = pa.array(np.append(0, np.cumsum(near.sum(1))), pa.int32())
                ids = m.ids.take(pa.array(found[near])).cast(b.schema.field(0).type)
                lists = [pa.ListArray.from_arrays(at, x) for x in (ids, pa.array(cosine[near]))]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(scores), *lists], ["id", "score", "neighbours", "cosines"])

    kind = kept.schema[0].dataType.simpleString()
    made = kept.mapInArrow(run, f"id {kind}, score double, neighbours array<{kind}>, cosines array<double>")
    return made.withColumnRenamed("id", id_col)


def keep(docs: DataFrame, model: Scorer, text_col: str = "text", cutoff: float = 0.7) -> DataFrame:
    """The rows of docs that score below cutoff, with all their columns, in one pass without a shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shipped.value
        for b in batches:
            for lo, hi in _runs(b.column(at)):
                part = b.slice(lo, hi - lo)
                yield part.filter(pa.array(m.score(part.column(at))[0] < cutoff))

    return docs.mapInArrow(run, docs.schema)
