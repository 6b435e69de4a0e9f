"""Severity of toxic language by cumulative-link ordinal regression on hashed words.

A document's words, lower-cased, and the beginnings of longer ones (stems, in inflected
languages) are hashed into ``2 ** BITS`` columns, of which those that tell toxic from
clean documents carry two weights: on the damped count, and on the damped rate in the text.  One weight vector serves all ordered thresholds:
``P(grade <= k) = sigmoid(threshold_k - score)``.  The labels mark toxicity only, so the
grades they stand for are 0 for clean, and for toxic 1 or 2 as the share of telling words
lies below or above the median of the toxic documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import BREAK, Texts, pieces, span_hashes
from rankflow.llm.labelled import labelled_sample

#: Labelled documents that the model is fitted on, at most.
FIT_ROWS = 8_000
BITS = 20
#: Bytes of a longer word's beginning that count as a feature of its own.
STEM = 6
GRADES = 3
#: A document is rejected where grade 1 or above has at least this probability.
REJECT_FROM = 0.5


def word_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Text number, column and count of every distinct hashed word, sorted by text."""
    flat = Texts.of(pc.utf8_lower(texts))
    starts, ends, of = flat.spans(BREAK[flat.data])
    long = ends - starts > STEM
    stems = span_hashes(flat.data, starts[long], starts[long] + STEM) * np.uint64(3)
    column = np.concatenate([span_hashes(flat.data, starts, ends), stems]) >> np.uint64(64 - BITS)
    of = np.concatenate([of, of[long]])
    keys, counts = np.unique((of.astype(np.uint64) << np.uint64(BITS)) | column, return_counts=True)
    return (keys >> np.uint64(BITS)).astype(np.int64), (keys & np.uint64(2**BITS - 1)).astype(np.int64), counts, flat.n


def strength(of: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Damped count and damped rate of every feature in its text."""
    rate = count / np.bincount(of, count, n).clip(1)[of]
    return np.stack([np.log2(1 + count), np.log2(1 + 256 * rate)], axis=1)


@dataclass
class OrdinalModel:
    """Two weights per column, ascending thresholds; without thresholds every grade is 0."""

    columns: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, texts: pa.Array) -> np.ndarray:
        """``P(grade >= k)`` for k = 1, 2, ... of every text; 0 for a text without words."""
        of, column, count, n = word_counts(texts)
        score = np.zeros(n)
        if len(self.columns):
            place = np.minimum(np.searchsorted(self.columns, column), len(self.columns) - 1)
            own = self.columns[place] == column
            x = strength(of, count, n)[own]
            score = np.bincount(of[own], (self.weights[place[own]] * x).sum(axis=1), n)
        p = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -30, 30)))
        p[np.bincount(of, minlength=n) == 0] = 0
        return p


def fit_ordinal(
    rows: list[tuple[int, np.ndarray, np.ndarray]], steps: int = 300, ridge: float = 0.5, least_documents: int = 4, least_z: float = 6.0
) -> OrdinalModel:
    """Fit on (toxic, columns, counts) per document; documents with the same counts count once."""
    rows = list({(t, c.tobytes(), k.tobytes()): (t, c, k) for t, c, k in rows}.values())
    toxic = np.array([r[0] for r in rows], bool)
    if not toxic.any() or toxic.all():
        return OrdinalModel(np.zeros(0, int), np.zeros((0, 2)), np.zeros(0) if not toxic.any() else np.full(1, -30.0))
    of = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    column = np.concatenate([r[1] for r in rows])
    count = np.concatenate([r[2] for r in rows])
    names, column = np.unique(column, return_inverse=True)
    within = np.bincount(column, toxic[of], len(names))
    without = np.bincount(column, ~toxic[of], len(names))
    a, b = (within + 0.5) / (toxic.sum() + 1), (without + 0.5) / ((~toxic).sum() + 1)
    log_odds = np.log(a / b)
    share = (within + without + 1) / (len(rows) + 2)
    z = (a - b) / np.sqrt(share * (1 - share) * (1 / toxic.sum() + 1 / (~toxic).sum()))
    telling = (within + without >= least_documents) & (np.abs(z) >= least_z)
    share = np.bincount(of, count * (telling & (log_odds > 2))[column], len(rows)) / np.bincount(of, count, len(rows)).clip(1)
    grade = np.where(toxic, 1 + (share > np.median(share[toxic])), 0)

    kept = np.flatnonzero(telling)
    own = telling[column]
    of, place, x = of[own], np.searchsorted(kept, column[own]), strength(of, count, len(rows))[own]
    w, theta = np.zeros((len(kept), 2)), np.array([1.0, 0.0])  # the second threshold is the first + exp(its value)
    momentum, square = np.zeros(w.size + 2), np.zeros(w.size + 2)
    for step in range(1, steps + 1):
        score = np.bincount(of, (w[place] * x).sum(axis=1), len(rows))
        cuts = np.array([-np.inf, theta[0], theta[0] + np.exp(theta[1]), np.inf])
        with np.errstate(over="ignore"):
            high = 1 / (1 + np.exp(score - cuts[grade + 1]))
            low = 1 / (1 + np.exp(score - cuts[grade]))
        mass = np.maximum(high - low, 1e-9)
        d_high, d_low = -high * (1 - high) / mass, low * (1 - low) / mass
        first = d_high[grade == 0].sum() + d_low[grade == 1].sum()
        second = d_high[grade == 1].sum() + d_low[grade == 2].sum()
        pull = (1 - high - low)[of]
        slope = np.stack([np.bincount(place, pull * x[:, j], len(kept)) for j in (0, 1)], axis=1) + ridge * w
        gradient = np.concatenate([slope.ravel(), [first + second, second * np.exp(theta[1])]])
        momentum = 0.9 * momentum + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, theta = w - move[:-2].reshape(w.shape), theta - move[-2:]
    return OrdinalModel(names[kept], w, np.array([theta[0], theta[0] + np.exp(theta[1])]))


def fit_toxicity(documents: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> OrdinalModel:
    """Fit on at most ``most`` documents labelled in ``toxic``; tasks send counts, never texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                of, column, count, n = word_counts(piece.column("text"))
                cuts = np.searchsorted(of, np.arange(1, n))
                yield pa.record_batch(
                    [piece.column("doc_id"), piece.column("label").cast(pa.int32())]
                    + [pa.array([x.astype(np.int32).tobytes() for x in np.split(v, cuts)], pa.binary()) for v in (column, count)],
                    ["doc_id", "label", "columns", "counts"],
                )

    sample = labelled_sample(documents, labels, "toxic", most).select("doc_id", F.col("label").cast("int").alias("label"), "text")
    kind = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, label int, columns binary, counts binary"
    # Of several texts with one id the least counts decide, whatever the order of rows.
    one = F.min(F.struct("label", "columns", "counts")).alias("row")
    got = sample.mapInArrow(rows, kind).groupBy("doc_id").agg(one).select("doc_id", "row.*").orderBy("doc_id").collect()
    return fit_ordinal([(r.label, np.frombuffer(r.columns, np.int32), np.frombuffer(r.counts, np.int32)) for r in got])


def score_toxicity(documents: DataFrame, model: OrdinalModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """``doc_id, expected_severity, grade, rejected`` of every document.

    The grade is the highest that has at least an even chance.  A null text, or one
    without words, has severity 0.  Repeated rows are scored each; columns other than
    ``doc_id`` and ``text`` are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                p = model.at_least(piece.column("text"))
                rejected = p[:, 0] >= reject_from if p.shape[1] else np.zeros(len(p), bool)
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(p.sum(axis=1)), pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(rejected)],
                    ["doc_id", "expected_severity", "grade", "rejected"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, expected_severity double, grade int, rejected boolean")


def drop_toxic(documents: DataFrame, model: OrdinalModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows that the model does not reject, with all their columns, in one pass."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                p = model.at_least(piece.column("text"))
                yield piece.filter(pa.array(p[:, 0] < reject_from)) if p.shape[1] else piece

    return documents.mapInArrow(rows, documents.schema)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Severity of every document, by a model fitted on the labelled ones."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return score_toxicity(documents, fit_toxicity(documents, labels))
