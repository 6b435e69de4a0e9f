"""Quality scores learned from preference pairs, after Bradley and Terry.

A document labelled 1 is preferred to one labelled 0 with probability
``sigmoid(w . (x_1 - x_0))``; the weights minimise the logistic loss on feature differences
of the pairs in buckets of documents, which hold all labelled ones.  Scores are cut at the quantile that the share of label 0 among the fitted
documents marks; a monotone curve puts that cut at ``CUT`` on a scale from 0 to 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import Texts, pieces
from rankflow.llm.labelled import held_out
from rankflow.llm.quality_rules import FEATURES, statistics
from rankflow.sources.workspace import Workspace

Keep = Callable[[DataFrame, str], DataFrame]

#: Documents of a bucket, in which all pairs are formed, about, and at most where a label is rare.
BUCKET_ROWS = 512
MOST_BUCKET_ROWS = 8_192
#: Passes over the pairs, at most, and what is added to their mean loss per squared weight, twice.
PASSES = 15
RIDGE = 1e-4
#: Intervals that scores are counted in at a time.
BINS = 4_096
_UNIT = 2.0**-20
#: The value on the scale of scores from which a document counts as good.
CUT = 0.3
_SHARES = [i for i, name in enumerate(FEATURES) if "share" in name or "per_word" in name]


def features(texts: Texts) -> np.ndarray:
    """Statistics of every text: as they are, damped, so that small shares weigh in, and squared, for large ones."""
    _, x = statistics(texts)
    shares = x[:, _SHARES]
    return np.concatenate([x, np.log1p(100 * shares), shares**2], axis=1)


@dataclass
class PairwiseModel:
    weights: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    cut: float
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, ``CUT`` at the quantile cut."""
        raw = np.clip((x - self.centre) / self.spread, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip((raw - self.cut) / self.scale + np.log(CUT / (1 - CUT)), -30, 30)))


def _bucket_sums(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss, gradient and curvature of all pairs of label 1 and label 0 in a bucket, as one vector of whole numbers.

    Means over the pairs times documents, in units of ``_UNIT``: sums of such are the same in any order.
    """
    good, bad = z[y == 1], z[y == 0]
    width = len(w)
    if not len(good) or not len(bad):
        return np.zeros(1 + width + width * width)
    ahead = np.clip((good @ w)[:, None] - (bad @ w)[None, :], -30, 30)
    wrong = 1 / (1 + np.exp(ahead))
    unsure = wrong * (1 - wrong)
    gradient = wrong.sum(axis=0) @ bad - wrong.sum(axis=1) @ good
    across = good.T @ (unsure @ bad)
    curvature = (good * unsure.sum(axis=1)[:, None]).T @ good + (bad * unsure.sum(axis=0)[:, None]).T @ bad - across - across.T
    loss = -np.log1p(-wrong).sum()
    return np.rint(np.concatenate([[loss], gradient, curvature.ravel()]) * (len(z) / ahead.size / _UNIT))


def _weights(sums: Callable[[np.ndarray], np.ndarray], n_rows: int, width: int, ridge: float, passes: int) -> np.ndarray:
    """The minimum of loss and ridge by Newton's steps, halved where one leads upward; ``sums`` is a pass over all rows."""
    best, at, lowest = np.zeros(width), np.zeros(width), np.inf
    for _ in range(passes):
        total = sums(at) * _UNIT / n_rows
        loss = total[0] + ridge / 2 * at @ at
        if loss > lowest + 1e-9:
            at = (at + best) / 2
            continue
        gain, best, lowest = lowest - loss, at, loss
        curvature = total[1 + width :].reshape(width, width) + ridge * np.eye(width)
        step = np.linalg.solve(curvature, total[1 : 1 + width] + ridge * at)
        if gain < 1e-7 or np.abs(step).max() < 1e-5:
            break
        at = at - step
    return best


def _one_label(width: int, n_bad: int) -> PairwiseModel:
    return PairwiseModel(np.zeros(width), np.zeros(width), np.ones(width), 30.0 if n_bad else -30.0, 1.0)


def _n_buckets(n_good: int, n_bad: int) -> int:
    """Buckets that pairs are formed in: some 512 documents each, or more where one label is rare."""
    rows = n_good + n_bad
    return max(min(rows // BUCKET_ROWS, min(n_good, n_bad) // 8), rows // MOST_BUCKET_ROWS, 1)


def fit_pairs(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, passes: int = PASSES) -> PairwiseModel:
    """Fit on feature rows with labels 0 and 1; with one label only, all scores are 1 (or 0)."""
    n_good, n_bad = int((y == 1).sum()), int((y == 0).sum())
    width = x.shape[1]
    if not n_good or not n_bad:
        return _one_label(width, n_bad)
    centre, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.clip((x - centre) / spread, -8, 8)
    n = _n_buckets(n_good, n_bad)
    w = _weights(lambda w: sum(_bucket_sums(z[i::n], y[i::n], w) for i in range(n)), len(y), width, ridge, passes)
    raw = z @ w
    # The cut is halfway across the gap between scores at the quantile of the share of label 0.
    order = np.sort(raw)
    cut = float((order[n_bad - 1] + order[min(n_bad, len(raw) - 1)]) / 2)
    return PairwiseModel(w, centre, spread, cut, float(max(raw.std(), 1e-9)) / 2)


def document_features(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, x``: the features of every document; a null id belongs to no fold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                yield pa.record_batch([piece.column("doc_id"), piece.column("held_out"), _as_lists(features(Texts.of(piece.column("text"))))], ["doc_id", "held_out", "x"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows_in = documents.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows_in.mapInArrow(rows, f"doc_id {kind}, held_out boolean, x array<double>")


def _as_lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_pairwise(documents: DataFrame, labels: DataFrame) -> PairwiseModel:
    """Fit on all labelled documents outside the held-out fold."""
    return fit_features(document_features(documents), labels)


def fit_features(rows: DataFrame, labels: DataFrame, keep: Keep | None = None) -> PairwiseModel:
    """:func:`fit_pairs` on the rows of :func:`document_features`, as passes over buckets of labelled documents.

    Every labelled document outside the held-out fold takes part, in pairs with those of its
    bucket.  Only sums, and counts of scores, reach the driver.
    """
    keep = keep or Workspace(rows.sparkSession).keep
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    ids = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    labelled = rows.where(~F.col("held_out")).join(ids, "doc_id").groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r"))
    stored = keep(labelled.select("doc_id", "r.*"), "labelled")
    width = features(Texts.of(pa.array([""]))).shape[1]

    def totals(df: DataFrame, column: str, sums: Callable[[np.ndarray, pa.RecordBatch], np.ndarray]) -> np.ndarray:
        """The sum over all tasks of a vector that each computes of its rows."""

        def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [sums(_matrix(batch.column(column), width), batch) for batch in batches if batch.num_rows]
            if parts:
                yield pa.record_batch([pa.array([np.sum(parts, axis=0)], pa.list_(pa.float64()))], ["sums"])

        got = df.mapInArrow(of_task, "sums array<double>").collect()
        return np.sum([r.sums for r in got], axis=0) if got else np.zeros(1)

    def moments(x: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        y = batch.column("label").to_numpy()
        return np.concatenate([[(y == 1).sum(), (y == 0).sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    counted = totals(stored, "x", moments)
    if len(counted) == 1 or not counted[0] or not counted[1]:
        return _one_label(width, int(counted[-1 if len(counted) == 1 else 1]))
    n_good, n_bad = int(counted[0]), int(counted[1])
    n_rows = n_good + n_bad
    # Rounded, since sums of fractions differ in their last bits with the order of the tasks.
    centre = np.round(counted[2 : 2 + width] / n_rows, 9)
    spread = np.maximum(np.round(np.sqrt(np.maximum(counted[2 + width :] / n_rows - centre**2, 0)), 9), 1e-9)

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("doc_id")
        z = np.clip((_matrix(rows["x"].combine_chunks(), width) - centre) / spread, -8, 8)
        return pa.table({"z": pa.array([z.ravel()], pa.list_(pa.float64())), "y": pa.array([rows["label"].to_numpy()], pa.list_(pa.int32()))})

    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(_n_buckets(n_good, n_bad))).alias("bucket")
    buckets = keep(stored.select(bucket, "doc_id", "label", "x").groupBy("bucket").applyInArrow(pack, "z array<double>, y array<int>"), "buckets")

    def pass_over(w: np.ndarray) -> np.ndarray:
        def sums(_: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
            each = zip(batch.column("z"), batch.column("y"), strict=True)
            return sum(_bucket_sums(z.values.to_numpy().reshape(-1, width), y.values.to_numpy(), w) for z, y in each)

        return totals(buckets, "z", sums)

    w = _weights(pass_over, n_rows, width, RIDGE, PASSES)

    def counts_between(edges: np.ndarray) -> np.ndarray:
        def sums(z: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
            raw = z @ w
            return np.concatenate([[raw.sum(), (raw * raw).sum()], np.bincount(np.searchsorted(edges, raw, "right"), minlength=len(edges) + 1)])

        return totals(buckets, "z", sums)

    def nth_score(n: int) -> float:
        """The ``n``-th score from 0 by narrowing the interval that it is in."""
        low, high = -limit, limit
        while high - low > limit * 1e-12:
            edges = np.linspace(low, high, BINS + 1)
            below = np.cumsum(counts_between(edges)[2:])
            at = int(np.searchsorted(below, n, "right"))
            low, high = edges[max(at - 1, 0)], edges[min(at, BINS)]
        return (low + high) / 2

    limit = float(8 * np.abs(w).sum()) + 1
    total, squares = counts_between(np.zeros(1))[:2]
    scale = round(float(np.sqrt(max(squares / n_rows - (total / n_rows) ** 2, 1e-18))), 9) / 2
    # As in fit_pairs.
    cut = (nth_score(n_bad - 1) + nth_score(min(n_bad, n_rows - 1))) / 2
    return PairwiseModel(w, centre, spread, cut, max(scale, 5e-10))


def score_documents(documents: DataFrame, model: PairwiseModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Only the text is read for a score: a null text scores as an empty one, repeated rows
    score alike.  A null id belongs to no fold, and ``held_out`` is false for it.
    """
    return score_features(document_features(documents), model)


def score_features(rows: DataFrame, model: PairwiseModel) -> DataFrame:
    """:func:`score_documents` of the rows of :func:`document_features`."""
    width = len(model.weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column("x"), width))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= CUT).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op4_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored, by weights learned outside the held-out fold."""
    place = Workspace(spark)
    rows = place.keep(document_features(spark.read.parquet(f"{folder}/documents.parquet")), "features")
    return score_features(rows, fit_features(rows, spark.read.parquet(f"{folder}/labels.parquet"), place.keep))
