"""Quality rules as gradient-boosted trees over statistics of a document.

A task computes the statistics of all its texts with array operations.  The trees are
fitted on a bounded sample of labelled documents with logistic loss on binned features;
a feature may be held to raise or to lower the score only.  A fitted model is a set of
flat node arrays, so that a batch of rows walks down all trees in a few array steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import Texts, is_space, mix, pieces, span_hashes, windows
from rankflow.llm.labelled import labelled_sample

#: Labelled documents that the trees are fitted on, at most.
FIT_ROWS = 20_000
#: A document is kept where the model gives label 1 at least this probability.
KEEP_FROM = 0.5

#: Name and direction of each feature: 1 may only raise the score, -1 only lower it.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "upper_share": -1,
    "digit_share": 0,
    "punctuation_per_word": 0,
    "pipes_per_word": -1,
    "words_per_line": 0,
    "doubled_word_share": -1,
}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*b"#*$%&|<>"]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*b"!?.,;:"]] = True


def statistics(texts: Texts) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of the contract, and the feature matrix, of every text."""
    data, n = texts.data, texts.n
    starts, ends, of = texts.words()
    hashes = span_hashes(data, starts, ends)
    n_words = np.bincount(of, minlength=n)
    space = is_space(data)
    letters = ~space & ((data & 0xC0) != 0x80)
    word_chars = texts.sums(letters)

    line_start, line_end, line_of = texts.lines()
    spoken = np.concatenate([[0], np.cumsum(~space)])
    real = spoken[line_end] > spoken[line_start]
    lines = span_hashes(data, line_start, line_end)[real]
    line_of = line_of[real]
    n_lines = np.bincount(line_of, minlength=n)
    own = np.unique(lines ^ mix(line_of.astype(np.uint64)), return_index=True)[1]
    n_dup_lines = n_lines - np.bincount(line_of[own], minlength=n)

    shingle, first = windows(hashes, of, 3)
    _, back, count = np.unique(shingle ^ mix(of[first].astype(np.uint64)), return_inverse=True, return_counts=True)
    again = first[count[back] > 1]
    covered = np.zeros(len(of) + 3, bool)
    for i in range(3):
        covered[again + i] = True
    n_repeat = np.bincount(of[covered[: len(of)]], minlength=n)

    doubled = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    n_symbols = texts.sums(_SYMBOL[data])
    words = np.maximum(n_words, 1)
    chars = np.maximum(word_chars, 1)
    upper = texts.sums((data >= 0x41) & (data <= 0x5A))
    digits = texts.sums((data >= 0x30) & (data <= 0x39))
    features = np.stack(
        [
            np.log1p(n_words),
            word_chars / words,
            n_symbols / words,
            n_dup_lines / np.maximum(n_lines, 1),
            n_repeat / words,
            upper / chars,
            digits / chars,
            texts.sums(_PUNCTUATION[data]) / words,
            texts.sums(data == 0x7C) / words,
            n_words / np.maximum(n_lines, 1),
            np.bincount(of[1:][doubled], minlength=n) / words,
        ],
        axis=1,
    )
    counts = dict(zip(_COUNTS, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat), strict=True))
    return counts, features


@dataclass
class Trees:
    """All trees in flat arrays: node k of any tree is at ``root + k``; a leaf points at itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1: every row stands at one node of every tree and goes down a level a step."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[at]] <= self.cut[at]
            at = np.where(low, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    directions: list[int],
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Boosted trees by second-order logistic loss.

    A split on a constrained feature must order its children's values, and bounds handed
    down the tree keep all later values on their side, so the sum of trees is monotone.
    Without both labels the model is a constant.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), base)

        def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
            node = len(nodes)
            g, h = gradient[rows], hessian[rows]
            value = float(np.clip(-g.sum() / (h.sum() + ridge), low, high))
            nodes.append([0, np.inf, node, node, rate * value])
            if level == depth:
                margin[rows] += rate * value
                return node
            best, plan = 1e-6, None
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], g, len(c) + 1))
                hl = np.cumsum(np.bincount(binned[rows, j], h, len(c) + 1))
                gr, hr = gl[-1] - gl[:-1], hl[-1] - hl[:-1]
                gl, hl = gl[:-1], hl[:-1]
                vl = np.clip(-gl / (hl + ridge), low, high)
                vr = np.clip(-gr / (hr + ridge), low, high)
                gain = -(gl * vl + 0.5 * (hl + ridge) * vl**2) - (gr * vr + 0.5 * (hr + ridge) * vr**2)
                gain += g.sum() * value + 0.5 * (h.sum() + ridge) * value**2
                gain[(hl < least) | (hr < least) | (directions[j] * (vr - vl) < 0)] = -1
                k = int(gain.argmax())
                if gain[k] > best:
                    best, plan = float(gain[k]), (j, k, (vl[k] + vr[k]) / 2)
            if plan is None:
                margin[rows] += rate * value
                return node
            j, k, middle = plan
            goes = binned[rows, j] <= k
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            (la, lb), (ra, rb) = bounds.get(directions[j], ((low, high), (low, high)))
            nodes[node][:2] = [j, cuts[j][k]]
            nodes[node][2] = grow(rows[goes], level + 1, la, lb)
            nodes[node][3] = grow(rows[~goes], level + 1, ra, rb)
            return node

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            gradient, hessian = p - y, p * (1 - p)
            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    flat = np.array(nodes, float).reshape(-1, 5)
    return Trees(
        *(flat[:, 0].astype(int), flat[:, 1], flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4]),
        np.array(roots, int),
        depth,
        base,
    )


def fit_quality_rules(documents: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Trees:
    """Fit on at most ``most`` documents labelled in ``quality``; tasks send features, never texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                _, x = statistics(Texts.of(piece.column("text")))
                yield pa.record_batch([piece.column("doc_id"), piece.column("label").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    sample = labelled_sample(documents, labels, "quality", most).select("doc_id", F.col("label").cast("int").alias("label"), "text")
    kind = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, label int, x array<double>"
    got = sample.mapInArrow(rows, kind).groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("r.*").collect()
    x = np.array([r.x for r in got], float).reshape(-1, len(FEATURES))
    return fit_trees(x, np.array([r.label for r in got], float), list(FEATURES.values()))


def judge_quality(documents: DataFrame, model: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: the counts, the base rule's verdict, the score and ``kept``.

    A null text counts as empty; without words it fails the base rule.  Repeated rows are
    judged each.  Columns other than ``doc_id`` and ``text`` are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                counts, x = statistics(Texts.of(piece.column("text")))
                failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
                p = model.probability(x)
                yield pa.record_batch(
                    [piece.column("doc_id"), *(pa.array(counts[c].astype(np.int64)) for c in _COUNTS), pa.array(failed), pa.array(~failed & (p >= keep_from)), pa.array(p)],
                    ["doc_id", *_COUNTS, "base_failed", "kept", "quality"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean, quality double"
    return documents.select("doc_id", "text").mapInArrow(rows, schema)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the table judged by trees fitted on its labelled documents."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return judge_quality(documents, fit_quality_rules(documents, labels))
