"""Quality rules and pairwise quality."""

import collections
import re

import numpy as np
import pyarrow as pa
from conftest import SMALL

from rankflow.llm import pairwise_quality, quality_rules
from rankflow.llm.bytesarrays import Texts
from rankflow.llm.labelled import held_out


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered, seen, dup = collections.Counter(triples), set(), set(), 0
    for i, t in enumerate(triples):
        if times[t] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["", " \n ", "a", "a b c a b c", "a\n\na\n a\na", " x y", "é|<>é\x0bz", "x\r\nx\r\nx", "a a a a"]
    counts, _ = quality_rules.statistics(Texts.of(pa.array([*texts, None])))
    got = list(zip(*(counts[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), strict=True))
    assert got == [counted(t) for t in texts] + [(0, 0, 0, 0, 0)]


def test_flat_trees_follow_their_constraints():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 3))
    y = (x[:, 0] - x[:, 1] + np.sin(3 * x[:, 2]) + draw.normal(size=2000) * 0.5 > 0).astype(float)
    model = quality_rules.fit_trees(x, y, [1, -1, 0])
    assert ((model.probability(x) > 0.5) == y).mean() > 0.85
    for j, sign in ((0, 1), (1, -1)):
        grid = np.repeat(x[:50], 40, axis=0)
        grid[:, j] = np.tile(np.linspace(-4, 4, 40), 50)
        steps = np.diff(model.margin(grid).reshape(50, 40), axis=1)
        assert (sign * steps >= -1e-9).all()


def test_one_label_or_none_gives_a_constant():
    for y in ([], [1.0, 1.0], [0.0]):
        x = np.zeros((len(y), 2))
        assert len(quality_rules.fit_trees(x, np.array(y), [0, 0]).roots) == 0


def test_rules_on_held_out_labels(spark):
    folder = SMALL.replace("0.001", "0.01")
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    own = labels.where("doc_id % 2 = 0")
    model = quality_rules.fit_quality_rules(documents, own)
    got = quality_rules.judge_quality(documents, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("quality", "truth"), "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == (r.truth == 1) for r in got]) > 0.97


def test_rules_on_odd_rows(odd, docs, labels):
    for documents, rows in ((odd, [(1, 1, 0), (2, 0, 1), (6, None, None), (None, 1, 1), (9, 1, 1)]), (odd, []), (docs([]), [(1, 1, 0)])):
        model = quality_rules.fit_quality_rules(documents, labels(rows))
        got = quality_rules.judge_quality(documents, model).collect()
        assert len(got) == documents.count()
        assert all(r.base_failed and not r.kept for r in got)  # too few words, or all repeated


def test_pairwise_learns_order_and_cut():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 4))
    y = (x[:, 0] - 0.5 * x[:, 1] > -0.8).astype(int)
    model = pairwise_quality.fit_pairs(x, y)
    score = model.score(x)
    assert ((score >= pairwise_quality.CUT) == (y == 1)).mean() > 0.95
    assert abs((score < pairwise_quality.CUT).mean() - (y == 0).mean()) < 0.01


def test_pairwise_on_the_held_out_fold(spark):
    folder = SMALL.replace("0.001", "0.01")
    got = pairwise_quality.op4_pairwise_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93
    good, bad = ([r.score for r in got if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97


def test_pairwise_never_learns_from_the_fold(spark, docs, labels):
    import zlib

    fold = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    frame = docs([(i, "t") for i in range(200)])
    assert sorted(r.doc_id for r in frame.where(held_out(frame.doc_id)).collect()) == fold
    some = docs([(i, "clean words here " * 9 if i % 2 else "| $ % | " * 9) for i in range(200)])
    a = pairwise_quality.fit_pairwise(some, labels([(i, i % 2, 0) for i in range(200)]))
    b = pairwise_quality.fit_pairwise(some, labels([(i, (i % 2) if i not in fold else 1 - i % 2, 0) for i in range(200)]))
    assert (a.weights == b.weights).all()


def test_pairwise_on_odd_rows(odd, docs, labels):
    for documents, rows in ((odd, [(1, 1, 0), (2, 0, 1), (None, 1, 1)]), (odd, []), (docs([]), [(1, 1, 0)])):
        got = pairwise_quality.score_documents(documents, pairwise_quality.fit_pairwise(documents, labels(rows))).collect()
        assert len(got) == documents.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert not any(r.held_out for r in got if r.doc_id is None)


def test_pairwise_fits_all_labelled_documents(spark, docs, labels, monkeypatch):
    """In buckets as in one place: no labelled document is left out, and any one of them may change the model."""
    monkeypatch.setattr(pairwise_quality, "BUCKET_ROWS", 50)
    fold = docs([(i, "t") for i in range(400)])
    learnt = sorted(r.doc_id for r in fold.where(~held_out(fold.doc_id)).collect())
    text = lambda i: "clean words here, " * (3 + i % 11) if i % 3 else "| $ % 7 | A " * (3 + i % 7) + "word " * (i % 13)
    some = docs([(i, text(i)) for i in range(400)])
    seen = []

    def keep(df, name):
        seen.append((name, df.collect()))
        return df

    model = pairwise_quality.fit_features(pairwise_quality.document_features(some), labels([(i, min(i % 3, 1), 0) for i in range(400)]), keep)
    stored, buckets = (dict(seen)[name] for name in ("labelled", "buckets"))
    assert sorted(r.doc_id for r in stored) == learnt
    assert len(buckets) > 1 and sum(len(r.y) for r in buckets) == len(learnt)
    score = model.score(np.array([r.x for r in stored]))
    assert ((score >= pairwise_quality.CUT) == (np.array([r.label for r in stored]) == 1)).mean() > 0.99


def test_pairwise_curvature_and_gradient():
    draw = np.random.default_rng(3)
    z, y, w = draw.normal(size=(40, 3)), draw.integers(0, 2, 40), draw.normal(size=3)
    pairs = np.array([a - b for a in z[y == 1] for b in z[y == 0]])
    wrong = 1 / (1 + np.exp(pairs @ w))
    curvature = (pairs * (wrong * (1 - wrong))[:, None]).T @ pairs
    want = np.concatenate([[-np.log1p(-wrong).sum()], -wrong @ pairs, curvature.ravel()]) * 40 / len(pairs)
    assert np.allclose(pairwise_quality._bucket_sums(z, y, w) * pairwise_quality._UNIT, want, atol=1e-4)
