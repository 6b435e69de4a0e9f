import collections
import functools
import math
import re

import numpy as np
import pyarrow as pa
from conftest import SMALL

from rankflow.llm import toxicity
from rankflow.llm.labelled import labelled_sample


def test_thresholds_share_weights_and_keep_their_order():
    draw = np.random.default_rng(3)
    rows = []
    for i in range(600):
        hits = int(draw.integers(1, 9)) if i % 4 == 0 else 0
        columns = np.unique(np.concatenate([draw.integers(10, 200, 20), [5] * bool(hits)]))
        rows.append((int(hits > 0), columns, np.where(columns == 5, max(hits, 1), 1)))
    model = toxicity.fit_ordinal(rows)
    assert model.thresholds[0] < model.thresholds[1]
    assert 5 in model.columns and model.weights.shape == (len(model.columns), 2)


def test_held_out_labels(spark):
    folder = SMALL.replace("0.001", "0.01")
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(documents, labels.where("doc_id % 3 > 0"))
    got = toxicity.score_toxicity(documents, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    clean = [r for r in got if r.toxic == 0]
    assert np.mean([r.rejected for r in clean]) < 0.02
    assert np.mean([r.rejected for r in got if r.toxic == 1]) > 0.5
    assert all(r.grade in (0, 1, 2) and 0 <= r.expected_severity <= 2 for r in got)


@functools.cache
def columns_of(word):
    return toxicity.word_counts(pa.array([word]))[1].tolist()


def severity(model, text):
    """Expected severity of one text by the formula, word by word; and the chance of grade 1."""
    counts = collections.Counter()
    for word in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
        counts.update(columns_of(word))
    total = sum(counts.values())
    score = 0.0
    for column, w in zip(model.columns.tolist(), model.weights.tolist(), strict=True):
        if n := counts[column]:
            score += w[0] * math.log2(1 + n) + w[1] * math.log2(1 + 256 * n / total)
    chances = [1 / (1 + math.exp(t - score)) if total else 0.0 for t in model.thresholds]
    return sum(chances), chances[0] if chances else 0.0


def test_the_query_follows_the_formula(spark):
    folder = SMALL.replace("0.001", "0.01")  # the smallest table has too few toxic texts for telling words
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(documents, labels)
    assert len(model.columns) and len(model.thresholds) == 2
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {r.doc_id: r for r in toxicity.op5_toxicity(spark, folder).collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        want, chance = severity(model, text)
        assert abs(got[i].expected_severity - want) < 1e-6 and got[i].rejected == (chance >= toxicity.REJECT_FROM)


def test_dropping_agrees_with_scores(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.fit_toxicity(documents, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scored = toxicity.score_toxicity(documents, model)
    kept = toxicity.drop_toxic(documents, model)
    assert kept.schema == documents.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in scored.where("not rejected").collect())


def test_odd_rows(odd, docs, labels):
    for documents, rows in ((odd, [(1, 1, 0), (4, 0, 1), (None, 1, 1)]), (odd, [(4, 1, 1)]), (odd, []), (docs([]), [(1, 1, 1)])):
        model = toxicity.fit_toxicity(documents, labels(rows))
        got = toxicity.score_toxicity(documents, model).collect()
        assert len(got) == documents.count()
        assert all(r.expected_severity == 0 and not r.rejected for r in got if r.doc_id in (1, 2, 5))
        assert toxicity.drop_toxic(documents, model).schema == documents.schema
        assert toxicity.drop_toxic(documents, model).count() == sum(not r.rejected for r in got)


def test_labels_that_are_null_or_of_other_documents_do_not_shrink_the_sample(docs, labels):
    documents = docs((i, f"text {i}") for i in range(200))
    rows = [(i, None, i % 2 if i < 400 and i % 2 == 0 or i < 100 else None) for i in range(20_000)]
    own = {i for i, _, toxic in rows if toxic is not None and i < 200}
    for most, want in ((20, 20), (1_000, len(own))):
        got = {r.doc_id for r in labelled_sample(documents, labels(rows), "toxic", most).collect()}
        assert len(got) == want and got <= own


def test_repeated_ids_fit_alike_in_any_order(docs, labels):
    rows = [(i % 40, f"{'vile awful' if i % 40 < 20 else 'calm kind'} words{i % 7} number{i}") for i in range(120)]
    own = labels([(i, 0, int(i < 20)) for i in range(40)])
    one, two = (toxicity.fit_toxicity(docs(r).repartition(n), own) for r, n in ((rows, 2), (rows[::-1], 5)))
    assert len(one.columns) and (one.columns == two.columns).all() and (one.weights == two.weights).all()
