import re

import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql.types import StructType

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import difference, duck, type_difference
from rankflow.llm.queries import llm_queries, llm_sql
from rankflow.llm.sentencepieces import read_model
from rankflow.llm.toxicity import fit_toxicity
from tests.llm.test_decontaminate import best, words
from tests.llm.test_simhash import classes, fingerprint
from tests.llm.test_surrogates import PLAIN
from tests.llm.test_toxicity import severity


def test_registered():
    assert {re.match(r"op(\d+)_", q)[1] for q in llm_queries()} == {str(i) for i in range(1, 14)}
    assert contract.queries().keys() >= llm_queries().keys() | {"pipeline"}


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_matches_sql(spark, name):
    tables, result = duck(SMALL), llm_queries()[name](spark, SMALL)
    assert difference(result, tables, llm_sql()[name]) is None
    assert type_difference(result, tables, llm_sql()[name]) is None


def test_stages_keep_the_columns_and_only_lose_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.count() <= left
        left = docs.count()
    assert corpus_pipeline.run(spark, SMALL).count() == left


def test_stages_do_what_slow_versions_do(spark):
    """Every stage on all that its predecessor kept, row by row in plain Python."""
    labels, items = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    stages, asked = dict(corpus_pipeline.STAGES), [i.text for i in items.collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")

    def step(name):
        before, after = docs.collect(), stages[name](spark, docs, SMALL)
        return {r.doc_id: r for r in before}, {r.doc_id: r for r in after.collect()}, after

    before, after, left = step("toxicity")
    model = fit_toxicity(docs, labels)
    assert after == {i: r for i, r in before.items() if severity(model, r.text)[1] < 0.5}

    docs = left
    before, after, left = step("near_duplicates")
    prints = {i: fingerprint(r.text) for i, r in before.items()}
    up = classes(prints.values())
    first = {up[prints[i]]: i for i in sorted(before, reverse=True)}
    assert after == {i: before[i] for i in first.values()} and after != before

    docs = left
    before, after, left = step("decontamination")
    holds = lambda t: any(words(a) and words(a)[0] in words(t) and best(t, a) >= 0.8 for a in asked)
    assert after == {i: r for i, r in before.items() if not holds(r.text)}

    docs = left
    before, after, left = step("surrogates")
    found = {i for i, r in before.items() if PLAIN.search(r.text)}
    assert before.keys() == after.keys() and found <= {i for i in before if before[i].text != after[i].text}
    assert all(len(PLAIN.findall(r.text)) == len(PLAIN.findall(after[i].text)) and not set(PLAIN.findall(r.text)) & set(PLAIN.findall(after[i].text)) for i, r in before.items())
    assert all(r.n_chars == len(r.text) for i, r in after.items() if r.text != before[i].text)

    docs = left
    before, after, _ = step("encoding")
    library = sentencepiece.SentencePieceProcessor(model_proto=read_model())
    assert {i: list(r.ids) for i, r in after.items()} == {i: library.encode(r.text) for i, r in before.items()}


def test_stages_on_odd_and_empty_tables(spark, odd):
    for start in (odd, odd.where("false")):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), stage(spark, docs, SMALL).schema)
        assert isinstance(docs.schema, StructType)
        assert docs.count() == 0 if start is not odd else docs.count() >= 3
