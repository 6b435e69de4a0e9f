"""The cleaning pipeline over ``documents``: toxic documents, near duplicates and leaked
benchmark items go, personal data is replaced, and what remains is encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.decontaminate import drop_contaminated
from rankflow.llm.sentencepieces import encode_documents, read_model
from rankflow.llm.simhash_dedup import keep_first
from rankflow.llm.surrogates import replace_entities
from rankflow.llm.toxicity import drop_toxic, fit_toxicity
from rankflow.sources.workspace import Workspace


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the severity model, fitted on those of them with labels, does not reject."""
    return drop_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of fingerprints within four bits of each other."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and ``n_chars`` following the text."""
    replaced = replace_entities(docs)
    changed = {"n_chars": F.when(F.col("n_entities") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return replaced.withColumns(changed).select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their parity and round trip."""
    return encode_documents(docs, read_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("surrogates", surrogates),
    ("encoding", encoding),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to the whole table ``documents``; each one's result is a written table."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
