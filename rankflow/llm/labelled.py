"""The bounded sample of labelled documents that the models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """The fold that no model of quality may learn from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def lowest_share(hashed: Column, most: int, rows: int) -> Column:
    """Whether a 64-bit hash is so low that about twice ``most`` of ``rows`` rows are: what a sample of the lowest is taken from.

    Without this every task would send its own lowest ``most`` to one place.
    """
    bound = min(2 * most + 100, rows) * 2**64 // max(rows, 1) - 2**63
    return F.lit(True) if bound >= 2**63 else hashed <= bound


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, most: int, where: Column | None = None
) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` labelled ids, those with the least hashed id.

    The sample of ids is bounded by ``most``, so it may be broadcast.  Labels other than
    0 and 1, rows without id and ids without a document do not count, for the share
    sampled from neither; an id with several labels takes the least.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        rows = rows.where(where)
    ids = rows.groupBy("doc_id").agg(F.min(label).alias("label")).join(documents.select("doc_id"), "doc_id", "left_semi")
    picked = (
        ids.where(lowest_share(F.xxhash64("doc_id"), most, ids.count()))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    return documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
