"""Column expressions.  All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def action_weight(action: Column, weights: Mapping[str, int]) -> Column:
    """Weight of an action; an unknown or NULL action weighs 0."""
    if not weights:
        return F.lit(0)
    cases = reduce(lambda case, kv: case.when(action == kv[0], kv[1]), weights.items(), F)
    return cases.otherwise(0).cast("int")


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position of ``value`` in ``[low, high]``; 0 when the interval is a point."""
    return (value - low) / F.coalesce(F.nullif(high - low, F.lit(0)), F.lit(1))


def unit_ratio(part: Column, whole: Column, decimals: int) -> Column:
    """``part / whole`` rounded, 0.0 where ``whole`` is 0."""
    return F.coalesce(F.round(part / F.nullif(whole, F.lit(0)), decimals), F.lit(0.0))


def cosine(dot: Column, norm2_a: Column, norm2_b: Column) -> Column:
    """Cosine from integer sums, NULL where a vector has no length.

    The dot product and the squared norms are exact bigints and a square root is
    correctly rounded, so equal inputs give equal bits wherever they are computed.
    """
    return dot / F.nullif(F.sqrt(norm2_a) * F.sqrt(norm2_b), F.lit(0.0))


def weighted_feed_score(
    interaction: Column,
    popularity: Column,
    recency: Column,
    *,
    weights: tuple[float, float, float],
    decimals: int,
) -> Column:
    """The three signals blended into one score."""
    w_interaction, w_popularity, w_recency = weights
    blend = (
        F.lit(w_interaction) * interaction
        + F.lit(w_popularity) * popularity
        + F.lit(w_recency) * recency
    )
    return F.round(blend, decimals)


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int
) -> DataFrame:
    """The first ``limit`` rows of every group.

    Written as ``row_number() <= literal`` so that Spark plans a group limit before
    the shuffle: each task forwards at most ``limit`` rows of a group, however
    large that group is.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hash-partitioned by ``keys`` over all shuffle partitions.

    For the input of a join whose output is far longer than its input: sized by its
    bytes, the input would be packed into too few tasks.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)
