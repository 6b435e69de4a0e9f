"""Normalised ranking signals.

Global bounds come from uncorrelated scalar subqueries: the plan stays lazy and
nothing is joined to a one-row table or fetched to build literals.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions import min_max, unit_ratio


def _bounds(df: DataFrame, column: str):
    span = F.struct(F.min(column).alias("low"), F.max(column).alias("high"))
    bounds = df.agg(span.alias("span")).scalar()
    return bounds.getField("low"), bounds.getField("high")


def popularity_scores(counts: DataFrame, decimals: int) -> DataFrame:
    """Min-max position of each post's ``n_interactions`` among all posts."""
    low, high = _bounds(counts, "n_interactions")
    place = min_max(F.col("n_interactions"), low, high)
    return counts.select(
        "post_id", "n_interactions", F.round(place, decimals).alias("popularity_score")
    )


def recency_scores(posts: DataFrame, reference: date, decimals: int) -> DataFrame:
    """1 for the newest post down to 0 for the oldest; 1 if all dates are equal."""
    age = F.datediff(F.lit(reference), "timestamp").alias("days_old")
    aged = posts.select("post_id", "topic", age)
    low, high = _bounds(aged, "days_old")
    newness = F.lit(1.0) - min_max(F.col("days_old"), low, high)
    return aged.select("post_id", "topic", F.round(newness, decimals).alias("recency_score"))


def interaction_scores(scores: DataFrame, decimals: int) -> DataFrame:
    """Score relative to the user's best; 0.0 for a user whose best is 0.

    The best is an aggregate joined back rather than a window, because a window
    would hold all rows of a user in one task; a skewed join can be split.  Rows
    without user are those of one unknown user.
    """
    best = scores.groupBy(F.col("user_id").alias("_user")).agg(
        F.max("total_score").alias("best_score")
    )
    return scores.join(best, F.col("user_id").eqNullSafe(F.col("_user"))).select(
        "user_id",
        "post_id",
        unit_ratio(F.col("total_score"), F.col("best_score"), decimals).alias(
            "interaction_score"
        ),
    )


def post_signals(popularity: DataFrame, recency: DataFrame) -> DataFrame:
    """Both post-level signals side by side, so that candidates join them once."""
    return popularity.select("post_id", "popularity_score").join(
        recency.select("post_id", "recency_score"), "post_id", "full"
    )
