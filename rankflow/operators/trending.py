"""Activity per post and the trending report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_trend() -> list:
    return [F.desc("total_interactions"), F.asc("post_id")]


def post_counts(interactions: DataFrame) -> DataFrame:
    """Interactions per post."""
    return interactions.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_interactions"))


def trending_counts(pairs: DataFrame) -> DataFrame:
    """Interactions, distinct users and likes per post, from ``pair_activity``.

    A pair is one user, so counting users needs no distinct, and a post with a
    third of the log reaches its final task as one partial row per map task.
    """
    return pairs.groupBy("post_id").agg(
        F.sum("n_interactions").alias("total_interactions"),
        F.count("user_id").alias("unique_users"),
        F.sum("n_likes").alias("total_likes"),
    )


def trending_posts(counts: DataFrame, posts: DataFrame) -> DataFrame:
    """Counts with post metadata; only posts known on both sides."""
    catalogue = posts.select("post_id", "topic", "creator_id", "timestamp")
    return counts.join(catalogue, "post_id")


def trending_top(trending: DataFrame, length: int) -> DataFrame:
    """The report of the most active posts; equal counts go by post id."""
    return trending.orderBy(*_by_trend()).limit(length)


def trending_cards(trending: DataFrame, length: int) -> DataFrame:
    """The report with each post's place and its activity relative to the first.

    The windows see only the ``length`` rows that the report keeps.
    """
    top = trending_top(trending, length)
    count = F.col("total_interactions")
    most = F.max(count).over(Window.partitionBy())
    return top.select(
        F.row_number().over(Window.orderBy(*_by_trend())).alias("place"),
        "post_id",
        "topic",
        "total_interactions",
        F.when(most > 0, count / most * 100).otherwise(0.0).alias("relative_activity"),
    )


def user_sketches(interactions: DataFrame, *by: str, log_size: int = 12) -> DataFrame:
    """One mergeable sketch of the users of each post, for every combination of ``by``, such as a day.

    A sketch has at most ``2 ** log_size`` registers whatever it counts, and is built before the
    shuffle, so a hot post costs one sketch per task.  Rows without a user do not count.
    """
    return interactions.groupBy("post_id", *by).agg(
        F.hll_sketch_agg("user_id", log_size).alias("users"), F.count(F.lit(1)).alias("n_interactions")
    )


def users_of_sketches(sketches: DataFrame) -> DataFrame:
    """``post_id, total_interactions, approx_users`` of stored sketches, of any days, added up.

    Sketches of one size merge without loss: days added up give what one sketch of all rows gives.
    """
    merged = sketches.groupBy("post_id").agg(
        F.sum("n_interactions").alias("total_interactions"), F.hll_union_agg("users").alias("users")
    )
    return merged.select("post_id", "total_interactions", F.hll_sketch_estimate("users").alias("approx_users"))
