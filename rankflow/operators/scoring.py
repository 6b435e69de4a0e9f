"""From the raw log to one row per (user, post)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions import action_weight


def action_scores(interactions: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """The log with the weight of each action in ``score``."""
    return interactions.select(
        "user_id", "post_id", "action", action_weight(F.col("action"), weights).alias("score")
    )


def pair_activity(
    interactions: DataFrame, weights: Mapping[str, int], like_action: str
) -> DataFrame:
    """Everything the jobs need to know about a (user, post) pair.

    The only shuffle of the raw log: scores, trending counts and popularity all
    derive from this table.  Its key is the pair, combined before the shuffle, so a
    hot post or a hot user spreads over all tasks.
    """
    score = action_weight(F.col("action"), weights).cast("bigint")
    return interactions.groupBy("user_id", "post_id").agg(
        F.sum(score).alias("total_score"),
        F.count(F.lit(1)).alias("n_interactions"),
        F.count_if(F.col("action") == like_action).alias("n_likes"),
    )


def pair_activity_by_action(
    interactions: DataFrame, weights: Mapping[str, int], like_action: str
) -> DataFrame:
    """:func:`pair_activity` with ``actions``, the number of rows per action of the pair.

    With it the histogram of actions needs no other look at the log.  Rows are combined by
    (user, post, action) before they are shuffled.
    """
    each = interactions.groupBy("user_id", "post_id", "action").agg(F.count(F.lit(1)).alias("n"))
    score = action_weight(F.col("action"), weights).cast("bigint")
    likes = F.when(F.col("action") == like_action, F.col("n")).otherwise(0)
    return each.groupBy("user_id", "post_id").agg(
        F.sum(score * F.col("n")).alias("total_score"),
        F.sum("n").alias("n_interactions"),
        F.sum(likes).alias("n_likes"),
        F.collect_list(F.struct("action", "n")).alias("actions"),
    )


def weight_periods(weights: DataFrame) -> DataFrame:
    """``action, weight, valid_from, valid_to`` checked: periods of one action that overlap are an error.

    A period holds its first day and not its last.  A missing first or last day is open.
    """
    first = F.coalesce("valid_from", F.lit("0001-01-01").cast("date"))
    last = F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))
    typed = weights.select("action", F.col("weight").cast("bigint").alias("weight"), first.alias("valid_from"), last.alias("valid_to"))
    before = Window.partitionBy("action").orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    clash = F.raise_error(F.concat(F.lit("overlapping weights of "), F.coalesce("action", F.lit("NULL")))).cast("bigint")
    return typed.withColumn("weight", F.when(F.max("valid_to").over(before) > F.col("valid_from"), clash).otherwise(F.col("weight")))


def action_scores_by_period(interactions: DataFrame, weights: DataFrame) -> DataFrame:
    """The log (with a ``day``) and the weight that each action had on its day, in ``score``.

    The weights are a table, joined on the action; Spark broadcasts it if its size allows.  An action
    that is missing, unknown, or without a weight on its day weighs 0, as does one without a day.
    """
    periods = weight_periods(weights).withColumnRenamed("action", "_action")
    valid = (F.col("action") == F.col("_action")) & (F.col("day") >= F.col("valid_from")) & (F.col("day") < F.col("valid_to"))
    joined = interactions.select("user_id", "post_id", "action", "day").join(periods, valid, "left")
    return joined.select("user_id", "post_id", "action", "day", F.coalesce("weight", F.lit(0)).cast("bigint").alias("score"))


def user_post_scores(interactions: DataFrame, weights: Mapping[str, int]) -> DataFrame:
    """Summed weight per (user, post); pairs that sum to 0 stay."""
    score = action_weight(F.col("action"), weights).cast("bigint")
    return interactions.groupBy("user_id", "post_id").agg(F.sum(score).alias("total_score"))


def matrix_dimensions(scores: DataFrame) -> DataFrame:
    """Number of users and of posts in the score matrix, as one row.

    Two aggregates of one distinct column each, so that nothing is expanded.
    """
    users = scores.agg(F.count_distinct("user_id")).scalar()
    return scores.agg(F.count_distinct("post_id").alias("n_posts")).select(
        users.alias("n_users"), "n_posts"
    )
