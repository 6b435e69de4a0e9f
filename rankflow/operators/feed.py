"""The ranked feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions import top_per_group, weighted_feed_score
from rankflow.operators.levels import level, levels, with_level


def touched(interaction: DataFrame) -> DataFrame:
    """Posts of the user's own history, with their interaction score."""
    return interaction.select("user_id", "post_id", "interaction_score")


def recommended(recommendations: DataFrame, base_score: float) -> DataFrame:
    """Recommended posts, all with the same interaction score."""
    return recommendations.select(
        "user_id",
        F.col("recommended_post_id").alias("post_id"),
        F.lit(base_score).alias("interaction_score"),
    )


def feed_candidates(rows: DataFrame, signals: DataFrame) -> DataFrame:
    """Touched or recommended posts with their post signals; 0 where there is none."""
    nothing = F.lit(0.0)
    return rows.join(signals, "post_id", "left").select(
        "user_id",
        "post_id",
        "interaction_score",
        F.coalesce("popularity_score", nothing).alias("popularity_score"),
        F.coalesce("recency_score", nothing).alias("recency_score"),
    )


def feed_scores(
    candidates: DataFrame, weights: tuple[float, float, float], decimals: int
) -> DataFrame:
    """Blended score of every candidate."""
    score = weighted_feed_score(
        F.col("interaction_score"),
        F.col("popularity_score"),
        F.col("recency_score"),
        weights=weights,
        decimals=decimals,
    )
    return candidates.select("user_id", "post_id", score.alias("feed_score"))


def best_scores(scored: DataFrame) -> DataFrame:
    """One row per (user, post), with its best score."""
    return scored.groupBy("user_id", "post_id").agg(F.max("feed_score").alias("feed_score"))


def best_first() -> list:
    """Ranking of a feed; equal scores go by post id."""
    return [F.desc("feed_score"), F.asc("post_id")]


def ranked(scored: DataFrame, length: int) -> DataFrame:
    """Each user's best posts from scored candidates of any origin."""
    return top_per_group(best_scores(scored), ["user_id"], best_first(), length)


def touched_feed(touched_scored: DataFrame, length: int) -> DataFrame:
    """Each user's best touched posts."""
    return ranked(touched_scored, length)


def last_scores(own: DataFrame, length: int) -> DataFrame:
    """What a post needs to enter a feed whose touched posts alone fill it.

    A user with ``length`` touched posts cannot have a feed that ends below the last
    of them.
    """
    return (
        own.groupBy("user_id")
        .agg(F.min("feed_score").alias("last_score"), F.count(F.lit(1)).alias("n_posts"))
        .where(F.col("n_posts") >= length)
        .select("user_id", "last_score")
    )


def in_reach(scored: DataFrame) -> DataFrame:
    """Rows that can enter the feed of their user, from those with a ``last_score``."""
    last = F.col("last_score")
    return scored.where(last.isNull() | (F.col("feed_score") >= last)).drop("last_score")


def maybe_in_reach(recommended: DataFrame, posts_scored: DataFrame, least_score: Column, own: DataFrame, length: int) -> DataFrame:
    """``recommended`` without most of the rows whose score is out of their user's reach; it is not shuffled.

    ``posts_scored`` has the ``feed_score`` of each post as a recommended one, and ``least_score`` is
    that of all others.  Levels of posts are rounded up to the greatest of their cell, and those of
    :func:`last_scores` down to the least; users without a last score are in their cells with
    the lowest level.  The levels are few by themselves, so they are broadcast whatever their size.
    """
    of_posts = posts_scored.select("post_id", level(F.col("feed_score")).alias("level"))
    last = last_scores(own, length)
    free = recommended.select("user_id").distinct().join(last, "user_id", "left_anti")
    of_users = last.select("user_id", level(F.col("last_score")).alias("level")).unionByName(
        free.select("user_id", F.lit(0).cast("bigint").alias("level"))
    )
    met = with_level(recommended, levels(of_users, "user_id", F.min), "user_id", "needed")
    met = with_level(met, levels(of_posts, "post_id", F.max), "post_id", "level")
    greatest = F.greatest(F.coalesce("level", F.lit(0)), level(least_score))
    return met.where(greatest >= F.coalesce("needed", F.lit(0))).select(recommended.columns)


def user_feed(own: DataFrame, recommended_scored: DataFrame, length: int) -> DataFrame:
    """Each user's best posts: those of ``touched_feed``, or recommended.

    Recommendations out of reach, most of them as a rule, go before they are
    compared with touched posts or sorted.  The join that finds them hashes the one row per user:
    a merge would sort all recommendations, and spill them.  Touched posts, all of them in reach, pass the
    join too: what follows then finds the rows dealt by user, and deals none again.
    """
    last = last_scores(own, length).hint("shuffle_hash")
    return ranked(in_reach(own.unionByName(recommended_scored).join(last, "user_id", "left")), length)


def user_feed_of_neighbours(
    own: DataFrame,
    neighbours: DataFrame,
    liked_scored: DataFrame,
    scores: DataFrame,
    length: int,
) -> DataFrame:
    """:func:`user_feed` without a table of recommendations.

    A recommended post scores the same for everybody, so it is scored where it is
    liked (``liked_scored``), and what it needs comes with the short list of
    neighbours.  Candidates out of reach end in the task that pairs the two; only
    the others are shuffled to drop those already seen.
    """
    liked = liked_scored.select(
        F.col("user_id").alias("similar_user"), "post_id", "feed_score"
    )
    asking = neighbours.select("user_id", "similar_user").join(
        last_scores(own, length), "user_id", "left"
    )
    extra = in_reach(asking.join(liked, "similar_user").drop("similar_user"))
    unseen = extra.join(scores.select("user_id", "post_id"), ["user_id", "post_id"], "left_anti")
    return ranked(own.unionByName(unseen), length)


def feed_for_users(feed: DataFrame, user_ids: Sequence[int]) -> DataFrame:
    """Feeds of the given users; on a stored feed the condition reaches the scan."""
    return feed.where(F.col("user_id").isin(list(user_ids)))


def user_bucket(user_id: Column, buckets: int) -> Column:
    """Which of ``buckets`` folders of a stored feed a user's posts are in."""
    return F.pmod(F.xxhash64(user_id), F.lit(buckets)).cast("int")


def in_user_buckets(feed: DataFrame, buckets: int) -> DataFrame:
    """A feed with the ``user_bucket`` to store it by."""
    return feed.withColumn("user_bucket", user_bucket(F.col("user_id"), buckets))


def feeds_of_users(stored: DataFrame, users: DataFrame, buckets: int) -> DataFrame:
    """Feeds of the users in a table, from a feed stored by ``user_bucket``.

    No id passes the driver.  Where Spark broadcasts the users, being few, their buckets decide
    which folders are read; where they are many, the two sides are joined as usual.  A user listed
    twice counts once, and one without an id or a feed has no rows.
    """
    bucket = user_bucket(F.col("user_id"), buckets)
    asked = users.select("user_id", bucket.alias("user_bucket"))
    # Always true, but only a side with a comparison is considered for pruning.
    asked = asked.where(F.col("user_bucket") >= 0)
    return stored.join(asked, ["user_bucket", "user_id"], "left_semi").select(
        "user_id", "post_id", "feed_score"
    )
