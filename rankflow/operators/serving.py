"""Tables to serve feeds and to watch the jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.operators.feed import best_first
from rankflow.sources.schemas import one_row_per_key

_ENTRIES = "array<struct<post_id: bigint, feed_score: double>>"


def feed_lists(users: DataFrame, feed: DataFrame) -> DataFrame:
    """One row per user with the feed as an ordered array; empty where there is none.

    An array is as long as a feed at most.  Users who only occur in the feed keep
    their row.
    """
    entries = F.collect_list(F.struct((-F.col("feed_score")).alias("order"), "post_id"))
    lists = feed.groupBy("user_id").agg(F.array_sort(entries).alias("entries"))
    served = F.transform(
        "entries",
        lambda e: F.struct(e["post_id"].alias("post_id"), (-e["order"]).alias("feed_score")),
    )
    return (
        users.select("user_id")
        .join(lists, "user_id", "full")
        .select("user_id", F.coalesce(served, F.array().cast(_ENTRIES)).alias("feed"))
    )


def feed_detailed(feed: DataFrame, posts: DataFrame, users: DataFrame) -> DataFrame:
    """The feed with post metadata and a struct of user attributes.

    A post or user listed more than once counts once, so the feed keeps its rows.
    Unknown topics read ``Unknown``; the typed columns of an unknown post are NULL,
    as is the struct of an unknown user.
    """
    listed = one_row_per_key(users.select("user_id", "age", "location", "interest"), "user_id")
    info = listed.select(
        "user_id", F.struct("user_id", "age", "location", "interest").alias("user_info")
    )
    catalogue = one_row_per_key(
        posts.select("post_id", "topic", "creator_id", "timestamp"), "post_id"
    )
    return (
        feed.join(catalogue, "post_id", "left")
        .join(info, "user_id", "left")
        .select(
            "user_id",
            "user_info",
            "post_id",
            "feed_score",
            F.coalesce("topic", F.lit("Unknown")).alias("topic"),
            "creator_id",
            "timestamp",
        )
    )


def feed_cards(feed: DataFrame) -> DataFrame:
    """Place in the feed and score relative to the user's best.

    The windows run over a finished feed, a bounded number of rows per user.
    """
    user = Window.partitionBy("user_id")
    best, score = F.max("feed_score").over(user), F.col("feed_score")
    return feed.select(
        "user_id",
        F.row_number().over(user.orderBy(*best_first())).alias("place"),
        "post_id",
        "feed_score",
        F.when(best > 0, score / best * 100).otherwise(0.0).alias("relative_score"),
    )


def action_histogram(interactions: DataFrame) -> DataFrame:
    """Interactions per action."""
    return interactions.groupBy("action").agg(F.count(F.lit(1)).alias("n_interactions"))


def feed_coverage(feed: DataFrame) -> DataFrame:
    """Entries and users of the feed, as one row.

    Counted per user first: two small aggregates, no expansion for a distinct count.
    """
    per_user = feed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_entries"), F.count("user_id").alias("n_users")
    )


def _count(df: DataFrame):
    return df.agg(F.count(F.lit(1))).scalar()


def actions_of_pairs(pairs: DataFrame) -> DataFrame:
    """Interactions per action, from the counts that ``pair_activity_by_action`` keeps."""
    each = pairs.select(F.inline("actions"))
    return each.groupBy("action").agg(F.sum("n").alias("n_interactions"))


def system_stats(
    users: DataFrame, feed: DataFrame, trending: DataFrame, interactions: DataFrame
) -> DataFrame:
    """:func:`system_stats_of` with the histogram taken from the log."""
    return system_stats_of(users, feed, trending, action_histogram(interactions))


def system_stats_of(
    users: DataFrame, feed: DataFrame, trending: DataFrame, histogram: DataFrame
) -> DataFrame:
    """Size of each table and the histogram of actions as a map, as one row.

    A missing action counts under the empty name.
    """
    named = F.coalesce("action", F.lit("")).alias("action")
    actions = histogram.groupBy(named).agg(F.sum("n_interactions").alias("n_interactions"))
    entries = F.collect_list(F.struct("action", "n_interactions"))
    return actions.agg(
        F.coalesce(F.sum("n_interactions"), F.lit(0)).alias("total_interactions"),
        F.map_from_entries(F.array_sort(entries)).alias("actions"),
    ).select(
        _count(users.select("user_id").distinct()).alias("total_users"),
        _count(feed.select("user_id").distinct()).alias("users_with_feeds"),
        _count(trending).alias("total_trending_posts"),
        "total_interactions",
        "actions",
    )


def run_counts(
    pairs: DataFrame, neighbours: DataFrame, recommended: DataFrame, observed: Mapping[str, int] | None = None
) -> DataFrame:
    """How far each step reduces or expands the data, as one row.

    ``observed`` gives what was counted when the pairs were written, by the names
    ``n_interactions`` and ``rows``; without it they are read again.
    """
    if observed is None:
        first = pairs.agg(
            F.coalesce(F.sum("n_interactions"), F.lit(0)).alias("n_interactions"),
            F.count(F.lit(1)).alias("n_pairs"),
        )
    else:
        first = pairs.sparkSession.range(1).select(
            F.lit(observed["n_interactions"] or 0).cast("bigint").alias("n_interactions"),
            F.lit(observed["rows"]).cast("bigint").alias("n_pairs"),
        )
    return first.select(
        "n_interactions",
        "n_pairs",
        _count(neighbours.select("user_id").distinct()).alias("n_users_with_neighbours"),
        _count(recommended).alias("n_recommendations"),
    )
