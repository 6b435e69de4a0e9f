"""The four batch jobs: scoring, trending, collaborative filtering and the feed.

A job writes the tables it reads again to the shared work folder (see
:class:`rankflow.sources.workspace.Workspace`); all else stays one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.config import FeedConfig
from rankflow.functions import weighted_feed_score
from rankflow.operators import feed as feed_ops
from rankflow.operators import neighbours as neighbour_ops
from rankflow.operators import recommend, scoring, serving, signals, trending
from rankflow.sources import schemas
from rankflow.sources.workspace import Workspace


class FeedRun:
    """One run over one log.

    Every property is a DataFrame, built at first use.  ``pairs`` is written once
    and feeds all the rest, so the log is scanned and shuffled a single time.
    Saved ``scores`` or ``recommended`` tables may be passed in place of being
    computed; ``with_recommendations=False`` ranks touched posts only.  Tables are
    checked on entry: a missing column or a type that would lose values raises
    before any job starts.  A post listed more than once counts once, and of several
    saved scores of one pair the greatest.  With ``pair_buckets`` the matrix is stored in
    that many buckets of (user, post), so that no join with it on the pair shuffles it.
    ``count_actions=False`` leaves the numbers of actions out of ``pairs``, and with them a
    grouping: for runs that are not asked for their ``stats``.
    """

    def __init__(
        self,
        interactions: DataFrame,
        posts: DataFrame,
        config: FeedConfig,
        *,
        scores: DataFrame | None = None,
        recommended: DataFrame | None = None,
        with_recommendations: bool = True,
        pair_buckets: int | None = None,
        count_actions: bool = True,
        workspace: Workspace | None = None,
    ):
        self.interactions = schemas.require(interactions, schemas.INTERACTIONS)
        self.posts = schemas.one_row_per_key(schemas.require(posts, schemas.POSTS), "post_id")
        self.config = config
        self._scores = scores
        if scores is not None:
            self._scores = schemas.require(scores, schemas.USER_POST_SCORES)
        self._recommended = recommended
        if recommended is not None:
            pair = ("user_id", "recommended_post_id")
            self._recommended = schemas.require(recommended, schemas.RECOMMENDATIONS, pair)
        self._with_recommendations = with_recommendations
        self._pair_buckets = pair_buckets
        self._count_actions = count_actions
        self._workspace = workspace or Workspace(interactions.sparkSession)

    @cached_property
    def pairs(self) -> DataFrame:
        """Activity per (user, post), stored, and its size counted at the write."""
        c = self.config
        activity = scoring.pair_activity_by_action if self._count_actions else scoring.pair_activity
        pairs = activity(self.interactions, c.action_weights, c.like_action)
        return self._workspace.keep(pairs, "pairs", n_interactions=F.sum("n_interactions"))

    @property
    def observed(self) -> dict[str, dict[str, int]]:
        """What was counted of the stored tables as they were written, by table."""
        return self._workspace.observed

    @cached_property
    def action_histogram(self) -> DataFrame:
        """Interactions per action, from the stored pairs, or the log where they do not have them."""
        if not self._count_actions:
            return serving.action_histogram(self.interactions)
        return serving.actions_of_pairs(self.pairs)

    @cached_property
    def counts(self) -> DataFrame:
        """How far each step reduces or expands the data, as one row."""
        pairs = self.pairs
        return serving.run_counts(pairs, self.neighbours, self.found_recommendations, self.observed["pairs"])

    def stats(self, users: DataFrame, feed: DataFrame) -> DataFrame:
        """Size of the tables and the histogram of actions; the log is not read again."""
        return serving.system_stats_of(users, feed, self.trending, self.action_histogram)

    @cached_property
    def scores(self) -> DataFrame:
        """Score matrix: the given one, or that of the log."""
        pair = ["user_id", "post_id"]
        if self._scores is None:
            matrix = self.pairs.select(*pair, "total_score")
            if self._pair_buckets is None:
                return matrix
        else:
            matrix = self._scores.groupBy(*pair).agg(F.max("total_score").alias("total_score"))
        if self._pair_buckets is None:
            return self._workspace.keep(matrix, "scores")
        return self._workspace.keep_bucketed(matrix, "scores", pair, self._pair_buckets)

    @cached_property
    def heavy_posts(self) -> DataFrame:
        """Posts compared as vectors, stored."""
        c = self.config
        keep = self._workspace.keep
        heavy = neighbour_ops.vector_posts(self.scores, c.heavy_post_users, c.neighbours, keep)
        return self._workspace.keep(heavy, "heavy_posts")

    @cached_property
    def neighbours(self) -> DataFrame:
        """Closest users per user, stored: the costly step, with a short result."""
        nearest = neighbour_ops.nearest_users(
            self.scores,
            self.config.neighbours,
            heavy=self.heavy_posts,
            block_users=self.config.block_users,
            keep=self._workspace.keep,
        )
        return self._workspace.keep(nearest, "neighbours")

    @cached_property
    def recommendations(self) -> DataFrame:
        """Unseen posts of the closest users: the given table, or computed and stored, as a feed reads it twice."""
        if self._recommended is not None:
            return self._recommended
        return self._workspace.keep(self.found_recommendations, "recommendations")

    @property
    def found_recommendations(self) -> DataFrame:
        """:attr:`recommendations` as they are found, for those who write or count them once."""
        if self._recommended is not None:
            return self._recommended
        return recommend.recommendations(self.neighbours, self.scores, self.config.decimals)

    @cached_property
    def trending(self) -> DataFrame:
        """Activity per known post."""
        return trending.trending_posts(trending.trending_counts(self.pairs), self.posts)

    @cached_property
    def popularity(self) -> DataFrame:
        """Popularity signal, from the stored pairs."""
        counts = trending.trending_counts(self.pairs).withColumnRenamed(
            "total_interactions", "n_interactions"
        )
        return signals.popularity_scores(counts, self.config.decimals)

    @cached_property
    def recency(self) -> DataFrame:
        """Recency signal."""
        return signals.recency_scores(self.posts, self.config.recency_date, self.config.decimals)

    @cached_property
    def interaction_scores(self) -> DataFrame:
        """Interaction signal."""
        return signals.interaction_scores(self.scores, self.config.decimals)

    @cached_property
    def post_signals(self) -> DataFrame:
        """Popularity and recency of each post, stored: one row per post."""
        both = signals.post_signals(self.popularity, self.recency)
        return self._workspace.keep(both, "post_signals")

    @cached_property
    def _touched(self) -> DataFrame:
        return feed_ops.touched(self.interaction_scores)

    @property
    def _recommended_rows(self) -> DataFrame:
        return feed_ops.recommended(self._recommended, self.config.recommended_base_score)

    def _score(self, rows: DataFrame, post_signals: DataFrame | None = None) -> DataFrame:
        c = self.config
        weights = (c.interaction_weight, c.popularity_weight, c.recency_weight)
        candidates = feed_ops.feed_candidates(rows, post_signals or self.post_signals)
        return feed_ops.feed_scores(candidates, weights, c.decimals)

    def _liked(self, score: Callable[[DataFrame], DataFrame], among: Column | bool = True) -> DataFrame:
        """What users have touched, as ``score`` makes it of a recommended post."""
        base = F.lit(self.config.recommended_base_score).alias("interaction_score")
        return score(self.scores.where(F.lit(True) & among).select("user_id", "post_id", base))

    def _signalled(self, rows: DataFrame) -> DataFrame:
        return feed_ops.feed_candidates(rows, self.post_signals)

    @property
    def _scores_of_posts(self) -> tuple[DataFrame, Column]:
        """The score of each post with signals as a recommended one, and that of a post without."""
        c, nothing = self.config, F.lit(0.0)
        weights = (c.interaction_weight, c.popularity_weight, c.recency_weight)
        base = F.lit(c.recommended_base_score)
        known = self.post_signals.select(
            F.lit(None).cast("bigint").alias("user_id"),
            "post_id",
            base.alias("interaction_score"),
            *(F.coalesce(name, nothing).alias(name) for name in ("popularity_score", "recency_score")),
        )
        least = weighted_feed_score(base, nothing, nothing, weights=weights, decimals=c.decimals)
        return feed_ops.feed_scores(known, weights, c.decimals), least

    @cached_property
    def candidates(self) -> DataFrame:
        """All candidates of all users with their signals."""
        own = self._signalled(self._touched)
        if not self._with_recommendations:
            return own
        if self._recommended is not None:
            return own.unionByName(self._signalled(self._recommended_rows))
        liked = self._liked(self._signalled)
        extra = recommend.unseen_with(self.neighbours, liked, "popularity_score", "recency_score")
        base = F.lit(self.config.recommended_base_score)
        return own.unionByName(extra.withColumn("interaction_score", base))

    def _unseen_scored(self, among: Column | bool = True) -> DataFrame:
        """Recommended posts with their blended score, which they get where they are liked."""
        return recommend.unseen_with(self.neighbours, self._liked(self._score, among), "feed_score")

    @cached_property
    def scored(self) -> DataFrame:
        """All candidates with their blended score."""
        own = self._score(self._touched)
        if not self._with_recommendations:
            return own
        if self._recommended is not None:
            return own.unionByName(self._score(self._recommended_rows))
        return own.unionByName(self._unseen_scored())

    @cached_property
    def best(self) -> DataFrame:
        """The best score of each (user, post).

        What is recommended here has one row per pair and was not touched, so only rows without a
        post can meet, and only they are grouped.
        """
        if self._recommended is not None or not self._with_recommendations:
            return feed_ops.best_scores(self.scored)
        own, no_post = self._score(self._touched), F.col("post_id").isNull()
        met = own.where(no_post).unionByName(self._unseen_scored(no_post))
        known = own.where(~no_post).unionByName(self._unseen_scored(~no_post))
        return known.unionByName(feed_ops.best_scores(met))

    @cached_property
    def touched_feed(self) -> DataFrame:
        """The ranked feed of touched posts, stored."""
        own = feed_ops.touched_feed(self._score(self._touched), self.config.feed_length)
        return self._workspace.keep(own, "touched_feed")

    @cached_property
    def feed(self) -> DataFrame:
        """The ranked feed."""
        length = self.config.feed_length
        if not self._with_recommendations:
            return self.touched_feed
        if self._recommended is not None:
            rows = feed_ops.maybe_in_reach(
                self._recommended_rows, *self._scores_of_posts, self.touched_feed, length
            )
            extra = self._score(rows, self.post_signals.hint("shuffle_hash"))
            return feed_ops.user_feed(self.touched_feed, extra, length)
        return feed_ops.user_feed_of_neighbours(
            self.touched_feed, self.neighbours, self._liked(self._score), self.scores, length
        )
