"""One query per operator, over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import feed as feed_ops
from rankflow.operators import neighbours as neighbour_ops
from rankflow.operators import recommend, scoring, serving, signals, similarity, trending
from rankflow.plans.jobs import FeedRun
from rankflow.sources import files, layout, schemas
from rankflow.sources.mappings import EventsInputs, Inputs, OrdersInputs
from rankflow.sources.workspace import Workspace
from rankflow.streaming.activity import ActivityStore

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Weights of actions with the days on which they begin and end.
WEIGHT_PERIODS = (
    ("5-LOW", None, "1996-01-01", 1),
    ("5-LOW", "1996-01-01", None, 2),
    ("3-MEDIUM", None, None, 3),
    ("2-HIGH", "1996-01-01", None, 4),
    ("1-URGENT", "1993-06-01", "1997-06-01", 5),
)

# Buckets of stored tables; a cluster takes as many as make files of some 100 MB.
BUCKETS = 16

# A low limit that makes most posts of the test tables heavy.
_FEW_USERS = {"heavy_post_users": 20, "block_users": 500}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    """Registered queries by name."""
    return dict(_QUERIES)


def _run(inputs: Inputs, **options) -> FeedRun:
    changes = options.pop("changes", {})
    options.setdefault("count_actions", False)
    return FeedRun(inputs.interactions, inputs.posts, inputs.config.but(**changes), **options)


def _orders_scores(spark: SparkSession, folder: str) -> DataFrame:
    i = OrdersInputs(spark, folder)
    return scoring.user_post_scores(i.interactions, i.config.action_weights)


def _orders_pairs(spark: SparkSession, folder: str) -> DataFrame:
    scores = Workspace(spark).keep(_orders_scores(spark, folder), "scores")
    return similarity.pair_dot_products(
        scores, OrdersInputs(spark, folder).config.heavy_post_users
    )


# --- sources and sinks -----------------------------------------------------


@_query
def scan_csv_roundtrip(spark, folder):
    path = Workspace(spark).path("user_post_scores_csv")
    files.write_csv(_orders_scores(spark, folder), path)
    return files.scan_csv(spark, path, schemas.USER_POST_SCORES)


@_query
def scan_csv_inferred(spark, folder):
    path = Workspace(spark).path("trending_csv")
    files.write_csv(_run(OrdersInputs(spark, folder)).trending, path, single_file=True)
    return schemas.conform(files.scan_csv(spark, path), schemas.TRENDING_POSTS)


@_query
def result_freshness(spark, folder):
    names = ("events", "lineitem", "orders", "part", "customer", "nation")
    each = (
        files.result_freshness(spark, f"{folder}/{name}.parquet").select(
            F.lit(name).alias("table_name"), "last_sync"
        )
        for name in names
    )
    return reduce(DataFrame.unionByName, each)


# --- scoring ---------------------------------------------------------------


@_query
def action_scores(spark, folder):
    i = OrdersInputs(spark, folder)
    return scoring.action_scores(i.interactions, i.config.action_weights)


@_query
def user_post_scores(spark, folder):
    return _orders_scores(spark, folder)


@_query
def user_post_scores_events(spark, folder):
    i = EventsInputs(spark, folder)
    return scoring.user_post_scores(i.interactions, i.config.action_weights)


@_query
def matrix_dimensions(spark, folder):
    return scoring.matrix_dimensions(_orders_scores(spark, folder))


@_query
def incremental_activity(spark, folder):
    """Pairs from a stream of the event log that arrives in two parts, merged one after the other."""
    i, place = EventsInputs(spark, folder), Workspace(spark)
    incoming = place.path("incoming")
    store = ActivityStore(spark, place.path("activity"), BUCKETS)
    for rest in (0, 1):
        part = i.dated_interactions.where(F.day("day") % 2 == rest).drop("day")
        part.write.mode("append").parquet(incoming)
        log = spark.readStream.schema(part.schema).parquet(incoming)
        store.absorb(log, i.config.action_weights, i.config.like_action)
        store.merge()
    return store.read()


# --- similarity ------------------------------------------------------------


@_query
def co_interaction_pairs(spark, folder):
    return _orders_pairs(spark, folder).select("user_a", "user_b", "shared_posts")


@_query
def pair_dot_products(spark, folder):
    return _orders_pairs(spark, folder).select("user_a", "user_b", "dot_product")


@_query
def user_magnitudes(spark, folder):
    return similarity.user_magnitudes(_orders_scores(spark, folder))


@_query
def user_similarity(spark, folder):
    return similarity.user_similarity(_orders_pairs(spark, folder))


@_query
def user_similarity_events(spark, folder):
    i = EventsInputs(spark, folder)
    scores = scoring.user_post_scores(i.interactions, i.config.action_weights)
    kept = Workspace(spark).keep(scores, "scores")
    pairs = similarity.pair_dot_products(kept, _FEW_USERS["heavy_post_users"])
    return similarity.user_similarity(pairs)


@_query
def similarity_bidirectional(spark, folder):
    return similarity.bidirectional(similarity.user_similarity(_orders_pairs(spark, folder)))


@_query
def most_similar_pairs(spark, folder):
    return similarity.most_similar_pairs(_run(OrdersInputs(spark, folder)).neighbours, 10)


@_query
def top_similar_users(spark, folder):
    return _run(OrdersInputs(spark, folder)).neighbours


@_query
def top_similar_users_events(spark, folder):
    return _run(EventsInputs(spark, folder)).neighbours


@_query
def top_similar_users_heavy_posts(spark, folder):
    return _run(OrdersInputs(spark, folder), changes=_FEW_USERS).neighbours


@_query
def top_similar_users_heavy_posts_events(spark, folder):
    return _run(EventsInputs(spark, folder), changes=_FEW_USERS).neighbours


@_query
def top_similar_users_of_table(spark, folder):
    config = OrdersInputs(spark, folder).config
    scores = Workspace(spark).keep(_orders_scores(spark, folder), "scores")
    table = similarity.user_similarity(similarity.pair_dot_products(scores, config.heavy_post_users))
    floors = neighbour_ops.least_cosines(scores, config.neighbours)
    return neighbour_ops.top_similar_users(table, config.neighbours, floors)


@_query
def similar_pairs(spark, folder):
    """Pairs with a least cosine, from an index that leaves out what cannot reach it."""
    place = Workspace(spark)
    scores = place.keep(_orders_scores(spark, folder), "scores")
    return similarity.similar_pairs(scores, 0.2, keep=place.keep)


@_query
def similar_pairs_events(spark, folder):
    i = EventsInputs(spark, folder)
    scores = scoring.user_post_scores(i.interactions, i.config.action_weights)
    place = Workspace(spark)
    kept = place.keep(scores, "scores")
    return similarity.similar_pairs(kept, 0.6, _FEW_USERS["heavy_post_users"], place.keep)


@_query
def pairs_sharing_posts(spark, folder):
    place = Workspace(spark)
    scores = place.keep(_orders_scores(spark, folder), "scores")
    return similarity.pairs_sharing(scores, 3, keep=place.keep)


# --- recommendations -------------------------------------------------------


@_query
def neighbour_candidates(spark, folder):
    run = _run(OrdersInputs(spark, folder))
    return recommend.neighbour_candidates(run.neighbours, run.scores)


@_query
def unseen_candidates(spark, folder):
    run = _run(OrdersInputs(spark, folder))
    return recommend.unseen_candidates(run.neighbours, run.scores)


@_query
def recommendations(spark, folder):
    return _run(OrdersInputs(spark, folder)).found_recommendations


@_query
def recommendations_events(spark, folder):
    return _run(EventsInputs(spark, folder)).found_recommendations


# --- trending --------------------------------------------------------------


@_query
def post_counts(spark, folder):
    return trending.post_counts(OrdersInputs(spark, folder).interactions)


@_query
def trending_counts(spark, folder):
    i = OrdersInputs(spark, folder)
    return trending.trending_counts(
        scoring.pair_activity(i.interactions, i.config.action_weights, i.config.like_action)
    )


def _trending(inputs: Inputs, posts: DataFrame) -> DataFrame:
    c = inputs.config
    pairs = scoring.pair_activity(inputs.interactions, c.action_weights, c.like_action)
    return trending.trending_posts(trending.trending_counts(pairs), posts)


@_query
def trending_posts(spark, folder):
    i = OrdersInputs(spark, folder)
    return _trending(i, i.posts)


@_query
def trending_posts_events(spark, folder):
    i = EventsInputs(spark, folder)
    return _trending(i, i.posts)


@_query
def trending_partial_catalogue(spark, folder):
    return _trending(OrdersInputs(spark, folder), EventsInputs(spark, folder).seen_posts)


@_query
def trending_top20(spark, folder):
    i = OrdersInputs(spark, folder)
    return trending.trending_top(_trending(i, i.posts), i.config.trending_length)


@_query
def trending_cards(spark, folder):
    i = OrdersInputs(spark, folder)
    return trending.trending_cards(_trending(i, i.posts), i.config.trending_length)


# --- signals ---------------------------------------------------------------


@_query
def popularity_scores(spark, folder):
    i = OrdersInputs(spark, folder)
    return signals.popularity_scores(trending.post_counts(i.interactions), i.config.decimals)


@_query
def recency_scores(spark, folder):
    i = OrdersInputs(spark, folder)
    return signals.recency_scores(i.posts, i.config.recency_date, i.config.decimals)


@_query
def recency_scores_events(spark, folder):
    i = EventsInputs(spark, folder)
    return signals.recency_scores(i.posts, i.config.recency_date, i.config.decimals)


@_query
def interaction_scores(spark, folder):
    i = OrdersInputs(spark, folder)
    return signals.interaction_scores(_orders_scores(spark, folder), i.config.decimals)


# --- feed ------------------------------------------------------------------


@_query
def feed_candidates(spark, folder):
    return _run(OrdersInputs(spark, folder)).candidates


@_query
def feed_scores(spark, folder):
    return _run(OrdersInputs(spark, folder)).scored


@_query
def feed_best_scores(spark, folder):
    return _run(OrdersInputs(spark, folder)).best


@_query
def feed_from_raw(spark, folder):
    return _run(OrdersInputs(spark, folder)).feed


@_query
def user_feed(spark, folder):
    """From saved scores and saved recommendations."""
    i, saved = OrdersInputs(spark, folder), Workspace(spark)
    first = _run(i)
    scores = saved.keep(first.scores, "user_post_scores")
    recommended = saved.keep(first.found_recommendations, "recommendations")
    return _run(i, scores=scores, recommended=recommended).feed


@_query
def user_feed_events(spark, folder):
    return _run(EventsInputs(spark, folder)).feed


@_query
def feed_without_recs(spark, folder):
    return _run(OrdersInputs(spark, folder), with_recommendations=False).feed


@_query
def feed_missing_signals(spark, folder):
    """A feed of the event log with recommendations from another log.

    Most of them name posts without popularity or date, and some name posts that
    the user has touched.
    """
    foreign = _run(OrdersInputs(spark, folder)).recommendations
    return _run(EventsInputs(spark, folder), recommended=foreign).feed


@_query
def user_feed_bucketed(spark, folder):
    """From saved scores and saved recommendations, all in buckets of (user, post)."""
    i, saved = OrdersInputs(spark, folder), Workspace(spark)
    first = _run(i)
    buckets = layout.enough_buckets(first.scores.count() * first.config.neighbours, BUCKETS)
    scores = saved.keep_bucketed(first.scores, "user_post_scores", ["user_id", "post_id"], buckets)
    pair = ["user_id", "recommended_post_id"]
    recommended = saved.keep_bucketed(first.found_recommendations, "recommendations", pair, buckets)
    return _run(i, scores=scores, recommended=recommended, pair_buckets=buckets).feed


@_query
def unseen_candidates_bucketed(spark, folder):
    """Saved candidates without the posts of a saved matrix, both as arrays in buckets of the user; neither is shuffled."""
    run, saved = _run(OrdersInputs(spark, folder)), Workspace(spark)
    buckets = layout.enough_buckets(run.scores.count() * run.config.neighbours, BUCKETS)
    packed = recommend.packed_posts(run.scores, strengths="total_score")
    posts = saved.keep_bucketed(packed, "posts", recommend.PART, buckets)
    candidates = recommend.packed_candidates(run.neighbours, posts)
    stored = saved.keep_bucketed(candidates, "candidates", recommend.PART, buckets)
    return recommend.unseen_packed(stored, posts)


@_query
def feed_of_user_table(spark, folder):
    """Feeds of the customers in debt, from a feed stored by bucket of the user."""
    i, saved = OrdersInputs(spark, folder), Workspace(spark)
    feed = feed_ops.in_user_buckets(_run(i).feed, BUCKETS)
    stored = saved.keep_partitioned(feed, "feed", "user_bucket", BUCKETS)
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    asked = customers.where("c_acctbal < -900").select(F.col("c_custkey").alias("user_id"))
    return feed_ops.feeds_of_users(stored, asked, BUCKETS)


@_query
def feed_for_users(spark, folder):
    stored = Workspace(spark).keep(_run(OrdersInputs(spark, folder)).feed, "feed")
    return feed_ops.feed_for_users(stored, [1, 2, 3])


# --- serving ---------------------------------------------------------------


def _stored_feed(spark: SparkSession, run: FeedRun) -> DataFrame:
    return Workspace(spark).keep(run.feed, "feed")


@_query
def feed_coverage(spark, folder):
    return serving.feed_coverage(_run(OrdersInputs(spark, folder)).feed)


@_query
def feed_lists(spark, folder):
    """The arrays as text, for comparison with SQL."""
    i = OrdersInputs(spark, folder)
    lists = serving.feed_lists(i.users, _run(i).feed)
    posts = F.transform("feed", lambda e: e["post_id"].cast("string"))
    return lists.select(
        "user_id",
        F.size("feed").cast("bigint").alias("n_posts"),
        F.array_join(posts, ",").alias("recommended_posts"),
    )


@_query
def feed_detailed(spark, folder):
    """The user struct as columns, for comparison with SQL."""
    i = OrdersInputs(spark, folder)
    feed = _stored_feed(spark, _run(i))
    return serving.feed_detailed(feed, i.posts, i.users).select(
        "user_id",
        F.col("user_info.location").alias("location"),
        F.col("user_info.interest").alias("interest"),
        "post_id",
        "feed_score",
        "topic",
        "creator_id",
        "timestamp",
    )


@_query
def feed_detailed_unknown_posts(spark, folder):
    """As served, with ``Unknown`` for whatever a missing post lacks."""
    i, catalogue = OrdersInputs(spark, folder), EventsInputs(spark, folder).seen_posts
    detailed = serving.feed_detailed(_stored_feed(spark, _run(i)), catalogue, i.users)
    served = {
        name: F.coalesce(F.col(name).cast("string"), F.lit("Unknown"))
        for name in ("creator_id", "timestamp")
    }
    return detailed.drop("user_info").withColumns(served)


@_query
def feed_cards(spark, folder):
    return serving.feed_cards(_run(OrdersInputs(spark, folder)).feed)


@_query
def action_histogram(spark, folder):
    return serving.action_histogram(OrdersInputs(spark, folder).interactions)


@_query
def system_stats(spark, folder):
    """The map as text, for comparison with SQL."""
    i = OrdersInputs(spark, folder)
    run = _run(i, count_actions=True)
    stats = run.stats(i.users, _stored_feed(spark, run))
    named = F.transform(
        F.map_entries("actions"),
        lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")),
    )
    return stats.withColumn("actions", F.array_join(F.array_sort(named), ";"))


def _repeated_users(spark: SparkSession, folder: str) -> DataFrame:
    """The customers, and again for each order, with its priority as interest."""
    i = OrdersInputs(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    again = i.users.join(orders, F.col("user_id") == F.col("o_custkey")).select(
        "user_id", "age", "location", F.col("o_orderpriority").alias("interest")
    )
    return i.users.unionByName(again)


def _repeated_posts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts, and again for each order line, with its supplier and day."""
    i = OrdersInputs(spark, folder)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    again = i.posts.select("post_id", "topic").join(
        lines, F.col("post_id") == F.col("l_partkey")
    )
    return i.posts.unionByName(
        again.select(
            "post_id",
            "topic",
            F.col("l_suppkey").alias("creator_id"),
            F.to_date("l_shipdate").alias("timestamp"),
        )
    )


@_query
def user_directory(spark, folder):
    return schemas.one_row_per_key(_repeated_users(spark, folder), "user_id").drop("age")


@_query
def duplicate_posts(spark, folder):
    """Posts listed more than once in a catalogue."""
    return schemas.duplicate_keys(_repeated_posts(spark, folder), "post_id")


@_query
def post_directory(spark, folder):
    return schemas.one_row_per_key(_repeated_posts(spark, folder), "post_id")


@_query
def feed_duplicate_posts(spark, folder):
    """A feed whose catalogue lists posts many times."""
    i = OrdersInputs(spark, folder)
    return FeedRun(i.interactions, _repeated_posts(spark, folder), i.config).feed


@_query
def neighbour_products(spark, folder):
    """What each user has in common with its closest users."""
    run = _run(OrdersInputs(spark, folder))
    edges = run.neighbours.select(
        F.least("user_id", "similar_user").alias("user_a"),
        F.greatest("user_id", "similar_user").alias("user_b"),
    )
    return similarity.edge_products(edges, run.scores)


@_query
def run_counts(spark, folder):
    return _run(OrdersInputs(spark, folder)).counts


@_query
def action_scores_by_period(spark, folder):
    """Weights as a table: they changed at the turn of 1996, and one action had none before."""
    rows = [(a, w, f, t) for a, f, t, w in WEIGHT_PERIODS]
    weights = spark.createDataFrame(rows, "action string, weight int, valid_from string, valid_to string")
    dated = weights.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    scored = scoring.action_scores_by_period(OrdersInputs(spark, folder).dated_interactions, dated)
    return scored.groupBy("user_id", "post_id").agg(F.sum("score").alias("total_score"))


@_query
def approximate_users(spark, folder):
    """Users per post from daily sketches, stored and merged, next to the exact number."""
    i = EventsInputs(spark, folder)
    daily = trending.user_sketches(i.dated_interactions, "day")
    merged = trending.users_of_sketches(Workspace(spark).keep(daily, "user_sketches"))
    exact = trending.trending_counts(
        scoring.pair_activity(i.interactions, i.config.action_weights, i.config.like_action)
    )
    off = F.abs(F.col("approx_users") - F.col("unique_users"))
    return merged.join(exact.select("post_id", "unique_users"), "post_id").select(
        "post_id", "total_interactions", "unique_users", (off <= 0.1 * F.col("unique_users")).alias("within_a_tenth")
    )


@_query
def directory_last_wins(spark, folder):
    """The orders as a table of users listed again and again: the last row of the files counts."""
    orders = files.scan_in_order(spark, f"{folder}/orders.parquet")
    listed = orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("interest"), "o_orderkey", *files.POSITION
    )
    return schemas.last_row_per_key(listed, "user_id", files.POSITION)


def _planted_csv(spark, folder):
    """The posts as CSV, with a date that is none, or a creator that is none, in some lines."""
    posts = OrdersInputs(spark, folder).posts
    key = F.col("post_id") % 50
    planted = posts.select(
        "post_id",
        "topic",
        F.when(key == 7, "nobody").otherwise(F.col("creator_id").cast("string")).alias("creator_id"),
        F.when(key == 3, "1995-02-30").when(key == 11, "soon").otherwise(F.col("timestamp").cast("string")).alias("timestamp"),
    )
    path = Workspace(spark).path("planted_csv")
    files.write_csv(planted, path)
    return files.scan_csv_checked(spark, path, schemas.POSTS)


@_query
def csv_rows_accepted(spark, folder):
    return _planted_csv(spark, folder)[0]


@_query
def csv_rows_rejected(spark, folder):
    return files.rejects_by_reason(_planted_csv(spark, folder)[1])
