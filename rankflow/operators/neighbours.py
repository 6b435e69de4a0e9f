"""The K closest users of every user, exactly, without listing all pairs of a hot post.

Posts fall into two classes by audience.

*Light* posts (at most ``heavy_post_users`` users, and larger ones that are cheaper so) form an inverted index: one row per
post with all its users.  Users are dealt into *cells*, and a post's row goes to each cell
that has a user of it, so a cell holds every product of its users over light posts.  It sums
them and hands on K rows per user; no row per pair of users is ever shuffled or sorted.
Cells are as many as the products ask for, and a user with more than fit in one is
compared part by part.

*Heavy* posts are compared as short vectors, one per user.  Two facts keep that
small without losing a neighbour:

1. Take users with the same heavy vector.  To anybody who shares only heavy posts
   with them they have one dot product, so they rank by squared norm, then id (or
   by id alone, where the dot product is 0).  Only the first K + 1 in either order
   can be among K neighbours; these *representatives* stand for the group.
2. Blocks of users are multiplied with blocks of representatives inside a task,
   which hands on K rows per user.  No row per pair, let alone per pair and post,
   is ever built.  Users whose light posts promise more than their heavy posts can
   give are not compared at all.

A pair with light and heavy posts in common is exact in the first class and too
low in the second.  Taking the larger value repairs it: whoever outranks a
neighbour by a value that is too low outranks it by the true one.

That, and the floors of the first class, need products that are not negative.  So
where any post is heavy and any score is negative, all posts count as heavy: vectors are
then whole and the second class is exact alone.  Without heavy posts the first is.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rankflow.config import DEFAULT_NEIGHBOURS
from rankflow.functions import cosine, top_per_group
from rankflow.functions.blocks import cell_neighbours, index_neighbours
from rankflow.operators.cells import CELL_PRODUCTS, _cells, packed_cells  # noqa: F401
from rankflow.operators.levels import level, levels, with_level
from rankflow.operators.similarity import bidirectional, post_audience, with_norms

# Room for the last bits in which a floor and a cosine are rounded differently.
_ROUNDING_SLACK = 1.0 - 1e-9
#: Blocks of users that vectors are dealt to, at most: each block of one side meets each of the other.
MOST_BLOCKS = 32
_CANDIDATES = "user_id bigint, similar_user bigint, cosine_similarity double"


def closest_first() -> list:
    """Ranking of neighbours; equal cosines go by user id."""
    return [F.desc("cosine_similarity"), F.asc("similar_user")]


def top_similar_users(similarity: DataFrame, k: int, floors: DataFrame | None = None) -> DataFrame:
    """The K closest users per user from a similarity table.

    ``floors``, if given, has a ``floor`` for every user of the table, as :func:`least_cosines` finds
    it.  Edges below go where the table is read, by levels of hashed cells of users: only the others
    are sorted and shuffled.
    """
    edges = bidirectional(similarity)
    if floors is not None:
        of_users = levels(floors.select("user_id", _cosine_level("floor").alias("level")), "user_id", F.min)
        reached = _cosine_level("cosine_similarity") >= F.coalesce("needed", F.lit(0))
        edges = with_level(edges, of_users, "user_id", "needed").where(reached).drop("needed")
    return top_per_group(edges, ["user_id"], closest_first(), k)


def _cosine_level(name: str) -> Column:
    """The level of a cosine; roots tell small ones apart."""
    return level(F.sqrt(F.greatest(F.col(name), F.lit(0.0))))


def least_cosines(scores: DataFrame, k: int) -> DataFrame:
    """``user_id, floor``: a value that the K-th best cosine of a user with any cosine is not below, from the scores alone.

    As in :func:`_light_users`, and 0 for all where a score is negative.  Scores have one row per pair.
    """
    signed = F.coalesce(scores.agg((F.min("total_score") < 0).alias("signed")).scalar(), F.lit(False))
    rows = with_norms(scores).where("norm2 > 0 and post_id is not null")
    return _light_users(rows, k).select("user_id", F.when(signed, F.lit(0.0)).otherwise(F.col("floor")).alias("floor"))


def vector_posts(
    scores: DataFrame,
    heavy_post_users: int,
    k: int = DEFAULT_NEIGHBOURS,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Posts to compare as vectors, among those of more than ``heavy_post_users`` users; all posts where there are such and a score is negative.

    Large posts go by tiers of four times the audience.  From that tier on they are vectors where
    the work is least: the products of an index of the rest, and the users of the tier times those
    who can stand for them, each pair costing more the more posts there are.
    """
    signed = scores.agg((F.min("total_score") < 0).alias("signed")).scalar()
    audience = post_audience(scores)
    is_large = F.col("n_users") > heavy_post_users
    tier = F.floor(F.log(F.col("n_users") / max(heavy_post_users, 1)) / math.log(4)).cast("int")
    large = keep(audience.where(is_large).withColumn("tier", tier), "large_posts")
    upward = F.explode(F.sequence(F.lit(0), F.col("tier")))
    posts = large.withColumn("products", F.col("n_users") * F.col("n_users").cast("double"))
    indexed = posts.select("products", upward.alias("tier")).groupBy("tier")
    work = indexed.agg(F.sum("products").alias("products"), F.count(F.lit(1)).alias("n_posts"))
    touched = scores.join(large.select("post_id", "tier"), "post_id").select(
        "user_id", F.xxhash64("post_id", "total_score").alias("entry"), upward.alias("tier")
    )
    vectors = touched.groupBy("tier", "user_id").agg(F.bit_xor("entry").alias("vector"))
    counted = vectors.groupBy("tier").agg(
        F.count(F.lit(1)).cast("double").alias("n_users"),
        F.approx_count_distinct("vector").alias("kinds"),
    )
    stand_ins = F.least(F.col("n_users"), 2.0 * (k + 1) * F.col("kinds"))
    spared = F.col("products") - F.col("n_users") * stand_ins * (0.1 + F.col("n_posts") / 1024)
    best = work.join(counted, "tier").select("tier", spared.alias("spared")).where("spared > 0")
    from_tier = best.agg(F.min_by("tier", F.struct(-F.col("spared"), "tier"))).scalar()
    chosen = is_large & (tier >= from_tier)
    signed_and_any = F.coalesce(signed, F.lit(False)) & from_tier.isNotNull()
    return audience.where(F.coalesce(chosen, F.lit(False)) | signed_and_any)


def nearest_users(
    scores: DataFrame,
    k: int,
    *,
    heavy: DataFrame,
    block_users: int = 2048,
    cell_products: int = CELL_PRODUCTS,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """The K closest users per user, straight from the score matrix.

    ``heavy`` lists the posts to treat as vectors, by ``post_id``, as
    :func:`vector_posts` finds them.  ``keep`` may store an intermediate table that
    is read more than once.
    """
    # A user without length has no similarity to anybody.  Stored, since both classes of posts read it.
    counts = scores.groupBy("user_id").agg(
        F.sum(F.col("total_score") * F.col("total_score")).alias("norm2"), F.count(F.lit(1)).alias("n_posts")
    )
    rows = scores.select("user_id", "post_id", "total_score").join(counts.where("norm2 > 0"), "user_id")
    normed = keep(rows, "normed")
    heavy = heavy.select("post_id")
    vectors = keep(_heavy_vectors(normed.join(heavy, "post_id", "left_semi")), "heavy_vectors")
    chosen = keep(_representatives(vectors, k), "representatives")
    light = normed.join(heavy, "post_id", "left_anti")
    users = keep(_light_users(_near_vectors(light, vectors, keep), k), "light_users")
    by_light = top_per_group(
        _light_edges(light, users, vectors, k, keep, cell_products), ["user_id"], closest_first(), k
    )
    by_heavy = _blockwise_neighbours(_asking(vectors, users), chosen, k, block_users)
    merged = (
        by_light.unionByName(by_heavy)
        .groupBy("user_id", "similar_user")
        .agg(F.max("cosine_similarity").alias("cosine_similarity"))
    )
    return top_per_group(merged, ["user_id"], closest_first(), k)


def nearest_users_any(
    scores: DataFrame,
    k: int,
    *,
    heavy_post_users: int,
    block_users: int = 2048,
    cell_products: int = CELL_PRODUCTS,
) -> DataFrame:
    """:func:`nearest_users` with the heavy posts found in the same lazy plan."""
    heavy = vector_posts(scores, heavy_post_users, k)
    return nearest_users(scores, k, heavy=heavy, block_users=block_users, cell_products=cell_products)


# --- light posts -----------------------------------------------------------


def _near_vectors(
    rows: DataFrame,
    vectors: DataFrame,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """The light scores of all users of posts that a user with a heavy vector has touched: what floors need."""
    posts = rows.join(vectors.select("user_id"), "user_id", "left_semi").select("post_id").distinct()
    # Stored, so that Spark sees where there are none before it shuffles all rows for the join.
    posts = keep(posts, "near_posts")
    return rows.join(posts, "post_id", "left_semi")


def _light_users(rows: DataFrame, k: int) -> DataFrame:
    """Users with their squared norm and a value their K-th best cosine cannot be below.

    The share of one post in a cosine is the product of two unit weights, and the
    rest of the sum is not negative.  So if the (K + 1)-th largest unit weight on a
    post is ``m``, each user of the post with unit weight ``w`` has K neighbours at
    ``w * m`` or above; the best of its posts gives the floor.  A task meets only
    some pairs of a user, often fewer than K, and could drop nothing without it.
    """
    unit = F.col("total_score") / F.sqrt("norm2")
    audience = Window.partitionBy("post_id").orderBy(F.desc("unit_weight"))
    whole = audience.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = F.max(F.col("unit_weight") * F.col("follower"))
    return (
        rows.select("user_id", "norm2", "post_id", unit.alias("unit_weight"))
        .withColumn("follower", F.nth_value("unit_weight", k + 1).over(whole))
        .groupBy("user_id", "norm2")
        .agg((F.coalesce(best, F.lit(0.0)) * _ROUNDING_SLACK).alias("floor"))
    )


def _index(rows: DataFrame) -> DataFrame:
    """One row per light post: its users with score, squared norm, number of posts, and whether they have a heavy vector."""
    if "n_posts" not in rows.columns:
        rows = rows.join(rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_posts")), "user_id")
    entry = F.struct("user_id", "total_score", "norm2", "n_posts", "has_vector")
    return (
        rows.groupBy("post_id")
        .agg(F.collect_list(entry).alias("found"))
        .withColumn("n_users", F.size("found").cast("bigint"))
    )


def _light_edges(
    rows: DataFrame,
    floors: DataFrame,
    vectors: DataFrame,
    k: int,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    cell_products: int = CELL_PRODUCTS,
) -> DataFrame:
    """Edges over light posts that may be among a user's K best, cosines exact.

    ``rows`` are light scores with ``norm2``, and ``n_posts`` where it is known.  What a pair has in common in heavy posts is added.
    Only where both users have a vector is there anything to add, so only those pairs leave
    their cell before they are ranked, and only from the user's floor on.
    """
    has_vector = vectors.select("user_id", F.lit(True).alias("has_vector"))
    marked = rows.join(has_vector, "user_id", "left").fillna(False, ["has_vector"])
    kind = "bigint" if isinstance(rows.schema["total_score"].dataType, IntegralType) else "double"
    schema = f"{_CANDIDATES}, norm2 double, similar_norm2 double, dot {kind}, whole boolean"
    found = keep(
        packed_cells(keep(_index(marked), "light_posts"), cell_products)
        .groupBy("cell", "part")
        .applyInArrow(index_neighbours(k), schema),
        "light_edges",
    )
    entries = F.arrays_zip("posts", "weights")
    of_user = vectors.select("user_id", F.map_from_arrays("posts", "weights").alias("vector"))
    of_other = vectors.select(F.col("user_id").alias("similar_user"), entries.alias("other"))
    heavy_dot = F.aggregate(
        "other",
        F.lit(0).cast(kind),
        lambda total, e: total + e["weights"] * F.coalesce(F.try_element_at("vector", e["posts"]), F.lit(0)),
    )
    value = cosine(F.col("dot") + heavy_dot, F.col("norm2"), F.col("similar_norm2"))
    completed = (
        found.where(~F.col("whole"))
        .join(of_user, "user_id")
        .join(of_other, "similar_user")
        .join(floors.select("user_id", "floor"), "user_id", "left")
        .withColumn("cosine_similarity", value)
        .where(F.col("floor").isNull() | (F.col("cosine_similarity") >= F.col("floor")))
    )
    edge = ["user_id", "similar_user", "cosine_similarity"]
    return found.where("whole").select(*edge).unionByName(completed.select(*edge))


# --- heavy posts -----------------------------------------------------------


def _heavy_vectors(rows: DataFrame) -> DataFrame:
    """One row per user: its heavy posts in order, their scores, the squared norm.

    A vector is no longer than the list of heavy posts.
    """
    entries = F.array_sort(F.collect_list(F.struct("post_id", "total_score")))
    return (
        rows.groupBy("user_id", "norm2")
        .agg(
            entries.alias("entries"),
            F.sum(F.col("total_score") * F.col("total_score")).alias("heavy_norm2"),
        )
        .select(
            "user_id",
            "norm2",
            "heavy_norm2",
            F.col("entries.post_id").alias("posts"),
            F.col("entries.total_score").alias("weights"),
        )
    )


def _asking(vectors: DataFrame, users: DataFrame) -> DataFrame:
    """The vectors of users that heavy posts alone can give a neighbour.

    By Cauchy and Schwarz such a neighbour has a cosine of at most the length of the
    user's heavy part over that of the whole.  Whose floor from light posts lies above
    that needs no comparison of vectors.
    """
    floors = users.select("user_id", "floor")
    reach = F.sqrt(F.col("heavy_norm2") / F.col("norm2"))
    known = vectors.join(floors, "user_id", "left")
    return known.where(F.col("floor").isNull() | (reach >= F.col("floor"))).drop("floor")


def _representatives(vectors: DataFrame, k: int) -> DataFrame:
    """The users that can be a neighbour by heavy posts alone."""
    same_vector = ["posts", "weights"]
    by_norm = top_per_group(vectors, same_vector, [F.asc("norm2"), F.asc("user_id")], k + 1)
    by_id = top_per_group(vectors, same_vector, [F.asc("user_id")], k + 1)
    return by_norm.unionByName(by_id).dropDuplicates(["user_id"])


def _blockwise_neighbours(
    vectors: DataFrame, chosen: DataFrame, k: int, block_users: int
) -> DataFrame:
    """K candidates per user and block of representatives.

    A vector is shuffled once per block of the other side, so blocks of ``block_users`` users grow
    where there would be more than ``MOST_BLOCKS`` of them; a task goes through a block in strips.
    """

    def n_blocks(df: DataFrame):
        count = df.agg(F.count(F.lit(1))).scalar()
        blocks = F.least(F.ceil(count / block_users), F.lit(MOST_BLOCKS))
        return F.greatest(blocks.cast("int"), F.lit(1))

    def in_cells(df: DataFrame, own: str, other: str, n_own, n_other) -> DataFrame:
        return df.select(
            *(F.col(name).alias(name) for name in df.columns),
            F.pmod(F.xxhash64("user_id"), n_own).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), n_other - 1)).alias(other),
        )

    n_users, n_chosen = n_blocks(vectors), n_blocks(chosen)
    users = in_cells(vectors, "user_block", "chosen_block", n_users, n_chosen)
    others = in_cells(chosen, "chosen_block", "user_block", n_chosen, n_users)
    cell = ["user_block", "chosen_block"]
    return users.groupBy(*cell).cogroup(others.groupBy(*cell)).applyInArrow(
        cell_neighbours(k), _CANDIDATES
    )
