"""Unseen posts of close users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType

from rankflow.functions import spread
from rankflow.functions.unseen import unseen_beside, unseen_posts

_PAIR = ["user_id", "recommended_post_id"]
#: Key of tables of posts as arrays.
PART = ["user_id", "part"]
#: Posts of a user in one array, about, and parts that all users' posts are dealt to, at most.
PART_POSTS = 4096
MOST_PARTS = 64


def neighbour_candidates(neighbours: DataFrame, scores: DataFrame) -> DataFrame:
    """Every post of every neighbour, with the neighbour's score for it."""
    liked = scores.select(
        F.col("user_id").alias("similar_user"),
        F.col("post_id").alias("recommended_post_id"),
        F.col("total_score").alias("sim_user_score"),
    )
    return neighbours.join(liked, "similar_user").select(
        *_PAIR, "cosine_similarity", "sim_user_score"
    )


def unseen(candidates: DataFrame, scores: DataFrame) -> DataFrame:
    """Candidates whose post the user has not touched.

    A pair in the matrix counts as seen even with score 0.
    """
    seen = scores.select("user_id", F.col("post_id").alias("recommended_post_id"))
    return candidates.join(seen, _PAIR, "left_anti")


def merge_candidates(candidates: DataFrame, decimals: int) -> DataFrame:
    """One row per (user, post): mean similarity and summed score of its neighbours."""
    return candidates.groupBy(*_PAIR).agg(
        F.round(F.avg("cosine_similarity"), decimals).alias("avg_similarity"),
        F.sum("sim_user_score").alias("recommendation_strength"),
    )


def packed_posts(scores: DataFrame, **values: str) -> DataFrame:
    """``user_id, part, posts`` and a column per name in ``values``: what a user has of each as arrays, in order of the post.

    A user with very many posts has them in parts, dealt by the post and alike for all users.  Rows
    without a user are left out: they are nobody's neighbours.
    """
    # Both uses of the table then have one plan, so that Spark shuffles it once.
    scores = scores.where(F.col("user_id").isNotNull())
    largest = scores.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    parts = F.greatest(F.least(F.ceil(largest / PART_POSTS), F.lit(MOST_PARTS)), F.lit(1))
    part = F.pmod(F.xxhash64("post_id"), parts).cast("int")
    entries = F.array_sort(F.collect_list(F.struct("post_id", *values.values())))
    return (
        scores.groupBy("user_id", part.alias("part"))
        .agg(entries.alias("entries"))
        .select(
            "user_id",
            "part",
            F.col("entries.post_id").alias("posts"),
            *(F.col(f"entries.{column}").alias(name) for name, column in values.items()),
        )
    )


def _met(neighbours: DataFrame, scores: DataFrame, **values: str) -> DataFrame:
    """The posts of every neighbour and, ``own``, of the user, all rows of a (user, part) one after the other in one task.

    Posts are shuffled and sorted as arrays, a row per neighbour, and never unpacked before they are merged.
    """
    packed = packed_posts(scores, **values)
    liked = packed.withColumnRenamed("user_id", "similar_user")
    columns = ["user_id", "part", "posts", *values, "cosine_similarity", "own"]
    asked = neighbours.join(liked, "similar_user").withColumn("own", F.lit(False))
    own = packed.withColumns({"cosine_similarity": F.lit(None).cast("double"), "own": F.lit(True)})
    dealt = spread(asked.select(*columns).unionByName(own.select(*columns)), "user_id", "part")
    return dealt.sortWithinPartitions("user_id", "part", "cosine_similarity")


def _unseen(met: DataFrame, kind: str, **columns: str) -> DataFrame:
    """Pairs of user and unseen post with further ``columns`` of the types given, as :func:`unseen_posts` finds them."""
    types = _pair_types(met) | columns
    return met.mapInArrow(unseen_posts(kind, [*types]), _listed(types))


def _pair_types(met: DataFrame) -> dict[str, str]:
    post = met.schema["posts"].dataType.elementType
    return dict(zip(_PAIR, (met.schema["user_id"].dataType.simpleString(), post.simpleString()), strict=True))


def _listed(types: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in types.items())


def recommendations(neighbours: DataFrame, scores: DataFrame, decimals: int) -> DataFrame:
    """All unseen posts of a user's neighbours, merged as in :func:`merge_candidates`.

    A user's own posts are dealt with those of its neighbours, so merging and dropping what is
    seen take one shuffle, of arrays, which a task merges user by user: it holds no table of pairs.
    """
    kind = scores.schema["total_score"].dataType
    if not isinstance(kind, (IntegralType, DoubleType)):
        return merge_candidates(unseen_candidates(neighbours, scores), decimals)
    total = "bigint" if isinstance(kind, IntegralType) else "double"
    scores = scores.withColumn("total_score", F.col("total_score").cast(total))
    met = _met(neighbours, scores, strengths="total_score")
    merged = _unseen(met, "merged", similarity="double", recommendation_strength=total)
    return merged.select(
        *_PAIR, F.round("similarity", decimals).alias("avg_similarity"), "recommendation_strength"
    )


def unseen_candidates(neighbours: DataFrame, scores: DataFrame) -> DataFrame:
    """:func:`unseen` of :func:`neighbour_candidates`, with one shuffle as in :func:`recommendations`."""
    total = scores.schema["total_score"].dataType.simpleString()
    met = _met(neighbours, scores, strengths="total_score")
    return _unseen(met, "each", cosine_similarity="double", sim_user_score=total)


def packed_candidates(neighbours: DataFrame, packed: DataFrame) -> DataFrame:
    """:func:`neighbour_candidates` as arrays: a row per neighbour and part of its posts, from :func:`packed_posts`."""
    liked = packed.withColumnRenamed("user_id", "similar_user")
    return neighbours.join(liked, "similar_user").select(*PART, "cosine_similarity", "posts", "strengths")


def unseen_packed(candidates: DataFrame, packed: DataFrame) -> DataFrame:
    """:func:`unseen` of :func:`packed_candidates`: a user's own posts are joined as an array, and tasks drop them.

    Where both tables are stored in as many buckets of :data:`PART`, neither is shuffled or sorted.
    """
    seen = packed.select(*PART, F.col("posts").alias("seen")).hint("shuffle_hash")
    met = candidates.join(seen, PART, "left")
    total = met.schema["strengths"].dataType.elementType.simpleString()
    types = _pair_types(met) | {"cosine_similarity": "double", "sim_user_score": total}
    return met.mapInArrow(unseen_beside([*types]), _listed(types))


def unseen_with(neighbours: DataFrame, liked: DataFrame, *values: str) -> DataFrame:
    """The posts of :func:`recommendations` with columns of ``liked`` that a post has alike for all users.

    ``liked`` lists what users have touched; its ``values`` travel with the posts, so that a join
    on the post takes the rows of ``liked`` and not the many more of the result.
    """
    found = _unseen(
        _met(neighbours, liked, **{name: name for name in values}),
        "any",
        **{name: liked.schema[name].dataType.simpleString() for name in values},
    )
    return found.withColumnRenamed("recommended_post_id", "post_id")
