"""Cosine similarity of every pair of users that share a post.

``pair_dot_products`` and what is built on it return *all* similar pairs, which is
quadratic in the users of a post because the result itself is.  They are for reports and
checks; the recommendation job needs only the closest neighbours and takes them from
:mod:`rankflow.operators.neighbours`, which never lists the pairs of a hot post.

``similar_pairs`` and ``pairs_sharing`` ask for a least cosine or a least number of shared
posts.  A user's posts go from the least to the most popular, and large posts at the end are
not indexed where they are too light, or too few, to make a pair on their own.

Where users share so many posts that the products of an index outnumber what it takes to compare
all pairs of users, blocks of users are multiplied as vectors instead, and only their scores move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from rankflow.functions import cosine, spread
from rankflow.functions.blocks import index_pairs, pack_vectors, vector_pairs
from rankflow.operators.cells import CELL_PRODUCTS, packed_cells

Keep = Callable[[DataFrame, str], DataFrame]

#: Users of a block that is multiplied with others, about, and blocks at most; they grow beyond that.
BLOCK_USERS = 512
MOST_BLOCKS = 32


def user_norms(scores: DataFrame) -> DataFrame:
    """Sum of squared scores per user, exact in bigint."""
    score = F.col("total_score")
    return scores.groupBy("user_id").agg(F.sum(score * score).alias("norm2"))


def user_magnitudes(scores: DataFrame) -> DataFrame:
    """Length of each user's score vector."""
    return user_norms(scores).select("user_id", F.sqrt("norm2").alias("magnitude"))


def with_norms(scores: DataFrame) -> DataFrame:
    """Scores with their user's squared norm.

    Attached to the short table before the self-join: the pair table, which is
    longer by far, then needs no join of its own.
    """
    return scores.select("user_id", "post_id", "total_score").join(user_norms(scores), "user_id")


def post_audience(scores: DataFrame) -> DataFrame:
    """Number of users per post."""
    return scores.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_users"))


def heavy_posts(scores: DataFrame, heavy_post_users: int) -> DataFrame:
    """Posts touched by more than ``heavy_post_users`` users."""
    return post_audience(scores).where(F.col("n_users") > heavy_post_users)


def pair_dot_products(scores: DataFrame, heavy_post_users: int) -> DataFrame:
    """Dot product and number of shared posts of each user pair, ``user_a < user_b``.

    The posts go to cells of users as in :mod:`rankflow.operators.neighbours`; a cell sums its
    pairs, and no row of a pair is shuffled.  Where that is less work, blocks of users are
    multiplied.  Posts of any size are dealt alike, so ``heavy_post_users`` makes no difference here.
    """
    rows = with_norms(scores).withColumns({"indexed": F.lit(True), "rest": F.lit(0.0)})
    return _pairs_of_cells(rows).drop("rest_b")


def _pairs_of_cells(
    rows: DataFrame, cell_products: int = CELL_PRODUCTS, *, least: float | None = None, min_shared: int = 1
) -> DataFrame:
    """``user_a, user_b, norm2_a, norm2_b, dot_product, shared_posts, rest_b`` of all pairs that share a post.

    ``rows`` are scores with ``norm2``, and with ``indexed``, whether the post is one under which the
    user is found as ``user_b``, and ``rest``, a measure of the user's posts that are not.  Pairs from
    vectors are whole, and those below ``least`` or ``min_shared`` are left out there already.
    """

    def kind(name: str) -> str:
        return "bigint" if isinstance(rows.schema[name].dataType, IntegralType) else "double"

    numbers = {n: F.coalesce(F.col(n).cast(kind(n)), F.lit(0).cast(kind(n))) for n in ("total_score", "norm2")}
    known = rows.where(F.col("post_id").isNotNull()).withColumns(numbers)
    as_vectors = _few_users_for_their_products(known)
    sparse = known.where(~as_vectors)
    counts = sparse.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_posts"))
    entry = F.struct("user_id", "total_score", "norm2", "rest", "n_posts", "indexed")
    index = sparse.join(counts, "user_id").groupBy("post_id").agg(F.collect_list(entry).alias("found"))
    cells = packed_cells(index, cell_products, ordered=True, audience=post_audience(known))
    schema = (
        f"user_a bigint, user_b bigint, norm2_a {kind('norm2')}, norm2_b {kind('norm2')}, "
        f"dot_product {kind('total_score')}, shared_posts bigint, rest_b double"
    )
    by_index = cells.groupBy("cell", "part").applyInArrow(index_pairs(), schema)
    blocks = _paired_blocks(known.where(as_vectors), known)
    return by_index.unionByName(
        blocks.groupBy("first", "second").applyInArrow(vector_pairs(least, min_shared), schema)
    )


def _few_users_for_their_products(rows: DataFrame) -> Column:
    """Whether an index of ``rows`` has more products than it is worth multiplying all users as vectors."""
    n_users = rows.select("user_id").distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    audience = post_audience(rows)
    products = audience.agg(F.sum(F.col("n_users") * F.col("n_users").cast("double"))).scalar()
    n_posts = audience.agg(F.count(F.lit(1))).scalar()
    # As in vector_posts: each pair costs more the more posts there are.
    return F.coalesce(products > n_users * n_users * (0.1 + n_posts / 1024), F.lit(False))


def _paired_blocks(rows: DataFrame, users: DataFrame) -> DataFrame:
    """``first, second, block, vectors``: the scores of two blocks of users for each pair of blocks, or one with itself."""
    count = users.select("user_id").distinct().agg(F.count(F.lit(1))).scalar()
    n_blocks = F.greatest(F.least(F.ceil(count / BLOCK_USERS), F.lit(MOST_BLOCKS)), F.lit(1)).cast("int")
    dealt = rows.select("user_id", "post_id", "total_score", "norm2", F.pmod(F.xxhash64("user_id"), n_blocks).cast("int").alias("block"))
    packed = dealt.groupBy("block").applyInArrow(pack_vectors(), "block int, vectors binary")
    met = packed.select("block", "vectors", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("other"))
    pair = (F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    return spread(met.select(*pair, "block", "vectors"), "first", "second")


# Room for the last bits of sums of squares and their roots.
_SLACK = 1.0 - 1e-9


def _rarest_first(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of users of their post, in whose order the ``place`` of a post among its user's is counted from the most popular."""
    counted = rows.join(post_audience(rows), "post_id")
    last_first = Window.partitionBy("user_id").orderBy(F.desc("n_users"), F.desc("post_id"))
    return counted.withColumn("place", F.row_number().over(last_first))


def similar_pairs(
    scores: DataFrame, min_cosine: float, heavy_post_users: int = 500, keep: Keep = lambda df, name: df
) -> DataFrame:
    """All pairs with a cosine of at least ``min_cosine``, a positive number.

    A user is not indexed under posts of more than ``heavy_post_users`` users whose share of its
    length, the most popular first, is below the bound: they make no such pair by themselves.  Pairs
    whose greater id has all posts in the index are whole in their cell; of the others, those that
    the rest could lift to the bound are computed again.  ``keep`` may store the pairs found.
    """
    if not min_cosine > 0:
        raise ValueError("min_cosine must be positive; pair_dot_products lists all pairs")
    ordered = _rarest_first(with_norms(scores).where("norm2 > 0"))
    onward = Window.partitionBy("user_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("total_score").cast("double") * F.col("total_score")
    reach = F.sqrt(F.sum(square).over(onward) / F.col("norm2"))
    least = min_cosine * _SLACK
    rows = _left_out(ordered.withColumn("reach", reach), F.col("reach") < least, "reach", heavy_post_users)
    value = cosine(F.col("dot_product"), F.col("norm2_a"), F.col("norm2_b"))
    pairs = _pairs_of_cells(rows, least=least).withColumn("cosine_similarity", value)
    whole = (F.col("rest_b") == 0) & (value >= min_cosine)
    found = keep(pairs.where(whole | ((F.col("rest_b") > 0) & (value + F.col("rest_b") >= least))), "pairs_found")
    names = ["user_a", "user_b", "dot_product", "shared_posts", "cosine_similarity"]
    completed = edge_products(found.where("rest_b > 0").select("user_a", "user_b"), scores)
    return (
        found.where("rest_b = 0")
        .select(*names)
        .unionByName(completed.select(*names).where(F.col("cosine_similarity") >= min_cosine))
    )


def _left_out(rows: DataFrame, light: Column, measure: str, heavy_post_users: int) -> DataFrame:
    """``rows`` with ``indexed``, false where a post is large and ``light`` holds, and ``rest``, the most of ``measure`` among those left out."""
    out = (F.col("n_users") > heavy_post_users) & light
    rest = F.max(F.when(~F.col("indexed"), F.col(measure).cast("double"))).over(Window.partitionBy("user_id"))
    return rows.withColumn("indexed", ~out).withColumn("rest", F.coalesce(rest, F.lit(0.0)))


def pairs_sharing(
    scores: DataFrame, min_shared: int, heavy_post_users: int = 500, keep: Keep = lambda df, name: df
) -> DataFrame:
    """``user_a, user_b, shared_posts`` of all pairs with at least ``min_shared`` common posts.

    Two users who share so many share one among all but the ``min_shared - 1`` most popular of either,
    which are left out of the index as in :func:`similar_pairs`.
    """
    if min_shared < 1:
        raise ValueError("min_shared must be at least 1")
    rows = scores.select("user_id", "post_id")
    ordered = _rarest_first(rows).withColumns({c: F.lit(1).cast("bigint") for c in ("total_score", "norm2")})
    pairs = _pairs_of_cells(_left_out(ordered, F.col("place") < min_shared, "place", heavy_post_users), min_shared=min_shared)
    found = keep(pairs.where(F.col("shared_posts") + F.col("rest_b") >= min_shared), "pairs_found")
    met = found.where("rest_b > 0").select("user_a", "user_b")
    of_a = rows.withColumnRenamed("user_id", "user_a")
    of_b = rows.withColumnRenamed("user_id", "user_b")
    shared = met.join(of_a, "user_a").join(of_b, ["user_b", "post_id"])
    completed = shared.groupBy("user_a", "user_b").agg(F.count(F.lit(1)).alias("shared_posts"))
    names = ["user_a", "user_b", "shared_posts"]
    whole = found.where("rest_b = 0").select(*names)
    return whole.unionByName(completed.select(*names).where(F.col("shared_posts") >= min_shared))


def edge_products(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """Dot product, number of shared posts and cosine of the given pairs only.

    ``edges`` has ``user_a`` and ``user_b``.  Rows of scores are joined, never whole
    vectors, and the result is as long as ``edges``: pairs without a common post, or
    with a user of no length, are left out.
    """
    normed = with_norms(scores)

    def side(s: str) -> DataFrame:
        names = (("user_id", "user"), ("total_score", "score"), ("norm2", "norm2"))
        return normed.select("post_id", *(F.col(n).alias(f"{m}_{s}") for n, m in names))

    shared = (
        edges.select("user_a", "user_b")
        .distinct()
        .join(side("a"), "user_a")
        .join(side("b"), ["user_b", "post_id"])
    )
    dots = shared.groupBy("user_a", "user_b", "norm2_a", "norm2_b").agg(
        F.sum(F.col("score_a") * F.col("score_b")).alias("dot_product"),
        F.count(F.lit(1)).alias("shared_posts"),
    )
    value = cosine(F.col("dot_product"), F.col("norm2_a"), F.col("norm2_b"))
    return dots.select(
        "user_a", "user_b", "dot_product", "shared_posts", value.alias("cosine_similarity")
    ).where(F.col("cosine_similarity").isNotNull())


def user_similarity(pairs: DataFrame) -> DataFrame:
    """Cosine per pair from ``pair_dot_products``.

    A user with only zero scores has no direction, hence no similarity row.
    """
    value = cosine(F.col("dot_product"), F.col("norm2_a"), F.col("norm2_b"))
    return pairs.select("user_a", "user_b", value.alias("cosine_similarity")).where(
        F.col("cosine_similarity").isNotNull()
    )


def bidirectional(similarity: DataFrame) -> DataFrame:
    """Each edge once from either end, in one pass over the pair table."""
    ends = F.array(
        F.struct(F.col("user_a").alias("user_id"), F.col("user_b").alias("similar_user")),
        F.struct(F.col("user_b").alias("user_id"), F.col("user_a").alias("similar_user")),
    )
    return similarity.select(F.inline(ends), "cosine_similarity")


def most_similar_pairs(neighbours: DataFrame, length: int) -> DataFrame:
    """The closest pairs overall, from each user's ``length`` closest neighbours.

    A pair outside the list of its smaller member has ``length`` closer pairs, so
    the lists hold the whole answer.
    """
    return (
        neighbours.where("user_id < similar_user")
        .select(
            F.col("user_id").alias("user_a"),
            F.col("similar_user").alias("user_b"),
            "cosine_similarity",
        )
        .orderBy(F.desc("cosine_similarity"), "user_a", "user_b")
        .limit(length)
    )
