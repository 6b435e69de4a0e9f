"""What a hot post or a hot user may cost, counted in rows."""

import random

from conftest import rows

from rankflow.operators import neighbours, similarity
from rankflow.sources.schemas import USER_POST_SCORES


def hot_post(table, users):
    """A post touched by all users, with five different scores, and a tail."""
    return table(
        [(u, 0, u % 5) for u in range(users)]
        + [(u, 1 + u // 2, 2) for u in range(0, users, 3)],
        USER_POST_SCORES,
    )


def vectors_of(scores, limit):
    heavy = similarity.heavy_posts(scores, limit).select("post_id")
    normed = similarity.with_norms(scores).where("norm2 > 0")
    return neighbours._heavy_vectors(normed.join(heavy, "post_id", "left_semi"))


def test_representatives_do_not_grow_with_the_audience(table):
    k = 3
    for users in (200, 2000):
        chosen = neighbours._representatives(vectors_of(hot_post(table, users), 50), k)
        assert chosen.groupBy("posts", "weights").count().count() == 5
        assert chosen.count() <= 5 * 2 * (k + 1)


def test_a_hot_post_hands_on_a_few_rows_per_user(table):
    k, users = 3, 2000
    vectors = vectors_of(hot_post(table, users), 50)
    chosen = neighbours._representatives(vectors, k)
    handed_on = neighbours._blockwise_neighbours(vectors, chosen, k, block_users=2048)
    assert handed_on.groupBy("user_id").count().agg({"count": "max"}).first()[0] <= k


def test_a_hot_user_is_one_more_user(table):
    """A user with a third of all rows meets everybody, and everybody has K rows."""
    scores = table(
        [(0, p, 1 + p % 4) for p in range(600)]
        + [(1 + p // 4, p, 1 + p % 3) for p in range(600)]
        + [(1 + p % 150, p, 2) for p in range(600)],
        USER_POST_SCORES,
    ).dropDuplicates(["user_id", "post_id"])
    near = neighbours.nearest_users_any(scores, 4, heavy_post_users=100)
    again = neighbours.nearest_users_any(scores, 4, heavy_post_users=1)
    assert rows(near) == rows(again)
    assert near.groupBy("user_id").count().agg({"count": "max"}).first()[0] == 4
    assert near.where("user_id = 0 or similar_user = 0").count() > 0


def test_users_with_close_neighbours_skip_the_vectors(table):
    """Pairs with a strong tie of their own, and one popular post that all have touched lightly."""
    scores = table(
        [(u, 0, 1) for u in range(120)]
        + [(u, 1 + u // 4, 5) for u in range(0, 80)]
        + [(u, 500 + u, 5) for u in range(80, 100)],
        USER_POST_SCORES,
    )
    near = neighbours.nearest_users_any(scores, 3, heavy_post_users=50)
    assert rows(near) == rows(neighbours.nearest_users_any(scores, 3, heavy_post_users=1000))
    heavy = neighbours.vector_posts(scores, 50).select("post_id")
    normed = similarity.with_norms(scores)
    users = neighbours._light_users(normed.join(heavy, "post_id", "left_anti"), 3)
    asking = neighbours._asking(vectors_of(scores, 50), users)
    assert {r.user_id for r in asking.collect()} == set(range(80, 120))


def test_floors_cut_edges_but_no_neighbour(table):
    draw = random.Random(8)
    scores = table(
        [(u, p, draw.randint(1, 5)) for u in range(300) for p in draw.sample(range(40), 5)],
        USER_POST_SCORES,
    )
    similar = similarity.user_similarity(similarity.pair_dot_products(scores, 1000)).cache()
    edges = neighbours._light_edges(
        similarity.with_norms(scores),
        neighbours._light_users(similarity.with_norms(scores), 2),
        vectors_of(scores, 1000),
        2,
    )
    assert edges.count() < similarity.bidirectional(similar).count() / 2
    assert rows(neighbours.nearest_users_any(scores, 2, heavy_post_users=1000)) == rows(
        neighbours.top_similar_users(similar, 2)
    )
    similar.unpersist()


def test_posts_that_an_index_does_cheaper_are_no_vectors(table):
    """Many posts just above the limit stay in the index; a post of all users does not."""
    tail = [(u, 1 + (u * 7 + i) % 400, 2) for u in range(400) for i in range(5)]
    assert neighbours.vector_posts(table(tail, USER_POST_SCORES), 2).count() == 0
    both = table(tail + [(u, 0, 1) for u in range(400)], USER_POST_SCORES)
    assert [r.post_id for r in neighbours.vector_posts(both, 2).collect()] == [0]
    assert rows(neighbours.nearest_users_any(both, 3, heavy_post_users=2)) == rows(
        neighbours.nearest_users_any(both, 3, heavy_post_users=1000)
    )


def test_blocks_grow_with_the_users(table):
    """However small the blocks asked for, a user meets a bounded number of them."""
    draw = random.Random(9)
    scores = table([(u, p, draw.randint(1, 5)) for u in range(150) for p in range(6)], USER_POST_SCORES)
    vectors = vectors_of(scores, 50)
    handed_on = neighbours._blockwise_neighbours(vectors, vectors, 1, block_users=1)
    assert handed_on.groupBy("user_id").count().agg({"count": "max"}).first()[0] <= neighbours.MOST_BLOCKS


def test_a_limit_of_no_users_is_a_limit(table):
    scores = table([(u, 0, 1 + u % 3) for u in range(60)], USER_POST_SCORES)
    assert rows(neighbours.nearest_users_any(scores, 2, heavy_post_users=0)) == rows(
        neighbours.nearest_users_any(scores, 2, heavy_post_users=1000)
    )


def test_scores_meet_their_norms_once(table):
    """Heavy and light posts read one stored table, so scores are not shuffled by user for each of them."""
    kept = {}

    def keep(df, name):
        kept[name] = df
        return df.localCheckpoint()

    scores = table([(u, p, 1 + (u + p) % 4) for u in range(30) for p in range(u % 3, 12, 3)], USER_POST_SCORES)
    heavy = table([(0,)], "post_id bigint")
    neighbours.nearest_users(scores, 3, heavy=heavy, keep=keep)
    assert {"user_id", "post_id", "total_score", "norm2", "n_posts"} == set(kept["normed"].columns)
