import random

import pytest
from conftest import plan, rows
from test_similarity import brute_force, random_triples

from rankflow.operators import similarity
from rankflow.sources.schemas import USER_POST_SCORES


@pytest.mark.parametrize("least", [0.05, 0.4, 0.8, 1.0])
@pytest.mark.parametrize("tile", [3, 500])
def test_similar_pairs_are_all_that_reach_the_bound(table, least, tile):
    triples = random_triples(21, 45, 20, 0.2, popular=2)
    got = similarity.similar_pairs(table(triples, USER_POST_SCORES), least, tile)
    want = sorted(((a, b, v) for (a, b), v in brute_force(triples).items() if v >= least), key=repr)
    assert rows(got, "user_a", "user_b", "cosine_similarity") == want


def test_similar_pairs_of_signed_scores(table):
    draw = random.Random(4)
    triples = [(u, p, draw.randint(-4, 4)) for u in range(30) for p in draw.sample(range(12), 5)]
    got = similarity.similar_pairs(table(triples, USER_POST_SCORES), 0.5)
    want = sorted(((a, b, v) for (a, b), v in brute_force(triples).items() if v >= 0.5), key=repr)
    assert want and rows(got, "user_a", "user_b", "cosine_similarity") == want


def test_equal_users_are_similar_at_one(table):
    triples = [(u, p, s) for u in (1, 2) for p, s in ((5, 3), (6, 1), (7, 2))]
    assert rows(similarity.similar_pairs(table(triples, USER_POST_SCORES), 1.0), "user_a", "user_b") == [(1, 2)]


def test_a_popular_post_brings_few_users_together(table):
    """All users touched one post lightly; only those whose other posts agree meet."""
    triples = [(u, 0, 1) for u in range(200)] + [(u, 1 + u // 2, 5) for u in range(200)]
    scores = table(triples, USER_POST_SCORES)
    ordered = similarity._rarest_first(similarity.with_norms(scores))
    assert {r.place for r in ordered.where("post_id = 0").collect()} == {1}
    got = similarity.similar_pairs(scores, 0.9)
    assert got.count() == 100


@pytest.mark.parametrize("least", [1, 2, 4, 9])
def test_pairs_sharing_posts(table, least):
    triples = random_triples(22, 40, 18, 0.25, popular=3)
    touched = {}
    for user, post, _ in triples:
        touched.setdefault(user, set()).add(post)
    want = sorted(
        (
            (a, b, n)
            for a in touched
            for b in touched
            if a < b and (n := len(touched[a] & touched[b])) >= least
        ),
        key=repr,
    )
    assert rows(similarity.pairs_sharing(table(triples, USER_POST_SCORES), least, 10)) == want


def test_bounds_that_bound_nothing_are_refused(table):
    scores = table([], USER_POST_SCORES)
    with pytest.raises(ValueError, match="positive"):
        similarity.similar_pairs(scores, 0)
    with pytest.raises(ValueError, match="at least 1"):
        similarity.pairs_sharing(scores, 0)
    assert rows(similarity.similar_pairs(scores, 0.5)) == rows(similarity.pairs_sharing(scores, 1)) == []


def test_pairs_meet_by_post(table):
    text = plan(similarity.similar_pairs(table([(1, 2, 3)], USER_POST_SCORES), 0.5))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_row_of_a_pair_is_shuffled(table):
    """Pairs come whole out of their cell: nothing is dealt by user after that."""
    scores = table([(1, 2, 3), (2, 2, 1)], USER_POST_SCORES)
    text = plan(similarity.pair_dot_products(scores, 500))
    assert "hashpartitioning(cell" in text and "hashpartitioning(user_a" not in text


def test_pairs_of_a_post_left_out_are_completed(table):
    """The greater of two ids lacks the popular post in the index, and the pair needs it to reach the bound."""
    triples = [(u, 0, 3) for u in range(30)] + [(u, 1 + u // 2, 4) for u in range(30)]
    scores = table(triples, USER_POST_SCORES)
    pairs = [(2 * i, 2 * i + 1) for i in range(15)]
    assert rows(similarity.similar_pairs(scores, 0.99, 10), "user_a", "user_b", "dot_product") == [(*p, 25) for p in sorted(pairs, key=repr)]
    assert rows(similarity.pairs_sharing(scores, 2, 10)) == [(*p, 2) for p in sorted(pairs, key=repr)]


def crowded_triples():
    """Some 30 posts that most users touched: an index has far more products than there are pairs."""
    draw = random.Random(8)
    return [(u, p, draw.randint(-2, 5)) for u in range(70) for p in draw.sample(range(30), 20)]


@pytest.mark.parametrize("block_users", [16, 500])
def test_users_who_share_most_posts_are_multiplied_as_blocks(table, monkeypatch, block_users):
    monkeypatch.setattr(similarity, "BLOCK_USERS", block_users)
    scores = table(crowded_triples(), USER_POST_SCORES)
    want = brute_force(crowded_triples())
    pairs = similarity.pair_dot_products(scores, 500)
    assert rows(similarity.user_similarity(pairs), "user_a", "user_b", "cosine_similarity") == sorted(((a, b, v) for (a, b), v in want.items()), key=repr)
    got = similarity.similar_pairs(scores, 0.5)
    assert rows(got, "user_a", "user_b", "cosine_similarity") == sorted(((a, b, v) for (a, b), v in want.items() if v >= 0.5), key=repr)
    touched = {}
    for u, p, _ in crowded_triples():
        touched.setdefault(u, set()).add(p)
    shared = [(a, b, n) for a in touched for b in touched if a < b and (n := len(touched[a] & touched[b])) >= 14]
    assert rows(similarity.pairs_sharing(scores, 14)) == sorted(shared, key=repr)


def test_no_product_of_crowded_posts_is_dealt(table):
    """What moves are the scores, once per block: the index is empty."""
    known = similarity.with_norms(table(crowded_triples(), USER_POST_SCORES))
    assert known.where(~similarity._few_users_for_their_products(known)).isEmpty()
    sparse = similarity.with_norms(table([(u, u // 2, 1) for u in range(60)], USER_POST_SCORES))
    assert sparse.where(similarity._few_users_for_their_products(sparse)).isEmpty()


def test_scores_beyond_the_doubles_are_summed_as_integers(table):
    triples = [(u, p, 2**30 + u * 7 + p) for u in range(6) for p in range(4)]
    got = similarity.pair_dot_products(table(triples, USER_POST_SCORES), 500)
    value = {(u, p): s for u, p, s in triples}
    want = [(a, b, sum(value[a, p] * value[b, p] for p in range(4))) for a in range(6) for b in range(a + 1, 6)]
    assert rows(got, "user_a", "user_b", "dot_product") == sorted(want, key=repr)
