import random

import pytest
from conftest import SMALL, plan, rows
from pyspark.sql import functions as F

from rankflow.operators import feed, levels, recommend
from rankflow.plans.jobs import FeedRun
from rankflow.sources.mappings import OrdersInputs
from rankflow.sources.schemas import RECOMMENDATIONS, USER_FEED, USER_POST_SCORES

NEIGHBOURS = "user_id bigint, similar_user bigint, cosine_similarity double"
INTERACTION = "user_id bigint, post_id bigint, interaction_score double"
SIGNALS = "post_id bigint, popularity_score double, recency_score double"
WEIGHTS = (0.5, 0.3, 0.2)


def test_only_unseen_posts_are_recommended(table):
    scores = table([(1, 101, 1), (2, 101, 3), (2, 103, 4)], USER_POST_SCORES)
    near = table([(1, 2, 0.5), (2, 1, 0.5)], NEIGHBOURS)
    assert rows(recommend.recommendations(near, scores, 4)) == [(1, 103, 0.5, 4)]


def test_a_post_seen_with_score_zero_counts_as_seen(table):
    scores = table([(1, 101, 0), (2, 101, 3)], USER_POST_SCORES)
    assert rows(recommend.recommendations(table([(1, 2, 0.5)], NEIGHBOURS), scores, 4)) == []


def test_neighbours_are_averaged_and_their_scores_summed(table):
    scores = table([(2, 9, 3), (3, 9, 4), (3, 8, 0)], USER_POST_SCORES)
    near = table([(1, 2, 0.5), (1, 3, 0.25)], NEIGHBOURS)
    assert rows(recommend.recommendations(near, scores, 4)) == [
        (1, 8, 0.25, 0), (1, 9, 0.375, 7),
    ]


def test_dropping_seen_posts_before_or_after_the_merge_is_the_same(table):
    draw = random.Random(1)
    scores = table(
        [(u, p, draw.randint(0, 5)) for u in range(12) for p in range(9) if draw.random() < 0.4],
        USER_POST_SCORES,
    )
    near = table(
        [(u, v, draw.random()) for u in range(12) for v in draw.sample(range(12), 3) if u != v],
        NEIGHBOURS,
    )
    candidates = recommend.neighbour_candidates(near, scores)
    before = recommend.merge_candidates(recommend.unseen(candidates, scores), 4)
    assert rows(before) == rows(recommend.recommendations(near, scores, 4))


def score(rows_, signals):
    return feed.feed_scores(feed.feed_candidates(rows_, signals), WEIGHTS, 4)


def scored(table, interaction, recommended, signals):
    candidates = feed.touched(table(interaction, INTERACTION))
    if recommended is not None:
        extra = feed.recommended(table(recommended, RECOMMENDATIONS), 0.5)
        candidates = candidates.unionByName(extra)
    return score(candidates, table(signals, SIGNALS))


def test_feed_score_by_hand(table):
    assert rows(scored(table, [(1, 1, 1.0)], None, [(1, 0.5, 0.25)])) == [(1, 1, 0.7)]


def test_missing_signals_count_as_zero(table):
    got = rows(scored(table, [(1, 1, 1.0), (1, 2, 1.0)], None, [(1, 0.5, None)]))
    assert got == [(1, 1, 0.65), (1, 2, 0.5)]


def test_recommended_posts_get_the_base_score(table):
    got = rows(scored(table, [(1, 1, 0.2)], [(1, 2, 0.9, 7)], [(1, 0.0, 0.0), (2, 1.0, 0.0)]))
    assert got == [(1, 1, 0.1), (1, 2, 0.55)]


def test_a_post_from_both_sources_keeps_its_higher_score(table):
    own = table([(1, 1, 0.5), (2, 1, 0.05)], USER_FEED)
    extra = table([(1, 1, 0.25), (2, 1, 0.25)], USER_FEED)
    expected = [(1, 1, 0.5), (2, 1, 0.25)]
    assert rows(feed.best_scores(own.unionByName(extra))) == expected
    for length in (1, 10):
        assert rows(feed.user_feed(feed.touched_feed(own, length), extra, length)) == expected


def test_equal_scores_go_by_post(table):
    tied = table([(1, p, 0.5) for p in range(112, 100, -1)], USER_FEED)
    for feeds in (feed.ranked(tied, 10), feed.touched_feed(tied, 10)):
        assert [r[1] for r in rows(feeds)] == list(range(101, 111))


def test_recommendations_dropped_early_change_nothing(table):
    draw = random.Random(4)
    values = [0.1, 0.2, 0.3, 0.4]
    own = [(u, p, draw.choice(values)) for u in range(20) for p in range(u)]
    extra = [
        (u, draw.randint(0, 30), draw.choice(values)) for u in range(25) for _ in range(12)
    ]
    best = {}
    for u, p, s in own + extra:
        best[u, p] = max(s, best.get((u, p), 0.0))
    expected = []
    for user in range(25):
        mine = sorted((-s, p) for (u, p), s in best.items() if u == user)[:4]
        expected += [(user, p, -s) for s, p in mine]
    expected.sort(key=repr)
    own, extra = table(own, USER_FEED), table(extra, USER_FEED)
    assert rows(feed.user_feed(feed.touched_feed(own, 4), extra, 4)) == expected
    assert rows(feed.ranked(own.unionByName(extra), 4)) == expected


def test_feed_from_neighbours_equals_feed_from_recommendations(table):
    draw = random.Random(9)
    matrix = [
        (u, p, draw.randint(0, 5)) for u in range(25) for p in range(40) if draw.random() < 0.2
    ]
    scores = table(matrix, USER_POST_SCORES)
    near = table(
        [(u, v, draw.random()) for u in range(25) for v in draw.sample(range(25), 4) if u != v],
        NEIGHBOURS,
    )
    signals = table([(p, draw.random(), draw.random()) for p in range(35)], SIGNALS)
    own = score(
        table([(u, p, s / 5) for u, p, s in matrix], INTERACTION), signals
    )
    extra = score(feed.recommended(recommend.recommendations(near, scores, 4), 0.5), signals)
    liked = score(table([(u, p, 0.5) for u, p, _ in matrix], INTERACTION), signals)
    expected = rows(feed.ranked(own.unionByName(extra), 6))
    best_own = feed.touched_feed(own, 6)
    assert rows(feed.user_feed(best_own, extra, 6)) == expected
    assert rows(feed.user_feed_of_neighbours(best_own, near, liked, scores, 6)) == expected


def test_feed_of_chosen_users(table):
    all_feeds = table([(u, 1, 0.5) for u in range(5)], USER_FEED)
    assert [r[0] for r in rows(feed.feed_for_users(all_feeds, [1, 3]))] == [1, 3]


@pytest.mark.parametrize("part_posts", [2, 4096])
def test_posts_are_recommended_from_arrays(table, monkeypatch, part_posts):
    """Without a join on the pair, and with the rows of one, missing posts and hot users included."""
    monkeypatch.setattr(recommend, "PART_POSTS", part_posts)
    triples = [(u, p, u + p) for u in range(1, 9) for p in range(u % 3, 20, u)]
    scores = table([*triples, (2, None, 3), (3, None, 4), (None, 5, 1)], "user_id bigint, post_id bigint, total_score bigint")
    close = [(1, 2, 0.25), (1, 8, 0.5), (3, 1, 0.75), (3, 2, 0.5), (8, 1, 1.0), (9, 2, 0.5)]
    neighbours = table(close, "user_id bigint, similar_user bigint, cosine_similarity double")
    candidates = recommend.neighbour_candidates(neighbours, scores)
    want = recommend.unseen(recommend.merge_candidates(candidates, 4), scores)
    got = recommend.recommendations(neighbours, scores, 4)
    assert rows(got) == rows(want, *got.columns) and "LeftAnti" not in plan(got)
    each = recommend.unseen_candidates(neighbours, scores)
    assert rows(each) == rows(recommend.unseen(candidates, scores), *each.columns)
    assert "LeftAnti" not in plan(each)


@pytest.mark.parametrize("bits", [3, 5, 22])
def test_recommendations_out_of_reach_go_by_the_levels_of_cells(table, monkeypatch, bits):
    """Whatever shares a cell, no row in reach goes; users without a full feed and missing keys are among them."""
    monkeypatch.setattr(levels, "LEVEL_BITS", bits)
    draw = random.Random(bits)
    signals = table([(p, draw.random(), draw.random()) for p in range(60)], SIGNALS)
    own = [(u, p, round(draw.random(), 4)) for u in [*range(20), None] for p in draw.sample(range(60), 3 + (u or 0) % 4)]
    best = feed.touched_feed(score(table(own, INTERACTION), signals), 4)
    asked = [(u, p, 0.5) for u in [*range(25), None] for p in [*draw.sample(range(80), 40), None]]
    recommended = table(asked, INTERACTION)
    posts = score(table([(None, p, 0.5) for p in range(60)], INTERACTION), signals)
    kept = feed.maybe_in_reach(recommended, posts, F.lit(0.25), best, 4)
    assert rows(feed.user_feed(best, score(kept, signals), 4)) == rows(feed.user_feed(best, score(recommended, signals), 4))
    assert rows(kept.where("user_id >= 20 or user_id is null")) == rows(recommended.where("user_id >= 20 or user_id is null"))
    if bits == 22:
        in_reach = feed.in_reach(score(recommended, signals).join(feed.last_scores(best, 4), "user_id", "left"))
        assert in_reach.count() <= kept.count() < 0.8 * recommended.count()


def test_saved_recommendations_out_of_reach_are_not_shuffled(spark):
    """They meet the bounds of users and posts where they are read, however small a table must be for a broadcast."""
    i = OrdersInputs(spark, SMALL)
    first = FeedRun(i.interactions, i.posts, i.config)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        given = FeedRun(i.interactions, i.posts, i.config, scores=first.scores, recommended=first.recommendations)
        assert plan(given.feed).count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_saved_recommendations_are_dealt_by_user_once(spark, table):
    """rows found to be in reach are grouped and ranked where the join by user has left them."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own, extra = table([(1, 1, 0.5)], USER_FEED), table([(1, 2, 0.25), (1, 2, 0.25), (None, 1, 0.5)], USER_FEED)
        result = feed.user_feed(own, extra, 2)
        assert "hashpartitioning(user_id" in plan(result)
        assert not [line for line in plan(result).splitlines() if "Exchange" in line and "post_id" in line]
        assert rows(result) == [(1, 1, 0.5), (1, 2, 0.25), (None, 1, 0.5)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
