"""Whole runs on hand-made logs: repeated posts, unknown users, saved tables, plans."""

from datetime import date

import pytest
from conftest import plan, rows

from rankflow import FeedConfig
from rankflow.operators import neighbours, serving, signals
from rankflow.plans.jobs import FeedRun
from rankflow.sources.schemas import INTERACTIONS, POSTS, USER_FEED, USER_POST_SCORES, USERS

DAY = date(2025, 6, 1)
LOG = [(1, p, "like") for p in range(101, 107)] + [(2, p, "view") for p in range(104, 110)]
CATALOGUE = [(p, "AI", 4, date(2025, 1, p - 100)) for p in range(101, 112)]


def a_run(table, posts=CATALOGUE, log=LOG, **options):
    config = options.pop("config", FeedConfig(feed_length=4))
    return FeedRun(table(log, INTERACTIONS), table(posts, POSTS), config, **options)


@pytest.mark.parametrize("recommended", [True, False])
def test_posts_listed_twice_take_no_place_twice(table, recommended):
    once = a_run(table, with_recommendations=recommended)
    twice = a_run(table, CATALOGUE + [(p, "AA", 1, d) for p, _, _, d in CATALOGUE],
                  with_recommendations=recommended)
    assert rows(twice.feed) == rows(once.feed)
    assert [len([r for r in rows(twice.feed) if r[0] == u]) for u in (1, 2)] == [4, 4]
    assert rows(twice.trending.groupBy("post_id").count(), "count") == [(1,)] * 9


def test_rows_without_user_are_one_unknown_user(table):
    scores = table([(None, 1, 2), (None, 2, 4), (3, 1, 5)], USER_POST_SCORES)
    assert rows(signals.interaction_scores(scores, 4)) == [(3, 1, 1.0), (None, 1, 0.5), (None, 2, 1.0)]
    run = a_run(table, log=[*LOG, (None, 101, "like"), (None, 102, "view")])
    assert [r[1] for r in rows(run.feed) if r[0] is None] == [101, 102]


def test_repeated_posts_and_users_are_served_once(table):
    feed = table([(1, 7, 0.25), (2, 8, 0.5)], USER_FEED)
    posts = table([(7, "AI", 4, DAY), (7, "AA", 9, DAY)], POSTS)
    users = table([(1, 20, "UK", "AI"), (1, 30, "UK", "AI")], USERS)
    got = rows(serving.feed_detailed(feed, posts, users), "user_id", "post_id", "topic", "user_info.age")
    assert got == [(1, 7, "AI", 30), (2, 8, "Unknown", None)]


@pytest.mark.parametrize("limit", [1, 500])
def test_saved_scores_may_be_fractional_and_repeated(table, limit):
    config = FeedConfig(feed_length=4, heavy_post_users=limit)
    whole = a_run(table, config=config)
    schema = "user_id bigint, post_id bigint, total_score double"
    saved = [(u, p, float(s)) for u, p, s in rows(whole.scores)]
    given = a_run(table, config=config, scores=table(saved + saved, schema))
    assert rows(given.neighbours) == rows(whole.neighbours)
    assert rows(given.feed) == rows(whole.feed)


def test_a_wrong_table_is_refused_before_any_job(table):
    with pytest.raises(TypeError, match="post_id"):
        FeedRun(table([(1, "x", "like")], "user_id bigint, post_id string, action string"),
                table(CATALOGUE, POSTS), FeedConfig())
    with pytest.raises(ValueError, match="total_score"):
        a_run(table, scores=table([(1, 2)], "user_id bigint, post_id bigint"))


def test_negative_weights_are_weights(table):
    weights = {"like": 3, "hide": -5, "view": 1}
    log = [*LOG, (3, 101, "hide"), (3, 105, "view"), (4, 102, "hide"), (4, 109, "like")]
    found = [
        rows(a_run(table, log=log, config=FeedConfig(action_weights=weights, heavy_post_users=n)).neighbours)
        for n in (1, 2, 500)
    ]
    assert found[0] == found[1] == found[2] and any(r[2] < 0 for r in found[0])


def test_plan_of_the_neighbours_themselves(table):
    """With heavy posts: blocks meet by key, light posts by post, and nothing meets everything."""
    scores = table([(u, p, 1 + u % 3) for u in range(40) for p in (0, 1 + u % 9)], USER_POST_SCORES)
    text = plan(neighbours.nearest_users_any(scores, 3, heavy_post_users=20))
    assert "FlatMapCoGroupsInArrow" in text and "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "InPandas" not in text
