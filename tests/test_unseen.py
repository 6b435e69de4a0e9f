import random

import pyarrow as pa
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rankflow import FeedConfig
from rankflow.functions.unseen import unseen_beside, unseen_posts
from rankflow.operators import feed, neighbours, recommend
from rankflow.plans.jobs import FeedRun
from rankflow.sources import schemas

NAMES = ["user_id", "recommended_post_id", "similarity", "strength"]


def _run(table, **options):
    draw = random.Random(3)
    log = [(u, p, draw.choice(["view", "like", "share", "?"])) for u in range(1, 13) for p in range(101, 130) if draw.random() < 0.3]
    log += [(1, None, "like"), (2, None, "view"), (3, None, "share"), (None, 105, "like"), (None, None, "view")]
    posts = [(p, "t", p % 7, None) for p in range(101, 125)]
    posts = table(posts, schemas.POSTS).withColumn("timestamp", F.date_add(F.lit("2025-01-01").cast("date"), F.col("post_id").cast("int") % 50))
    return FeedRun(table(log, schemas.INTERACTIONS), posts, FeedConfig(neighbours=3), **options)


def test_candidates_and_scores_are_those_of_a_table_of_recommendations(table):
    """F8, F9, F16: signals join what is liked, and no join or aggregate takes the pairs that come of it."""
    run = _run(table)
    saved = _run(table, recommended=recommend.merge_candidates(recommend.unseen(recommend.neighbour_candidates(run.neighbours, run.scores), run.scores), 4))
    assert rows(run.candidates) == rows(saved.candidates) and run.candidates.count() > 100
    assert rows(run.scored) == rows(saved.scored)
    assert rows(run.best) == rows(feed.best_scores(saved.scored)) == rows(saved.best)
    for result in (run.candidates, run.scored, run.best):
        text = plan(result)
        nearest = "".join(text.split("MapInArrow")[0].splitlines()[-3:])
        assert "MapInArrow" in text and not any(step in nearest for step in ("Join", "Aggregate", "Exchange"))


def test_best_scores_of_a_run_without_recommendations(table):
    run = _run(table, with_recommendations=False)
    assert rows(run.best) == rows(feed.best_scores(run.scored)) == rows(run.scored)


@pytest.mark.parametrize("at_once", [1, 5, 1_000_000])
@pytest.mark.parametrize("cut", [1, 2, 7])
def test_a_user_may_span_batches(at_once, cut):
    table = pa.table({
        "user_id": [None, 1, 1, 1, 2, 2, 3],
        "part": [0, 0, 0, 0, 0, 1, 0],
        "posts": pa.array([[9], [1, 2], [None, 2, 3], [None, 3], [4], [4], [5]]),
        "strengths": pa.array([[1], [7, 7], [2, 2, None], [1, None], [6], [3], [8]]),
        "cosine_similarity": [0.5, None, 0.5, 1.0, 0.25, 0.5, None],
        "own": [False, True, False, False, False, False, True],
    })
    found = list(unseen_posts("merged", NAMES, at_once)(iter(table.to_batches(max_chunksize=cut))))
    got = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert sorted(got, key=repr) == sorted([(None, 9, 0.5, 1), (1, 3, 0.75, None), (1, None, 0.75, 3), (2, 4, 0.25, 6), (2, 4, 0.5, 3)], key=repr)


@pytest.mark.parametrize("at_once", [1, 5, 1_000_000])
@pytest.mark.parametrize("kind", [pa.int64(), pa.string()])
def test_posts_seen_lie_beside_those_of_a_neighbour(at_once, kind):
    """with missing posts, a user that has none, and neighbours that have none."""
    table = pa.table({
        "user_id": [None, 1, 1, 2, 2, 3],
        "posts": pa.array([[9], [1, 2, None], [3], [4], [], [5, -(2**63)]]).cast(pa.list_(kind)),
        "strengths": pa.array([[1], [7, 8, None], [2], [None], [], [8, 9]]),
        "cosine_similarity": [0.5, 0.25, 0.5, None, 0.25, 0.5],
        "seen": pa.array([[9], [2, None], [2, None], None, None, [2**63 - 1, 5]]).cast(pa.list_(kind)),
    })
    found = list(unseen_beside(NAMES, at_once)(iter(table.to_batches(max_chunksize=4))))
    got = [tuple(r.values()) for b in found for r in b.to_pylist()]
    far = pa.scalar(-(2**63)).cast(kind).as_py()
    one, three, four = (pa.scalar(n).cast(kind).as_py() for n in (1, 3, 4))
    assert got == [(1, one, 0.25, 7), (1, None, 0.25, None), (1, three, 0.5, 2), (2, four, None, None), (3, far, 0.5, 9)]


def test_strengths_and_ids_of_any_size(table):
    """Sums of large numbers and posts far apart, and posts that are no numbers."""
    near = table([(1, 2, 0.5), (1, 3, 0.25)], "user_id bigint, similar_user bigint, cosine_similarity double")
    far = [(2, -(2**63), 2**53 + 1), (3, -(2**63), 2), (3, 2**63 - 1, 5), (1, 0, 1), (2, 0, 1)]
    scores = table(far, schemas.USER_POST_SCORES)
    assert rows(recommend.recommendations(near, scores, 4)) == [(1, -(2**63), 0.375, 2**53 + 3), (1, 2**63 - 1, 0.25, 5)]
    named = scores.withColumn("post_id", F.col("post_id").cast("string"))
    assert rows(recommend.recommendations(near, named, 4)) == [(1, str(-(2**63)), 0.375, 2**53 + 3), (1, str(2**63 - 1), 0.25, 5)]
    exact = scores.withColumn("total_score", F.col("total_score").cast("decimal(30,2)"))
    assert [r[3] for r in rows(recommend.recommendations(near, exact, 4))] == [2**53 + 3, 5]


def test_actions_are_counted_only_where_asked(table):
    """the feed does not group the log by action first; the statistics stay the same."""
    lean, full = _run(table, count_actions=False), _run(table)
    assert "actions" not in lean.pairs.columns and "actions" in full.pairs.columns
    assert rows(lean.pairs) == rows(full.pairs, *lean.pairs.columns)
    assert rows(lean.action_histogram) == rows(full.action_histogram)


def test_few_posts_are_stored_before_scores_are_joined_with_them(table):
    """so that Spark sees their size and shuffles no scores for them."""
    names = []

    def keep(df, name):
        names.append(name)
        return df

    run = _run(table)
    heavy = neighbours.vector_posts(run.scores, 2, 3, keep)
    neighbours.nearest_users(run.scores, 3, heavy=heavy, keep=keep)
    assert {"large_posts", "near_posts"} <= set(names)


def test_saved_recommendations_are_not_sorted_for_their_joins(table):
    """both joins hash the short side."""
    run = _run(table)
    text = plan(_run(table, recommended=run.recommendations).feed)
    assert text.count("ShuffledHashJoin") >= 2
