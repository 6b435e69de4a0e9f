from conftest import rows

from rankflow.config import DEFAULT_ACTION_WEIGHTS as WEIGHTS
from rankflow.operators import scoring
from rankflow.sources.schemas import INTERACTIONS


def test_each_action_has_its_weight_and_unknown_or_missing_has_none(table):
    actions = ["view", "like", "comment", "share", "zzz", None]
    log = table([(1, i, a) for i, a in enumerate(actions)], INTERACTIONS)
    scored = scoring.action_scores(log, WEIGHTS)
    assert [s for _, s in rows(scored, "post_id", "score")] == [1, 3, 4, 5, 0, 0]


def test_no_weights_score_nothing(table):
    log = table([(1, 1, "view")], INTERACTIONS)
    assert rows(scoring.action_scores(log, {}), "score") == [(0,)]


def test_scores_add_up_and_zero_pairs_stay(table):
    log = table(
        [(1, 101, "view"), (1, 101, "like"), (1, 101, "share"), (2, 101, "zzz"), (2, 102, None)],
        INTERACTIONS,
    )
    assert rows(scoring.user_post_scores(log, WEIGHTS)) == [(1, 101, 9), (2, 101, 0), (2, 102, 0)]


def test_pair_activity_counts_rows_and_likes(table):
    log = table(
        [(1, 101, "like"), (1, 101, "like"), (1, 101, None), (2, 101, "view")], INTERACTIONS
    )
    pairs = scoring.pair_activity(log, WEIGHTS, "like")
    assert rows(pairs) == [(1, 101, 6, 3, 2), (2, 101, 1, 1, 0)]
    assert rows(pairs.select("user_id", "post_id", "total_score")) == rows(
        scoring.user_post_scores(log, WEIGHTS)
    )


def test_matrix_dimensions(table):
    log = table([(1, 1, "view"), (1, 2, "view"), (2, 2, "view")], INTERACTIONS)
    scores = scoring.user_post_scores(log, WEIGHTS)
    assert rows(scoring.matrix_dimensions(scores)) == [(2, 2)]


def test_empty_log(table):
    scores = scoring.user_post_scores(table([], INTERACTIONS), WEIGHTS)
    assert rows(scores) == []
    assert rows(scoring.matrix_dimensions(scores)) == [(0, 0)]
