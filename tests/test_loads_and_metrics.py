from datetime import date

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rankflow.config import FeedConfig
from rankflow.operators import scoring, serving, trending
from rankflow.plans.jobs import FeedRun
from rankflow.sources import files
from rankflow.sources.schemas import INTERACTIONS, POSTS, last_row_per_key
from rankflow.sources.workspace import Workspace

LOG = [(1, 101, "view"), (1, 101, "like"), (1, 102, None), (2, 101, "zzz"), (2, 103, "share"), (3, 101, "view")]
CATALOGUE = [(p, "t", 1, date(2025, 1, p - 100)) for p in (101, 102, 103)]


def test_stats_and_counts_read_the_log_once(spark, table, tmp_path):
    table(LOG, INTERACTIONS).write.parquet(f"{tmp_path}/the_log")
    run = FeedRun(spark.read.parquet(f"{tmp_path}/the_log"), table(CATALOGUE, POSTS), FeedConfig())
    users = table([(1, 20, "x", "y"), (9, 20, "x", "y")], "user_id bigint, age int, location string, interest string")
    stats = run.stats(users, run.feed)
    the_log = "post_id:bigint,action:string>"
    assert the_log in plan(run.interactions)
    assert the_log not in plan(stats) and the_log not in plan(run.counts)
    assert stats.first().asDict() == {
        "total_users": 2,
        "users_with_feeds": 3,
        "total_trending_posts": 3,
        "total_interactions": 6,
        "actions": {"": 1, "like": 1, "share": 1, "view": 2, "zzz": 1},
    }
    assert run.observed["pairs"] == {"rows": 5, "n_interactions": 6}
    assert run.counts.first().asDict() == serving.run_counts(run.pairs, run.neighbours, run.recommendations).first().asDict()


def test_counts_of_an_empty_log(spark, table):
    run = FeedRun(table([], INTERACTIONS), table([], POSTS), FeedConfig())
    assert tuple(run.counts.first()) == (0, 0, 0, 0)


def test_activity_by_action_is_the_activity(table):
    log, weights = table(LOG * 3, INTERACTIONS), FeedConfig().action_weights
    by_action = scoring.pair_activity_by_action(log, weights, "like")
    assert rows(by_action.drop("actions")) == rows(scoring.pair_activity(log, weights, "like"))
    assert rows(serving.actions_of_pairs(by_action)) == rows(serving.action_histogram(log))


def test_metrics_are_counted_at_the_write(spark):
    with Workspace(spark) as work:
        kept = work.keep(spark.range(100), "numbers", total=F.sum("id"))
        assert work.observed == {"numbers": {"rows": 100, "total": 4950}} and kept.count() == 100


def test_daily_sketches_add_up(spark):
    log = spark.range(40_000).select(
        (F.col("id") * 7919 % 9000).alias("user_id"), (F.col("id") % 3).alias("post_id"), (F.col("id") % 11).alias("day")
    )
    log = log.unionByName(log.limit(5).withColumn("user_id", F.lit(None).cast("bigint")))
    daily = trending.users_of_sketches(trending.user_sketches(log, "day"))
    whole = trending.users_of_sketches(trending.user_sketches(log))
    assert rows(daily) == rows(whole)
    exact = {r.post_id: r.n for r in log.groupBy("post_id").agg(F.count_distinct("user_id").alias("n")).collect()}
    for r in daily.collect():
        assert abs(r.approx_users - exact[r.post_id]) <= 0.05 * exact[r.post_id]
    assert daily.agg(F.sum("total_interactions")).first()[0] == 40_005


def test_the_last_row_of_the_last_file_wins(spark, tmp_path):
    schema = "user_id bigint, interest string, age int"
    for i, part in enumerate([[(1, "a", 1), (2, "b", None), (1, "c", 2)], [(2, None, 5)], [(3, "z", 1), (3, "y", 1)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/t/part={i}")
    scanned = files.scan_in_order(spark, f"{tmp_path}/t").drop("part")
    got = last_row_per_key(scanned.repartition(5), "user_id", files.POSITION)
    assert sorted(map(tuple, got.select("user_id", "interest", "age").collect())) == [(1, "c", 2), (2, None, 5), (3, "y", 1)]
    assert got.columns == ["user_id", "interest", "age"]


def weights(table, *periods):
    return table(periods, "action string, weight int, valid_from date, valid_to date")


def test_an_action_has_the_weight_of_its_day(table):
    log = table(
        [
            (1, 1, "like", date(2025, 1, 31)),
            (1, 2, "like", date(2025, 2, 1)),
            (1, 3, "view", date(2020, 1, 1)),
            (1, 4, "share", date(2025, 1, 1)),
            (1, 5, None, date(2025, 1, 1)),
            (1, 6, "like", None),
        ],
        "user_id bigint, post_id bigint, action string, day date",
    )
    own = weights(
        table,
        ("like", 3, date(2025, 1, 1), date(2025, 2, 1)),
        ("like", 7, date(2025, 2, 1), None),
        ("view", 1, None, None),
        ("share", 5, date(2025, 1, 2), None),
        (None, 9, None, None),
    )
    got = rows(scoring.action_scores_by_period(log, own), "post_id", "score")
    assert got == [(1, 3), (2, 7), (3, 1), (4, 0), (5, 0), (6, 0)]


def test_overlapping_weights_are_an_error(table):
    log = table([(1, 1, "like", date(2025, 1, 5))], "user_id bigint, post_id bigint, action string, day date")
    for second in ((date(2025, 1, 31), None), (None, None), (date(2025, 1, 1), date(2025, 1, 2))):
        own = weights(table, ("like", 3, date(2025, 1, 1), date(2025, 2, 1)), ("like", 4, *second))
        with pytest.raises(Exception, match="overlapping weights of like"):
            scoring.action_scores_by_period(log, own).collect()


def test_unreadable_lines_are_kept_with_a_reason(spark, tmp_path):
    lines = ["post_id,topic,creator_id,timestamp", "1,a,2,2025-01-01", "x,a,2,2025-01-01", "3,,,", '4,"b, c",5,2025-13-01', "5,a,7.5,2025-01-01", "6,a,2", "7,a,2,2025-01-01,9", "8,é,2,2025-02-03"]
    (tmp_path / "p.csv").write_text("\n".join(lines))
    good, bad = files.scan_csv_checked(spark, f"{tmp_path}/p.csv", POSTS)
    assert rows(good, "post_id") == [(1,), (3,), (8,)] and good.schema == POSTS
    assert {r.line.split(",")[0]: r.reason for r in bad.collect()} == {
        "x": "post_id", "4": "timestamp", "5": "creator_id", "6": "number of values", "7": "number of values",
    }
    assert rows(files.rejects_by_reason(bad)) == [("creator_id", 1), ("number of values", 2), ("post_id", 1), ("timestamp", 1)]
