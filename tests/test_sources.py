from datetime import date

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from rankflow.sources import files, schemas
from rankflow.sources.workspace import Workspace, shared_folder

DAY = date(2025, 6, 1)
POSTS = [(7, "AI, or \"so\"", 4, DAY), (8, None, 5, None)]


def test_csv_round_trip_with_schema(spark, table, tmp_path):
    path = str(tmp_path / "posts")
    files.write_csv(table(POSTS, schemas.POSTS).repartition(2), path)
    assert rows(files.scan_csv(spark, path, schemas.POSTS)) == sorted(POSTS, key=repr)


def test_csv_inferred_single_file_and_overwrite(spark, table, tmp_path):
    path = tmp_path / "feed"
    for _ in range(2):
        files.write_csv(
            table([(1, 7, 0.5), (2, 8, 0.25)], schemas.USER_FEED).repartition(2),
            str(path),
            single_file=True,
        )
    parts = list(path.glob("part-*.csv"))
    assert len(parts) == 1
    assert rows(files.scan_csv(spark, str(path))) == [(1, 7, 0.5), (2, 8, 0.25)]
    assert rows(files.scan_csv(spark, str(parts[0]))) == [(1, 7, 0.5), (2, 8, 0.25)]


def test_parquet_round_trip(spark, table, tmp_path):
    path = str(tmp_path / "posts")
    files.write_parquet(table(POSTS, schemas.POSTS), path)
    assert rows(files.scan_parquet(spark, path, schemas.POSTS)) == sorted(POSTS, key=repr)
    assert files.scan_parquet(spark, path).schema == schemas.POSTS


def test_conform_orders_types_and_forgives_bad_values(table):
    raw = table([("x", "2025-06-01", "7", "AI"), ("4", "no date", "8", None)],
                "creator_id string, timestamp string, post_id string, topic string")
    typed = schemas.conform(raw, schemas.POSTS)
    assert typed.columns == schemas.POSTS.names
    assert rows(typed) == [(7, "AI", None, DAY), (8, None, 4, None)]
    with pytest.raises(ValueError, match="topic"):
        schemas.conform(raw.drop("topic"), schemas.POSTS)


def test_conform_never_loses_a_key(table):
    raw = table([("1", "x", "like")], "user_id string, post_id string, action string")
    with pytest.raises(Exception, match="unreadable post_id: x"):
        schemas.conform(raw, schemas.INTERACTIONS).collect()
    none = table([("1", None, "like")], "user_id string, post_id string, action string")
    assert rows(schemas.conform(none, schemas.INTERACTIONS)) == [(1, None, "like")]


def test_require_widens_and_refuses(table):
    narrow = table([(1, 2, 3)], "user_id int, post_id bigint, total_score int")
    assert schemas.require(narrow, schemas.USER_POST_SCORES).schema == schemas.USER_POST_SCORES
    halves = table([(1, 2, 0.5)], "user_id bigint, post_id bigint, total_score double")
    assert rows(schemas.require(halves, schemas.USER_POST_SCORES)) == [(1, 2, 0.5)]
    text = table([("1", 2, 3)], "user_id string, post_id bigint, total_score bigint")
    with pytest.raises(TypeError, match="user_id is string"):
        schemas.require(text, schemas.USER_POST_SCORES)
    with pytest.raises(ValueError, match="total_score"):
        schemas.require(halves.drop("total_score"), schemas.USER_POST_SCORES)


def test_ordered_export(spark, table, tmp_path):
    path = str(tmp_path / "ordered")
    feed = table([(i % 50, i, float(i % 7)) for i in range(500)], schemas.USER_FEED)
    files.write_csv(feed.repartition(5), path, order_by=["user_id", F.desc("feed_score")])
    assert "rangepartitioning" in plan(files.ordered(feed, ["user_id"]))
    got = [
        tuple(map(float, line.split(",")))
        for part in sorted((tmp_path / "ordered").glob("part-*.csv"))
        for line in part.read_text().splitlines()[1:]
    ]
    assert len(got) == 500
    assert [(u, -s) for u, _, s in got] == sorted((u, -s) for u, _, s in got)


def test_duplicates_are_found_and_reduced_to_one_row(table):
    users = table([(1, 20, "UK", "AI"), (1, 30, "India", "Food"), (2, 40, "UK", None)],
                  schemas.USERS)
    assert rows(schemas.duplicate_keys(users, "user_id")) == [(1, 2)]
    assert rows(schemas.one_row_per_key(users, "user_id")) == [
        (1, 30, "India", "Food"), (2, 40, "UK", None),
    ]


def test_freshness(spark, table, tmp_path):
    path = str(tmp_path / "feed")
    assert rows(files.result_freshness(spark, path)) == [("Never",)]
    files.write_csv(table([(1, 7, 0.5)], schemas.USER_FEED), path)
    (stamp,) = rows(files.result_freshness(spark, path))[0]
    assert stamp.startswith("20") and len(stamp) == 19


def test_workspace_uses_the_folder_of_the_session(spark, table):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    work = Workspace(spark)
    kept = work.keep(table(POSTS, schemas.POSTS), "posts")
    assert work.path("posts").startswith(folder)
    assert kept.schema == schemas.POSTS
    assert rows(kept) == sorted(POSTS, key=repr)
    assert all(work.path("posts") in f for f in kept.inputFiles())


def test_a_closed_workspace_leaves_nothing(spark, table, tmp_path):
    other = tmp_path / "rankflow" / "other"
    other.mkdir(parents=True)
    with Workspace(spark, str(tmp_path)) as work:
        work.keep(table(POSTS, schemas.POSTS), "posts")
        assert len(list((tmp_path / "rankflow").iterdir())) == 2
    assert list((tmp_path / "rankflow").iterdir()) == [other]


def test_workspace_without_a_setting_stays_in_the_warehouse(spark, monkeypatch):
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    monkeypatch.setattr("rankflow.sources.workspace._SETTING", "spark.no.such.setting")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    assert shared_folder(spark) == warehouse


def test_workspace_without_a_shared_folder_persists(spark, table, monkeypatch):
    monkeypatch.setattr("rankflow.sources.workspace.shared_folder", lambda spark: None)
    work = Workspace(spark)
    kept = work.keep(table(POSTS, schemas.POSTS), "posts")
    assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
    assert rows(kept) == sorted(POSTS, key=repr)
    kept.unpersist()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work.path("posts")
