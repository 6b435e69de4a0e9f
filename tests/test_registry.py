"""The registered queries against SQL, and their plans."""

import pytest
from conftest import SMALL, plan

import __spark_entry__ as contract
from checks.compare import difference, duck, type_difference
from checks.oracle import all_sql
from checks.queries import all_queries
from rankflow.operators import feed as feed_ops
from rankflow.operators import neighbours, scoring, trending
from rankflow.plans.jobs import FeedRun
from rankflow.sources import schemas
from rankflow.sources.mappings import EventsInputs, OrdersInputs

WITHOUT_SQL = {"result_freshness"}


@pytest.fixture(scope="module")
def tables():
    return duck(SMALL)


def test_every_query_has_sql():
    assert all_queries().keys() - all_sql().keys() == WITHOUT_SQL
    assert not all_sql().keys() - all_queries().keys()
    assert contract.queries().keys() >= all_queries().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, tables, name):
    result = contract.queries()[name](spark, SMALL)
    if name in WITHOUT_SQL:
        assert result.count() > 0
        return
    sql = contract.oracle_sql()[name]
    assert difference(result, tables, sql) is None
    assert type_difference(result, tables, sql) is None


def test_entry(spark):
    result = contract.entry(spark)
    assert result.schema == schemas.USER_FEED
    assert result.count() > 0


def test_stored_tables_of_a_run_change_nothing(spark):
    """Recommendations given as a table equal those computed within the run."""
    i = EventsInputs(spark, SMALL)
    whole = FeedRun(i.interactions, i.posts, i.config)
    given = FeedRun(
        i.interactions, i.posts, i.config,
        scores=whole.scores, recommended=whole.recommendations,
    )
    assert sorted(whole.feed.collect()) == sorted(given.feed.collect())


def test_feed_properties(spark):
    i = OrdersInputs(spark, SMALL)
    run = FeedRun(i.interactions, i.posts, i.config)
    feed = run.feed.cache()
    assert feed.groupBy("user_id").count().where("count > 10").isEmpty()
    assert feed.select("user_id", "post_id").distinct().count() == feed.count()
    popularity = run.popularity.agg({"popularity_score": "max"}).first()[0]
    assert popularity == 1.0
    seen = run.recommendations.withColumnRenamed("recommended_post_id", "post_id").join(
        run.scores, ["user_id", "post_id"], "left_semi"
    )
    assert seen.isEmpty()
    feed.unpersist()


def test_plans_have_no_python_and_no_cartesian_product(spark):
    i = OrdersInputs(spark, SMALL)
    run = FeedRun(i.interactions, i.posts, i.config)
    for text in (plan(run.feed), plan(run.recommendations), plan(run.trending)):
        for word in ("CartesianProduct", "NestedLoop", "Python", "InPandas", "InArrow"):
            assert word not in text
    assert "WindowGroupLimit" in plan(run.feed)


def test_ranking_limits_groups_before_the_shuffle(spark, table):
    near = neighbours.top_similar_users(table([(1, 2, 0.5)], schemas.SIMILARITY), 10)
    ranked = feed_ops.touched_feed(table([(1, 2, 0.5)], schemas.USER_FEED), 10)
    for text in (plan(near), plan(ranked)):
        above, shuffle = text.index("WindowGroupLimit"), text.index("Exchange")
        assert text.rindex("WindowGroupLimit") > shuffle > above


def test_counts_combine_before_the_shuffle(spark):
    i = OrdersInputs(spark, SMALL)
    c = i.config
    pairs = scoring.pair_activity(i.interactions, c.action_weights, c.like_action)
    text = plan(trending.trending_counts(pairs))
    assert text.count("partial_sum") >= 2
    assert "Expand" not in text


def test_scans_read_only_what_is_used(spark):
    i = OrdersInputs(spark, SMALL)
    text = plan(scoring.user_post_scores(i.interactions, i.config.action_weights))
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in text


def test_condition_on_users_reaches_the_scan(spark):
    result = contract.queries()["feed_for_users"](spark, SMALL)
    assert "PushedFilters: [In(user_id, [1,2,3])]" in plan(result)
