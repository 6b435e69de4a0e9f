"""The registered queries in SQL, written from the definitions of the operators."""

from __future__ import annotations

from checks.queries import WEIGHT_PERIODS


def _r4(x: str) -> str:
    # Rounds the shortest decimal text half up, as Spark does.
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,20)), 4) as double)"


def _weights(weights: dict[str, int]) -> str:
    cases = " ".join(f"when '{name}' then {weight}" for name, weight in weights.items())
    return f"case action {cases} else 0 end"


class _Mapping:
    """Named subqueries of one reading of the tables."""

    def __init__(self, interactions, posts, users, weights, like, reference):
        score = _weights(weights)
        self.parts = {
            "interactions": interactions,
            "posts": posts,
            "users": users,
            "scored": f"select user_id, post_id, action, {score} as score from interactions",
            "scores": "select user_id, post_id, cast(sum(score) as bigint) as total_score "
            "from scored group by user_id, post_id",
            "norms": "select user_id, cast(sum(total_score * total_score) as bigint) as norm2 "
            "from scores group by user_id",
            "pairs": "select a.user_id as user_a, b.user_id as user_b, "
            "cast(sum(a.total_score * b.total_score) as bigint) as dot_product, "
            "count(*) as shared_posts "
            "from scores a join scores b on a.post_id = b.post_id and a.user_id < b.user_id "
            "group by a.user_id, b.user_id",
            "similarity": "select user_a, user_b, "
            "dot_product / (sqrt(m.norm2) * sqrt(n.norm2)) as cosine_similarity "
            "from pairs join norms m on user_a = m.user_id join norms n on user_b = n.user_id "
            "where m.norm2 > 0 and n.norm2 > 0",
            "edges": "select user_a as user_id, user_b as similar_user, cosine_similarity "
            "from similarity union all select user_b, user_a, cosine_similarity from similarity",
            "neighbours": "select user_id, similar_user, cosine_similarity from edges "
            "qualify row_number() over (partition by user_id "
            "order by cosine_similarity desc, similar_user) <= 10",
            "candidates": "select n.user_id, s.post_id as recommended_post_id, "
            "n.cosine_similarity, s.total_score as sim_user_score "
            "from neighbours n join scores s on n.similar_user = s.user_id",
            "unseen": "select c.* from candidates c where not exists (select 1 from scores s "
            "where s.user_id = c.user_id and s.post_id = c.recommended_post_id)",
            "recommended": "select user_id, recommended_post_id, "
            f"{_r4('avg(cosine_similarity)')} as avg_similarity, "
            "cast(sum(sim_user_score) as bigint) as recommendation_strength "
            "from unseen group by user_id, recommended_post_id",
            "counts": "select post_id, count(*) as total_interactions, "
            "count(distinct user_id) as unique_users, "
            f"count(*) filter (where action = '{like}') as total_likes "
            "from interactions group by post_id",
            "trending": "select c.*, topic, creator_id, timestamp from counts c "
            "join posts using (post_id)",
            "top20": "select * from trending order by total_interactions desc, post_id limit 20",
            "popularity": "select post_id, total_interactions as n_interactions, "
            + _r4(
                "(total_interactions - min(total_interactions) over ()) / "
                "coalesce(nullif(max(total_interactions) over () "
                "- min(total_interactions) over (), 0), 1)"
            )
            + " as popularity_score from counts",
            "aged": "select post_id, topic, "
            f"date_diff('day', timestamp, date '{reference}') as days_old from posts",
            "recency": "select post_id, topic, "
            + _r4(
                "1.0::double - (days_old - min(days_old) over ()) / "
                "coalesce(nullif(max(days_old) over () - min(days_old) over (), 0), 1)"
            )
            + " as recency_score from aged",
            "interaction": "select user_id, post_id, coalesce("
            + _r4("total_score / nullif(max(total_score) over (partition by user_id), 0)")
            + ", 0.0::double) as interaction_score from scores",
            "chosen": "select user_id, post_id, interaction_score from interaction "
            "union all select user_id, recommended_post_id, 0.5::double from recommended",
            "signalled": "select user_id, post_id, interaction_score, "
            "coalesce(popularity_score, 0.0::double) as popularity_score, "
            "coalesce(recency_score, 0.0::double) as recency_score "
            "from chosen left join popularity using (post_id) left join recency using (post_id)",
            "feed_scored": "select user_id, post_id, "
            + _r4(
                "0.5::double * interaction_score + 0.3::double * popularity_score "
                "+ 0.2::double * recency_score"
            )
            + " as feed_score from signalled",
            "best": "select user_id, post_id, max(feed_score) as feed_score "
            "from feed_scored group by user_id, post_id",
            "feed": "select user_id, post_id, feed_score from best "
            "qualify row_number() over (partition by user_id "
            "order by feed_score desc, post_id) <= 10",
        }

    def sql(self, final: str, **replaced: str) -> str:
        parts = self.parts | replaced
        return "with " + ",\n".join(f"{n} as ({q})" for n, q in parts.items()) + f"\n{final}"


_ORDERS_WEIGHTS = {"5-LOW": 1, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}
_EVENTS_WEIGHTS = {"view": 1, "click": 3, "signup": 4, "purchase": 5}

_ORDERS = _Mapping(
    interactions="select o_custkey as user_id, l_partkey as post_id, o_orderpriority as action "
    "from lineitem join orders on l_orderkey = o_orderkey",
    posts="select p_partkey as post_id, p_type as topic, creator_id, timestamp from part "
    "left join (select l_partkey, min(l_suppkey) as creator_id, "
    "cast(min(l_shipdate) as date) as timestamp from lineitem group by l_partkey) "
    "on l_partkey = p_partkey",
    users="select c_custkey as user_id, n_name as location, c_mktsegment as interest "
    "from customer left join nation on c_nationkey = n_nationkey",
    weights=_ORDERS_WEIGHTS,
    like="3-MEDIUM",
    reference="2001-12-31",
)

_EVENT_LOG = (
    "select user_id, cast(json_extract_string(props, '$.k') as bigint) as post_id, "
    "event_type as action, ts from events"
)
_EVENT_POSTS = (
    "select p_partkey as post_id, p_type as topic, creator_id, timestamp from part left join "
    "(select post_id, min(user_id) as creator_id, cast(min(ts) as date) as timestamp "
    f"from ({_EVENT_LOG}) group by post_id) e on p_partkey = e.post_id"
)
_SEEN_POSTS = f"select * from ({_EVENT_POSTS}) where timestamp is not null"
_REPEATED_POSTS = (
    "select post_id, topic, creator_id, timestamp from "
    "(select p_partkey as post_id, p_type as topic, l_suppkey as creator_id, "
    "cast(l_shipdate as date) as timestamp from part join lineitem on l_partkey = p_partkey)"
)
_POST_DIRECTORY = (
    "select post_id, topic, creator_id, timestamp from (select * from first_posts "
    f"union all {_REPEATED_POSTS}) qualify row_number() over (partition by post_id order by "
    "topic desc nulls last, creator_id desc nulls last, timestamp desc nulls last) = 1"
)
_USER_DIRECTORY = (
    "select user_id, location, interest from (select * from users union all "
    "select user_id, location, o_orderpriority from users join orders on o_custkey = user_id) "
    "qualify row_number() over (partition by user_id order by location desc nulls last, "
    "interest desc nulls last) = 1"
)
_EVENTS = _Mapping(
    interactions=_EVENT_LOG,
    posts=_EVENT_POSTS,
    users="select distinct user_id from events",
    weights=_EVENTS_WEIGHTS,
    like="click",
    reference="2024-01-31",
)


_SIMILAR_PAIRS = (
    "select user_a, user_b, dot_product, shared_posts, cosine_similarity from pairs "
    "join similarity using (user_a, user_b) where cosine_similarity >= {}::double"
)
_PERIODS = ", ".join(
    f"('{a}', {w}, date '{f or '0001-01-01'}', date '{t or '9999-12-31'}')"
    for a, f, t, w in WEIGHT_PERIODS
)


def all_sql() -> dict[str, str]:
    """SQL by query name."""
    orders, events = _ORDERS.sql, _EVENTS.sql

    def directory(final: str) -> str:
        first = {"first_posts": _ORDERS.parts["posts"]}
        parts = first | _ORDERS.parts | {"posts": _POST_DIRECTORY}
        return "with " + ",\n".join(f"{n} as ({q})" for n, q in parts.items()) + f"\n{final}"

    top_of = "order by total_interactions desc, post_id"
    neighbours = "select * from neighbours"
    foreign = _ORDERS.sql("select user_id, recommended_post_id from recommended")
    return {
        "scan_csv_roundtrip": orders("select * from scores"),
        "scan_csv_inferred": orders("select * from trending"),
        "action_scores": orders("select user_id, post_id, action, score from scored"),
        "user_post_scores": orders("select * from scores"),
        "user_post_scores_events": events("select * from scores"),
        "matrix_dimensions": orders(
            "select count(distinct user_id) as n_users, count(distinct post_id) as n_posts "
            "from scores"
        ),
        "co_interaction_pairs": orders("select user_a, user_b, shared_posts from pairs"),
        "pair_dot_products": orders("select user_a, user_b, dot_product from pairs"),
        "user_magnitudes": orders("select user_id, sqrt(norm2) as magnitude from norms"),
        "user_similarity": orders("select * from similarity"),
        "user_similarity_events": events("select * from similarity"),
        "similarity_bidirectional": orders("select * from edges"),
        "most_similar_pairs": orders(
            "select * from similarity order by cosine_similarity desc, user_a, user_b limit 10"
        ),
        "similar_pairs": orders(_SIMILAR_PAIRS.format(0.2)),
        "similar_pairs_events": events(_SIMILAR_PAIRS.format(0.6)),
        "pairs_sharing_posts": orders(
            "select user_a, user_b, shared_posts from pairs where shared_posts >= 3"
        ),
        "top_similar_users": orders(neighbours),
        "top_similar_users_events": events(neighbours),
        "top_similar_users_heavy_posts": orders(neighbours),
        "top_similar_users_heavy_posts_events": events(neighbours),
        "top_similar_users_of_table": orders(neighbours),
        "neighbour_candidates": orders("select * from candidates"),
        "unseen_candidates": orders("select * from unseen"),
        "recommendations": orders("select * from recommended"),
        "recommendations_events": events("select * from recommended"),
        "post_counts": orders(
            "select post_id, total_interactions as n_interactions from counts"
        ),
        "trending_counts": orders("select * from counts"),
        "trending_posts": orders("select * from trending"),
        "trending_posts_events": events("select * from trending"),
        "trending_partial_catalogue": orders("select * from trending", posts=_SEEN_POSTS),
        "trending_top20": orders("select * from top20"),
        "trending_cards": orders(
            f"select cast(row_number() over ({top_of}) as integer) as place, post_id, topic, "
            "total_interactions, case when max(total_interactions) over () > 0 "
            "then total_interactions / max(total_interactions) over () * 100 else 0.0::double "
            "end as relative_activity from top20"
        ),
        "popularity_scores": orders("select * from popularity"),
        "recency_scores": orders("select * from recency"),
        "recency_scores_events": events("select * from recency"),
        "interaction_scores": orders("select * from interaction"),
        "feed_candidates": orders("select * from signalled"),
        "feed_scores": orders("select * from feed_scored"),
        "feed_best_scores": orders("select * from best"),
        "feed_from_raw": orders("select * from feed"),
        "user_feed": orders("select * from feed"),
        "user_feed_events": events("select * from feed"),
        "feed_without_recs": orders("select * from feed", chosen="select * from interaction"),
        "feed_missing_signals": events("select * from feed", recommended=foreign),
        "user_feed_bucketed": orders("select * from feed"),
        "unseen_candidates_bucketed": orders("select * from unseen"),
        "feed_of_user_table": orders(
            "select * from feed where user_id in "
            "(select c_custkey from customer where c_acctbal < -900)"
        ),
        "incremental_activity": events(
            "select user_id, post_id, cast(sum(score) as bigint) as total_score, "
            "count(*) as n_interactions, count(*) filter (where action = 'click') as n_likes "
            "from scored group by user_id, post_id"
        ),
        "feed_for_users": orders("select * from feed where user_id in (1, 2, 3)"),
        "feed_coverage": orders(
            "select count(*) as n_entries, count(distinct user_id) as n_users from feed"
        ),
        "feed_lists": orders(
            "select user_id, count(post_id) as n_posts, coalesce(string_agg("
            "cast(post_id as varchar), ',' order by feed_score desc, post_id), '') "
            "as recommended_posts from users left join feed using (user_id) group by user_id"
        ),
        "feed_detailed": orders(
            "select user_id, location, interest, post_id, feed_score, "
            "coalesce(topic, 'Unknown') as topic, creator_id, timestamp from feed "
            "left join posts using (post_id) left join users using (user_id)"
        ),
        "feed_detailed_unknown_posts": orders(
            "select user_id, post_id, feed_score, coalesce(topic, 'Unknown') as topic, "
            "coalesce(cast(creator_id as varchar), 'Unknown') as creator_id, "
            "coalesce(cast(timestamp as varchar), 'Unknown') as timestamp "
            "from feed left join catalogue using (post_id)",
            catalogue=_SEEN_POSTS,
        ),
        "feed_cards": orders(
            "select user_id, cast(row_number() over (partition by user_id "
            "order by feed_score desc, post_id) as integer) as place, post_id, feed_score, "
            "case when max(feed_score) over (partition by user_id) > 0 then "
            "feed_score / max(feed_score) over (partition by user_id) * 100 "
            "else 0.0::double end as relative_score from feed"
        ),
        "action_histogram": orders(
            "select action, count(*) as n_interactions from interactions group by action"
        ),
        "system_stats": orders(
            "select (select count(*) from users) as total_users, "
            "(select count(distinct user_id) from feed) as users_with_feeds, "
            "(select count(*) from trending) as total_trending_posts, "
            "cast(sum(n) as bigint) as total_interactions, "
            "string_agg(action || '=' || cast(n as varchar), ';' order by action) as actions "
            "from (select coalesce(action, '') as action, count(*) as n "
            "from interactions group by 1)"
        ),
        "user_directory": orders(_USER_DIRECTORY),
        "duplicate_posts": orders(
            f"select post_id, count(*) as n_rows from (select * from posts union all "
            f"{_REPEATED_POSTS}) group by post_id having count(*) > 1"
        ),
        "post_directory": directory("select * from posts"),
        "feed_duplicate_posts": directory("select * from feed"),
        "neighbour_products": orders(
            "select p.user_a, p.user_b, dot_product, shared_posts, cosine_similarity "
            "from pairs p join similarity s on p.user_a = s.user_a and p.user_b = s.user_b "
            "where exists (select 1 from neighbours n where "
            "(n.user_id = p.user_a and n.similar_user = p.user_b) or "
            "(n.user_id = p.user_b and n.similar_user = p.user_a))"
        ),
        "action_scores_by_period": (
            "select o_custkey as user_id, l_partkey as post_id, "
            "cast(sum(coalesce(weight, 0)) as bigint) as total_score from lineitem "
            "join orders on l_orderkey = o_orderkey "
            f"left join (values {_PERIODS}) as w(action, weight, valid_from, valid_to) "
            "on action = o_orderpriority and cast(o_orderdate as date) >= valid_from "
            "and cast(o_orderdate as date) < valid_to group by o_custkey, l_partkey"
        ),
        "approximate_users": events(
            "select post_id, total_interactions, unique_users, true as within_a_tenth from counts"
        ),
        "directory_last_wins": (
            "select o_custkey as user_id, o_orderpriority as interest, o_orderkey from orders "
            "qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1"
        ),
        "csv_rows_accepted": orders("select * from posts where post_id % 50 not in (3, 7, 11)"),
        "csv_rows_rejected": orders(
            "select case post_id % 50 when 7 then 'creator_id' else 'timestamp' end as reason, "
            "count(*) as n_lines from posts where post_id % 50 in (3, 7, 11) group by 1"
        ),
        "run_counts": orders(
            "select (select count(*) from interactions) as n_interactions, "
            "(select count(*) from scores) as n_pairs, "
            "(select count(distinct user_id) from neighbours) as n_users_with_neighbours, "
            "(select count(*) from recommended) as n_recommendations"
        ),
    }
