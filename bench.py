"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  A time covers building
the query, all tables it stores on the way, and computing every row of the result
from the raw tables.  Each query runs ``BENCH_RUNS`` times (2 by default) on those very
tables, and the fastest counts: steps that smaller tables never reach, and the
compilation of their code, fall to the first run.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import all_queries

_HEADLINE = (
    "user_post_scores",
    "trending_posts",
    "trending_top20",
    "popularity_scores",
    "recency_scores",
    "interaction_scores",
    "top_similar_users",
    "top_similar_users_events",
    "top_similar_users_heavy_posts_events",
    "recommendations",
    "recommendations_events",
    "feed_without_recs",
    "feed_from_raw",
    "user_feed_events",
    "system_stats",
)


def _compute(query, spark: SparkSession, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rankflow-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    seconds: dict[str, float] = {}
    for name in chosen.split(",") if chosen else _HEADLINE:
        seconds[name] = round(
            min(_compute(queries[name], spark, folder) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "total_time_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
