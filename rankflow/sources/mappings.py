"""Views of the star-schema test tables as users, posts and interactions.

Two readings are offered.  *Orders*: a customer interacts with every part on an
order, the order priority being the action.  *Events*: a user interacts with the
part whose key is in the event's JSON properties.  Nothing is filtered out.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.config import FeedConfig


class Inputs:
    """The three input tables of the library and the parameters that suit them.

    Tables are opened when first asked for.
    """

    config: FeedConfig

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder

    def _table(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def _topics(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("post_id"), F.col("p_type").alias("topic")
        )


class OrdersInputs(Inputs):
    """Customers, parts and order lines."""

    config = FeedConfig(
        action_weights={"5-LOW": 1, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5},
        like_action="3-MEDIUM",
        recency_date=date(2001, 12, 31),
    )

    @cached_property
    def interactions(self) -> DataFrame:
        """An interaction per order line."""
        orders = self._table("orders")
        lines = self._table("lineitem")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("post_id"),
            F.col("o_orderpriority").alias("action"),
        )

    @cached_property
    def dated_interactions(self) -> DataFrame:
        """An interaction per order line, on the day of the order."""
        orders = self._table("orders")
        lines = self._table("lineitem")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("post_id"),
            F.col("o_orderpriority").alias("action"),
            F.to_date("o_orderdate").alias("day"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        """Every part, created by its first supplier on the day it first shipped."""
        first_supplied = (
            self._table("lineitem")
            .groupBy(F.col("l_partkey").alias("post_id"))
            .agg(
                F.min("l_suppkey").alias("creator_id"),
                F.to_date(F.min("l_shipdate")).alias("timestamp"),
            )
        )
        return (
            self._topics()
            .join(first_supplied, "post_id", "left")
            .select("post_id", "topic", "creator_id", "timestamp")
        )

    @cached_property
    def users(self) -> DataFrame:
        """Every customer; there is no age."""
        customer, nation = self._table("customer"), self._table("nation")
        return customer.join(
            nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            F.col("c_custkey").alias("user_id"),
            F.lit(None).cast("int").alias("age"),
            F.col("n_name").alias("location"),
            F.col("c_mktsegment").alias("interest"),
        )


class EventsInputs(Inputs):
    """Event users, the parts their events name, and the events."""

    config = FeedConfig(
        action_weights={"view": 1, "click": 3, "signup": 4, "purchase": 5},
        like_action="click",
        recency_date=date(2024, 1, 31),
    )

    @cached_property
    def _events(self) -> DataFrame:
        return self._table("events").select(
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("post_id"),
            F.col("event_type").alias("action"),
            "ts",
        )

    @cached_property
    def interactions(self) -> DataFrame:
        """Every event."""
        return self._events.drop("ts")

    @cached_property
    def dated_interactions(self) -> DataFrame:
        """Every event with its day."""
        return self._events.withColumn("day", F.to_date("ts")).drop("ts")

    @cached_property
    def posts(self) -> DataFrame:
        """Every part, created by its lowest user on the day of its first event, if any."""
        first_seen = self._events.groupBy("post_id").agg(
            F.min("user_id").alias("creator_id"), F.to_date(F.min("ts")).alias("timestamp")
        )
        return self._topics().join(first_seen, "post_id", "left").select(
            "post_id", "topic", "creator_id", "timestamp"
        )

    @cached_property
    def seen_posts(self) -> DataFrame:
        """The parts that an event names: a catalogue that lacks most posts."""
        return self.posts.where(F.col("timestamp").isNotNull())

    @cached_property
    def users(self) -> DataFrame:
        """Every user with an event; nothing else is known."""
        return self._events.select("user_id").distinct().select(
            "user_id",
            F.lit(None).cast("int").alias("age"),
            F.lit(None).cast("string").alias("location"),
            F.lit(None).cast("string").alias("interest"),
        )
