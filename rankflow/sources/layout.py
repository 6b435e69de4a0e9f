"""Parquet tables laid out for the joins and the look-ups that will read them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fresh_name() -> str:
    return f"rankflow_{uuid.uuid4().hex}"


#: Entries of arrays in one bucket, about: what a task sorts without spilling.
BUCKET_ENTRIES = 16_000_000


def enough_buckets(entries: int, least: int) -> int:
    """``least`` buckets, and more where one would have more than ``BUCKET_ENTRIES`` of the entries."""
    return max(least, -(-entries // BUCKET_ENTRIES))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> str:
    """Write ``df`` to ``path`` in ``buckets`` buckets of the hash of ``keys``; the catalog name it got.

    Rows are dealt by the hash that also names the bucket, so a bucket is one file, sorted by
    ``keys``.  Joins and aggregates on exactly ``keys`` then shuffle neither this table nor
    another one with as many buckets.  Choose keys that spread: all rows of one key value share a
    bucket, and a bucket is read by one task.
    """
    name = _fresh_name()
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def register_bucketed(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int
) -> str:
    """Catalog name for what :func:`write_bucketed` wrote to ``path``, maybe in another session.

    ``schema``, ``keys`` and ``buckets`` must be those of the write.
    """
    name = _fresh_name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{key}`" for key in keys)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return name


def forget(spark: SparkSession, name: str) -> None:
    """Drop the catalog entry ``name``; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_partitioned(df: DataFrame, path: str, by: str, parts: int) -> None:
    """Write ``df`` with a folder per value of ``by``, of which there are about ``parts``."""
    df.repartition(parts, by).write.mode("overwrite").partitionBy(by).parquet(path)
