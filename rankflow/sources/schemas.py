"""One ``StructType`` per table, and the checks made where data enters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    NullType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _table(*columns: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


_ID, _TEXT = LongType(), StringType()

USERS = _table(
    ("user_id", _ID), ("age", IntegerType()), ("location", _TEXT), ("interest", _TEXT)
)
POSTS = _table(
    ("post_id", _ID), ("topic", _TEXT), ("creator_id", _ID), ("timestamp", DateType())
)
INTERACTIONS = _table(("user_id", _ID), ("post_id", _ID), ("action", _TEXT))
USER_POST_SCORES = _table(("user_id", _ID), ("post_id", _ID), ("total_score", _ID))
SIMILARITY = _table(
    ("user_a", _ID), ("user_b", _ID), ("cosine_similarity", DoubleType())
)
RECOMMENDATIONS = _table(
    ("user_id", _ID),
    ("recommended_post_id", _ID),
    ("avg_similarity", DoubleType()),
    ("recommendation_strength", _ID),
)
TRENDING_POSTS = _table(
    ("post_id", _ID),
    ("total_interactions", _ID),
    ("unique_users", _ID),
    ("total_likes", _ID),
    ("topic", _TEXT),
    ("creator_id", _ID),
    ("timestamp", DateType()),
)
USER_FEED = _table(("user_id", _ID), ("post_id", _ID), ("feed_score", DoubleType()))


#: Columns that rows are joined on; losing one would lose rows.
KEYS = {"user_id", "post_id", "recommended_post_id", "user_a", "user_b"}


def _present(df: DataFrame, names: Sequence[str]) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"missing columns {absent}; found {df.columns}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the columns of ``schema`` in order, with its types.

    A missing column is an error.  A value that cannot be read as its type becomes
    NULL, so that one bad date cannot stop a job; but a key that cannot be read
    stops it, as the rows would be lost in joins without a trace.
    """
    _present(df, schema.names)

    def typed(field: StructField):
        value = F.col(field.name).try_cast(field.dataType)
        if field.name not in KEYS:
            return value.alias(field.name)
        text = F.col(field.name).cast("string")
        bad = F.raise_error(F.concat(F.lit(f"unreadable {field.name}: "), text))
        kept = F.when(value.isNull() & text.isNotNull(), bad.cast(field.dataType))
        return kept.otherwise(value).alias(field.name)

    return df.select(*map(typed, schema.fields))


def require(
    df: DataFrame, schema: StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """The columns of ``schema`` (or those named), if their types lose nothing.

    Narrower integers widen.  A score may be fractional and stays so.  Anything else
    of another type raises ``TypeError`` before a job starts.
    """
    names = list(columns or schema.names)
    _present(df, names)

    def checked(name: str):
        found, wanted = df.schema[name].dataType, schema[name].dataType
        if found == wanted or isinstance(found, NullType):
            return F.col(name).cast(wanted).alias(name)
        if isinstance(wanted, LongType) and isinstance(found, IntegralType):
            return F.col(name).cast(wanted).alias(name)
        if name == "total_score" and isinstance(found, NumericType):
            return F.col(name).cast("double").alias(name)
        if isinstance(wanted, DateType) and isinstance(found, (TimestampType, TimestampNTZType)):
            return F.to_date(name).alias(name)
        raise TypeError(f"{name} is {found.simpleString()}, not {wanted.simpleString()}")

    return df.select(*map(checked, names))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key.

    Rows of a distributed table have no order, so among duplicates the greatest
    row wins, column by column from the left.
    """
    rest = [name for name in df.columns if name != key]
    return (
        df.groupBy(key)
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*(F.col(n) if n == key else F.col(f"_row.{n}").alias(n) for n in df.columns))
    )


def last_row_per_key(df: DataFrame, key: str, position: Sequence[str]) -> DataFrame:
    """One row per key: the last one in the order of the columns ``position``, which are dropped.

    With the columns that :func:`rankflow.sources.files.scan_in_order` adds, that is the last row
    of the last file, as in a load that goes through the files row by row.
    """
    rest = [name for name in df.columns if name != key and name not in position]
    last = F.max_by(F.struct(*rest), F.struct(*position)).alias("_row")
    names = [name for name in df.columns if name not in position]
    return (
        df.groupBy(key)
        .agg(last)
        .select(*(F.col(n) if n == key else F.col(f"_row.{n}").alias(n) for n in names))
    )
