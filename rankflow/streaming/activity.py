"""Pair activity kept up to date as log files arrive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rankflow.functions import action_weight
from rankflow.sources import layout

_KEYS = ["user_id", "post_id"]
_SUMS = ["total_score", "n_interactions", "n_likes"]
_ARRIVED = StructType([StructField(n, LongType()) for n in (*_KEYS, "total_score", "n_likes")])

ACTIVITY = StructType([StructField(n, LongType()) for n in (*_KEYS, *_SUMS)])


class ActivityStore:
    """Activity per (user, post) of all log rows seen so far, under one shared folder.

    :meth:`absorb` takes in what is new in a stream, every row once, also after a failure: the
    checkpoint of the stream and the log of Spark's file sink see to that.  :meth:`merge` adds it
    to the table of pairs as a new version.  The table lies in ``buckets`` buckets of the pair, so
    that only new rows are shuffled; a version holds the names of the files it took in, and counts
    from the moment that list is complete.  The last two versions stay, for those who read the
    older one.  One writer at a time.

    Results equal :func:`rankflow.operators.scoring.pair_activity` of the whole log; rows with no
    user or no post make pairs with NULL, as there.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._buckets = buckets
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *parts: path("/".join((self._folder, *map(str, parts))))
        self._system = self._path().getFileSystem(spark._jsc.hadoopConfiguration())
        for part in ("arrived", "taken", "activity"):
            self._system.mkdirs(self._path(part))

    def absorb(self, log: DataFrame, weights: Mapping[str, int], like_action: str) -> None:
        """Take in all that a stream of ``user_id, post_id, action`` has now, and return."""
        score = action_weight(F.col("action"), weights).cast("bigint")
        liked = F.coalesce(F.col("action") == like_action, F.lit(False)).cast("bigint")
        rows = log.select(*_KEYS, score.alias("total_score"), liked.alias("n_likes"))
        sink = rows.select(*(F.col(f.name).cast(f.dataType) for f in _ARRIVED.fields)).writeStream
        sink = sink.format("parquet").option("path", f"{self._folder}/arrived")
        sink = sink.option("checkpointLocation", f"{self._folder}/checkpoint")
        sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()

    def merge(self) -> int:
        """Add what :meth:`absorb` took in since the last merge; the number of the version."""
        version = self.version()
        new = self._untaken()
        if not new:
            return version
        rows = self._spark.read.schema(_ARRIVED).parquet(*(f"{self._folder}/arrived/{n}" for n in new))
        fresh = rows.groupBy(*_KEYS).agg(
            F.sum("total_score").alias("total_score"),
            F.count(F.lit(1)).alias("n_interactions"),
            F.sum("n_likes").alias("n_likes"),
        )
        merged = _added(self.read(), fresh) if version else fresh
        layout.forget(
            self._spark,
            layout.write_bucketed(merged, f"{self._folder}/activity/{version + 1}", _KEYS, self._buckets),
        )
        names = self._spark.createDataFrame([(n,) for n in new], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{self._folder}/taken/{version + 1}")
        self._system.delete(self._path("activity", version - 1), True)
        return version + 1

    def read(self) -> DataFrame:
        """The pairs of the last version."""
        version = self.version()
        if not version:
            return self._spark.createDataFrame([], ACTIVITY)
        name = layout.register_bucketed(
            self._spark, f"{self._folder}/activity/{version}", ACTIVITY, _KEYS, self._buckets
        )
        return self._spark.table(name)

    def version(self) -> int:
        """The last complete version; 0 before the first merge."""
        listed = (status.getPath().getName() for status in self._system.listStatus(self._path("taken")))
        done = (int(n) for n in listed if self._system.exists(self._path("taken", n, "_SUCCESS")))
        return max(done, default=0)

    def _untaken(self) -> list[str]:
        """Names of the files that the stream has committed and no complete version holds."""
        arrived = self._spark.read.schema(_ARRIVED).parquet(f"{self._folder}/arrived").inputFiles()
        taken: set[str] = set()
        for version in range(1, self.version() + 1):
            listed = self._spark.read.text(f"{self._folder}/taken/{version}")
            taken.update(row.value for row in listed.toLocalIterator())
        return sorted({name.rsplit("/", 1)[-1] for name in arrived} - taken)


def _added(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Sums of two tables of pairs.  The join leaves ``old`` in its buckets; NULL keys never meet in a join and are grouped."""
    whole = F.col("user_id").isNotNull() & F.col("post_id").isNotNull()
    a, b = old.where(whole).alias("a"), fresh.where(whole).alias("b")
    nothing = F.lit(0).cast("bigint")
    sums = [
        (F.coalesce(f"a.{n}", nothing) + F.coalesce(f"b.{n}", nothing)).alias(n) for n in _SUMS
    ]
    joined = a.join(b, _KEYS, "full").select(*_KEYS, *sums)
    rest = old.where(~whole).unionByName(fresh.where(~whole))
    return joined.unionByName(rest.groupBy(*_KEYS).agg(*(F.sum(n).alias(n) for n in _SUMS)))
