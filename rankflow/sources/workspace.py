"""Intermediate tables in the shared folder of the cluster.

A job that reads one intermediate result several times writes it once as parquet
and goes on from the files.  That cuts lineage, survives the loss of executors
and gives the optimizer the true size of the table, so that it broadcasts a side
only when the files say it is small.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankflow.sources import layout

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str | None:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local-mode session, whose one machine holds all executors,
    gets the session's warehouse folder, or Java's own if that cannot be made; a
    cluster session gets ``None``, since a folder of one machine is useless to the
    rest.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.split("[")[0] == "local":
        folder = spark.conf.get("spark.sql.warehouse.dir")
        if not _can_make(spark, folder):
            folder = "file://" + spark._jvm.java.lang.System.getProperty("java.io.tmpdir")
    return folder or None


def _path_and_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _can_make(spark: SparkSession, folder: str) -> bool:
    path, system = _path_and_system(spark, folder)
    try:
        return system.mkdirs(path)
    except Exception:  # any refusal of the file system, as Java reports it
        return False


class Workspace:
    """A fresh subfolder of the shared folder for the tables of one job run.

    ``close()``, or the end of a ``with`` block, removes that subfolder and nothing
    else; tables kept there cannot be read afterwards.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        base = folder or shared_folder(spark)
        self._spark = spark
        self._root = f"{base.rstrip('/')}/rankflow/{uuid.uuid4().hex}" if base else None
        self._persisted: list[DataFrame] = []
        self._catalogued: list[str] = []
        #: What :meth:`keep` counted of each table.
        self.observed: dict[str, dict[str, int]] = {}

    def path(self, name: str) -> str:
        """Where the table ``name`` lives."""
        if self._root is None:
            raise ValueError(f"set {_SETTING} to a folder all executors can reach")
        return f"{self._root}/{name}"

    def keep(self, df: DataFrame, name: str, **metrics: Column) -> DataFrame:
        """``df`` written out and read back; persisted if there is no folder.

        Aggregates given as ``metrics`` are computed on the rows as they are written, with their
        number as ``rows``, and end up in ``observed[name]``: no job of their own counts them.
        """
        if self._root is None:
            self._persisted.append(df.persist(StorageLevel.DISK_ONLY))
            if metrics:
                counted = self._persisted[-1].agg(*self._aliased(metrics)).first()
                self.observed[name] = counted.asDict()
            return self._persisted[-1]
        if metrics:
            seen = Observation()
            df.observe(seen, *self._aliased(metrics)).write.parquet(self.path(name))
            self.observed[name] = seen.get
        else:
            df.write.parquet(self.path(name))
        return self._spark.read.schema(df.schema).parquet(self.path(name))

    def keep_bucketed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """:meth:`keep` in ``buckets`` buckets of the hash of ``keys``.

        See :func:`rankflow.sources.layout.write_bucketed` for what that saves.  Without a folder
        the rows are dealt alike and persisted.
        """
        if self._root is None:
            return self.keep(df.repartition(buckets, *keys), name)
        self._catalogued.append(layout.write_bucketed(df, self.path(name), keys, buckets))
        return self._spark.table(self._catalogued[-1])

    def keep_partitioned(self, df: DataFrame, name: str, by: str, parts: int) -> DataFrame:
        """:meth:`keep` with a folder per value of ``by``, so that a condition on it skips files."""
        if self._root is None:
            return self.keep(df.repartition(parts, by), name)
        layout.write_partitioned(df, self.path(name), by, parts)
        return self._spark.read.schema(df.schema).parquet(self.path(name))

    @staticmethod
    def _aliased(metrics: dict[str, Column]) -> list[Column]:
        return [F.count(F.lit(1)).alias("rows"), *(column.alias(n) for n, column in metrics.items())]

    def close(self) -> None:
        """Drop all tables of this run."""
        for df in self._persisted:
            df.unpersist()
        self._persisted = []
        for table in self._catalogued:
            layout.forget(self._spark, table)
        self._catalogued = []
        if self._root is not None:
            path, system = _path_and_system(self._spark, self._root)
            system.delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()
