"""Scans and sinks over Spark's own file sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


ColumnOrName = Column | str


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A headed CSV file, or a directory of part files.

    Without ``schema`` Spark infers one, at the price of a second pass.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet file or directory."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


#: Where a row stands in the files of a parquet table.
POSITION = ("file_path", "row_index")


def scan_in_order(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A parquet file or directory with each row's ``file_path`` and ``row_index`` in that file.

    Files go by name.  Both come from the file source, so reading stays parallel.
    """
    scanned = scan_parquet(spark, path, schema)
    place = (F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    return scanned.select("*", *place)


def scan_csv_checked(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Headed CSV as (rows that read as ``schema``, rejected lines as ``line, reason``).

    A line is rejected where a value does not read as its column's type, or where it has more or
    fewer values than columns.  ``reason`` is ``number of values`` or else the first such column.
    Either table is one parallel scan of the files; values are read as text and cast.
    """
    corrupt = "_corrupt_line"
    text = [StructField(name, StringType()) for name in (*schema.names, corrupt)]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    scanned = reader.option("columnNameOfCorruptRecord", corrupt).schema(StructType(text)).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    unread = (F.when(F.col(n).isNotNull() & value.isNull(), n) for n, value in typed.items())
    reason = F.coalesce(F.when(F.col(corrupt).isNotNull(), "number of values"), *unread)
    judged = scanned.withColumn("_reason", reason)
    good = judged.where(F.col("_reason").isNull()).select(*(v.alias(n) for n, v in typed.items()))
    line = F.coalesce(F.col(corrupt), F.to_csv(F.struct(*schema.names)))
    return good, judged.where(F.col("_reason").isNotNull()).select(line.alias("line"), F.col("_reason").alias("reason"))


def rejects_by_reason(rejected: DataFrame) -> DataFrame:
    """Number of rejected lines per reason."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def ordered(df: DataFrame, order_by: Sequence[ColumnOrName]) -> DataFrame:
    """Ranges of the order in successive partitions, each sorted; no task holds it all."""
    return df.repartitionByRange(*order_by).sortWithinPartitions(*order_by) if order_by else df


def write_csv(
    df: DataFrame,
    path: str,
    *,
    single_file: bool = False,
    order_by: Sequence[ColumnOrName] = (),
) -> None:
    """Headed CSV, replacing ``path``; ``single_file`` is for small reports only.

    With ``order_by`` the rows follow that order within a file and from file to file.
    """
    df = ordered(df, order_by)
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)


def write_parquet(df: DataFrame, path: str, *, order_by: Sequence[ColumnOrName] = ()) -> None:
    """Parquet, replacing ``path``; ``order_by`` as in :func:`write_csv`."""
    ordered(df, order_by).write.mode("overwrite").parquet(path)


def result_freshness(spark: SparkSession, path: str) -> DataFrame:
    """When the files under ``path`` last changed; ``Never`` when there are none.

    Only the file listing is read: the content column is pruned.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select("modificationTime")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "modificationTime timestamp")
    newest = F.date_format(F.max("modificationTime"), "yyyy-MM-dd HH:mm:ss")
    return files.agg(F.coalesce(newest, F.lit("Never")).alias("last_sync"))
