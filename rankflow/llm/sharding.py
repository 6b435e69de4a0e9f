"""Documents dealt to shards by extendible hashing.

The directory is indexed by leading bits of a hash.  A bucket that is over the byte limit is
split on its next bit, all others stay as they are, so that every shard fits.  The bits come
from the key first; rows of one key stay together while they fit and are told apart by
bits of their text otherwise.  A bucket of one row, or of rows equal in key and text, cannot
be split: it is a shard of its own, marked ``oversized`` if over the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.sources.workspace import Workspace

#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20
#: Bits taken from the hash of the key, and again from that of the text.
KEY_BITS = 60
#: Bits beyond the expected depth at which bytes are first counted.
MARGIN = 4


def _bits(value: Column) -> Column:
    number = F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, KEY_BITS // 4), 16, 10).cast("long")
    return F.lpad(F.bin(number), KEY_BITS, "0")


def assign_shards(documents: DataFrame, key: str = "doc_id", limit: int = SHARD_BYTES, work: Workspace | None = None) -> DataFrame:
    """``<key>, shard, depth, shard_bytes, oversized``; a shard is named by its bits, the whole table by none.

    Null keys and texts hash as empty strings, and a null text has no bytes.  Repeated rows
    go to one shard.  Byte counts are summed in cells of the hash before any shuffle, one round for each
    ``MARGIN`` bits that the fullest cell is deeper than the mean; a round reads only
    rows of cells that are over the limit still.
    """
    work = work or Workspace(documents.sparkSession)
    deepest = 2 * KEY_BITS
    sized = documents.select(F.col(key), F.concat(_bits(F.col(key)), _bits(F.col("text"))).alias("bits"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    rows = work.keep(sized, "sized")
    total = rows.agg(F.sum("bytes").alias("b")).first().b or 0
    depth, top, parts, turn = min(deepest, (total // limit).bit_length() + MARGIN), 0, [], 0
    while True:
        cell = F.substring("bits", 1, depth)
        cells = work.keep(rows.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), f"cells-{turn}")
        above = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(top), F.lit(depth))).alias("depth"))
        above = above.withColumn("shard", F.expr("substring(cell, 1, depth)"))
        buckets = work.keep(above.groupBy("depth", "shard").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("n")), f"buckets-{turn}")
        fits = (F.col("shard_bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == deepest)
        split = buckets.where(~fits).select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("parent"))
        whole = buckets.where(fits).withColumn("parent", F.expr("substring(shard, 1, depth - 1)"))
        root = whole.where(F.col("depth") == top) if turn == 0 else whole.where("false")
        shards = whole.where(F.col("depth") > top).join(split, ["depth", "parent"], "left_semi").unionByName(root)
        # Merge joins: Spark takes the size of cells times their depths for that of the cells, and would broadcast it.
        placed = above.select("cell", "depth", "shard").join(shards.select("depth", "shard", "shard_bytes").hint("merge"), ["depth", "shard"])
        parts.append(rows.withColumn("cell", cell).join(placed.hint("merge"), "cell").select(key, "shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", (F.col("shard_bytes") > limit).alias("oversized")))
        over = cells.where((F.col("bytes") > limit) & (F.col("n") > 1))
        if depth == deepest or over.isEmpty():
            break
        rows = work.keep(rows.withColumn("cell", cell).join(over.select("cell"), "cell", "left_semi").drop("cell"), f"rows-{turn + 1}")
        top, depth, turn = depth, min(deepest, depth + 2 * MARGIN), turn + 1
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def write_shards(documents: DataFrame, path: str, key: str = "doc_id", limit: int = SHARD_BYTES) -> None:
    """The rows as parquet under ``path``, one folder ``_shard=b<bits>`` per shard; keys must be unique and not null."""
    shards = assign_shards(documents, key, limit).select(key, F.concat(F.lit("b"), "shard").alias("_shard"))
    documents.join(shards, key).repartition("_shard").write.partitionBy("_shard").parquet(path)


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document of the table."""
    return assign_shards(spark.read.parquet(f"{folder}/documents.parquet"))


OP7_SQL = f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT), 60, '0') AS bits
  FROM documents),
above AS (
  SELECT d.doc_id, d.bits, t.depth, substr(d.bits, 1, t.depth) AS shard,
         sum(d.bytes) OVER w AS shard_bytes, count(*) OVER w AS n
  FROM sized d, (SELECT unnest(range(0, 41)) AS depth) t
  WINDOW w AS (PARTITION BY t.depth, substr(d.bits, 1, t.depth)))
SELECT doc_id, shard, depth::INTEGER AS depth, shard_bytes::BIGINT AS shard_bytes, shard_bytes > {SHARD_BYTES} AS oversized
FROM above
WHERE shard_bytes <= {SHARD_BYTES} OR n = 1
QUALIFY row_number() OVER (PARTITION BY doc_id, bits ORDER BY depth) = 1
"""
