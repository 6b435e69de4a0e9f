import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Columns of ``documents``, and some that operators use for themselves.
WIDE = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())]
    + [StructField(c, StringType()) for c in ("fp", "kept", "k", "n", "h", "root", "ids", "stream", "shard", "spans", "label", "score", "bytes", "cell", "n_entities", "_row", "_new", "_id", "text_hash", "item_id")]
)
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])
ITEMS = StructType([StructField("item_id", LongType()), StructField("text", StringType())])


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with all other columns filled and names that clash."""

    def build(pairs):
        rest = len(WIDE) - 5
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * rest) for i, t in pairs], WIDE)

    return build


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, ITEMS)


#: Null ids and texts, empty texts, repeated rows, a very long text without a space, and one with many words.
ODD = [(1, None), (2, ""), (2, ""), (None, "a null id"), (None, None), (3, "x" * 300_000), (4, "word and word " * 30_000), (5, " \n\t "), (6, "é ñ 日本 🙂 \x00 ▁"), (6, "é ñ 日本 🙂 \x00 ▁")]


@pytest.fixture
def odd(docs):
    return docs(ODD)
