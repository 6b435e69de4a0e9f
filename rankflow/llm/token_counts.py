"""Tokens per document of flat token files, found by a scan for the end-of-document id.

A flat file is one long run of little-endian ids: documents end to end, each closed by the
separator, with no index.  Files come in blocks of a fixed number of ids, whose edges fall
anywhere.  Every block is searched at once for separators by one task; a prefix scan over
the blocks of a file, which sees three numbers per block, then hands each block the number
of documents closed before it and the place of the last separator, and so the documents
that span blocks are stitched.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import pieces
from rankflow.sources.workspace import Workspace

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The id that closes a document: the first one that the vocabulary leaves free.
SEPARATOR = 50_256
BLOCK_TOKENS = 65_536
#: Bytes of a flat file that one task reads.
RANGE_BYTES = 256_000_000
#: Document ids in one row of a file's manifest.
MANIFEST_IDS = 4_096

# Fixed value: the pattern that cuts a text before byte-level BPE.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Blanks in a row from which on they are cut out by hand: the library's matcher keeps a place for each and runs out of them.
LONG_RUN = 20_000
_LONG_RUN = regex.compile(rf"\s{{{LONG_RUN},}}")


def encode_text(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of ``text``, whatever it holds; special tokens are ordinary text.

    A run of blanks before other text is one match without its last blank, which goes with what
    follows or stands alone; at the end of the text it is one match.  So a long run is cut out
    as such a match, and what is around it encoded by itself.
    """
    parts, at = [], 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        parts.append(encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()))
        parts.append(np.array(encoding._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
    if not parts:
        return encoding.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([*parts, encoding.encode_to_numpy(text[at:], disallowed_special=())])


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def scan_separators(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """``stream, block, n_tokens, ends``: where in a block's ids (``ids``, binary) separators stand."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for raw in batch.column("ids"):
                ids = np.frombuffer(raw.as_py() or b"", dtype)
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == separator).astype(np.int32))
            yield pa.record_batch(
                [batch.column("stream"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int32()))], ["stream", "block", "n_tokens", "ends"]
            )

    kind = blocks.schema["stream"].dataType.simpleString()
    return blocks.select("stream", F.col("block").cast("long").alias("block"), "ids").mapInArrow(rows, f"stream {kind}, block long, n_tokens long, ends array<int>")


def stitch(scanned: DataFrame) -> DataFrame:
    """``stream, ordinal, n_tokens, closed`` of every document, from scanned blocks.

    Ids after the last separator are a document of their own with ``closed`` false.  A
    document's separator is not among its tokens; two separators in a row close an empty one.
    """
    facts = scanned.select("stream", "block", "n_tokens", "ends", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last"))
    before = W.partitionBy("stream").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    small = facts.select("stream", "block", "n_tokens", "n", "last")
    starts = small.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    carried = starts.select(
        "stream",
        "block",
        "start",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("closed_before"),
        F.coalesce(F.max(F.when(F.col("n") > 0, F.col("start") + F.col("last"))).over(before), F.lit(-1)).alias("previous"),
        (F.lead("block").over(W.partitionBy("stream").orderBy("block"))).isNull().alias("final"),
    )
    ends = F.transform("ends", lambda e: e + F.col("start"))
    rest = F.when(F.col("final") & (F.col("start") + F.col("n_tokens") - 1 > F.coalesce(F.element_at("all", -1), F.col("previous"))), F.array(F.col("start") + F.col("n_tokens")))
    joined = facts.where((F.col("n") > 0) | (F.col("n_tokens") > 0)).join(carried, ["stream", "block"]).withColumn("all", F.when(F.col("n") > 0, ends))
    listed = joined.withColumn("all", F.concat(F.coalesce("all", F.array().cast("array<bigint>")), F.coalesce(rest, F.array().cast("array<bigint>"))))
    each = listed.select("stream", "closed_before", "previous", "n", "all", F.posexplode("all").alias("i", "end"))
    begin = F.when(F.col("i") == 0, F.col("previous")).otherwise(F.get("all", F.col("i") - 1))
    return each.select("stream", (F.col("closed_before") + F.col("i")).alias("ordinal"), (F.col("end") - begin - 1).alias("n_tokens"), (F.col("i") < F.col("n")).alias("closed"))


def open_flat(uri: str) -> pa.NativeFile:
    """A flat file open for reading at any place.

    Local paths, and whatever pyarrow has a file system for (HDFS, S3 also as ``s3a``, GCS).
    """
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, name = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}:{rest}")
    return system.open_input_file(name)


def read_blocks(
    spark: SparkSession, path: str, width: int = 2, tokens: int = BLOCK_TOKENS, range_bytes: int = RANGE_BYTES, opener: Callable[[str], BinaryIO | pa.NativeFile] = open_flat
) -> DataFrame:
    """``stream, block, ids`` from flat files of ids of ``width`` bytes, of any length.

    Spark lists names and lengths only.  Ranges of some ``range_bytes`` are dealt over tasks, one
    each; a task opens the file with ``opener``, reads its own range, and holds one block at a
    time, so a file of terabytes is read by many tasks and a lost task reads one range again.  An
    empty file, which Spark does not list, has no blocks.  A file that ends before its listed length is an error.
    """
    size = width * tokens
    step = max(1, range_bytes // size)
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("stream"), "length")
    count = F.ceil(F.col("length") / size)
    ranges = files.select("stream", "length", count.alias("stop"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1, F.lit(step).cast("long"))).alias("first"))
    parts = files.agg(F.sum(F.ceil(count / step))).first()[0]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.to_pylist():
                with opener(own["stream"]) as file:
                    file.seek(own["first"] * size)
                    for block in range(own["first"], min(own["first"] + step, own["stop"])):
                        wanted = min(size, own["length"] - block * size)
                        ids = file.read(wanted)
                        if len(ids) < wanted:
                            raise OSError(f"{own['stream']} ends before its listed length of {own['length']} bytes")
                        yield pa.record_batch([pa.array([own["stream"]]), pa.array([block], pa.int64()), pa.array([ids], pa.binary())], ["stream", "block", "ids"])

    return ranges.repartition(max(1, int(parts or 0))).mapInArrow(rows, "stream string, block long, ids binary")


def token_counts(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = "<u2") -> DataFrame:
    """``stream, ordinal, n_tokens, closed`` of every document of flat token files in blocks."""
    return stitch(scan_separators(blocks, separator, dtype))


def tokenise(documents: DataFrame, ranks: dict[bytes, int], pattern: str = _PATTERN, separator: int = SEPARATOR, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents as flat token streams, one for each task, in blocks of ``tokens`` ids.

    Rows with ``ids`` are blocks.  Rows with ``names`` are the manifest: the ids of the documents
    in stream order, from ordinal ``block`` on.  A null text is an empty document.  Streams are
    named by task, so the result must be written before it is read, and only once.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        stop = np.array([separator], "<u2")
        held, size, block, first, name_type, names = [], 0, 0, 0, None, []

        def block_row(ids: np.ndarray, number: int) -> pa.RecordBatch:
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([None], pa.list_(name_type))], fields)

        def manifest(own: list, start: int) -> pa.RecordBatch:
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([None], pa.binary()), pa.array([own], pa.list_(name_type))], fields)

        fields, part = ["stream", "block", "ids", "names"], None
        for batch in batches:
            name_type = batch.column("doc_id").type
            if batch.num_rows:
                part = batch.column("stream")[0].as_py()
            for piece in pieces(batch):
                for name, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    ids = encode_text(encoding, text).astype("<u2") if text else stop[:0]
                    held += [ids, stop]
                    size += len(ids) + 1
                    names.append(name)
                    if len(names) == MANIFEST_IDS:
                        yield manifest(names, first)
                        first, names = first + len(names), []
                if size >= tokens:
                    flat = np.concatenate(held)
                    for i in range(0, len(flat) - tokens + 1, tokens):
                        yield block_row(flat[i : i + tokens], block)
                        block += 1
                    held = [flat[len(flat) // tokens * tokens :]]
                    size = len(held[0])
        if size:
            yield block_row(np.concatenate(held), block)
        if names:
            yield manifest(names, first)

    source = documents.select("doc_id", "text", F.spark_partition_id().alias("stream"))
    return source.mapInArrow(rows, f"stream int, block long, ids binary, names array<{kind}>")


def document_token_counts(documents: DataFrame, ranks: dict[bytes, int], work: Workspace | None = None, pattern: str = _PATTERN) -> DataFrame:
    """``doc_id, n_tokens``: documents written as flat token streams, scanned, and named from the manifest.

    A null or empty text has 0 tokens.  Repeated rows are counted each; columns other than
    ``doc_id`` and ``text`` are not read.
    """
    work = work or Workspace(documents.sparkSession)
    written = work.keep(tokenise(documents, ranks, pattern), "token_streams")
    counts = token_counts(written.where(F.col("ids").isNotNull()))
    names = written.where(F.col("names").isNotNull()).select("stream", "block", F.posexplode("names").alias("i", "doc_id"))
    named = names.select("stream", (F.col("block") + F.col("i")).alias("ordinal"), "doc_id")
    return named.join(counts, ["stream", "ordinal"]).select("doc_id", "n_tokens")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document of the table."""
    return document_token_counts(spark.read.parquet(f"{folder}/documents.parquet"), read_ranks())
