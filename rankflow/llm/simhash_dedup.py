"""Near duplicates by SimHash and the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``radius`` or fewer differing bits.  Correlated bits are
put into one partition, and partition i gets a threshold ``t_i`` of its own, with
``sum(t_i + 1) = radius + 1``: two fingerprints that differ by more than ``t_i`` bits in
every partition differ by more than ``radius`` altogether, so each link shows in some
partition.  A threshold of -1 leaves a partition out.  Partitions and thresholds are chosen
by dynamic programming on the cost of the rows and candidates that they are estimated to
make; that choice never changes the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import pieces
from rankflow.llm.components import star_roots
from rankflow.llm.labelled import lowest_share
from rankflow.sources.workspace import Workspace

SHINGLE = 4
RADIUS = 4
#: Distinct fingerprints that candidate counts and correlations are estimated from.
SAMPLE = 2_048
#: Rows of one bucket that are compared within one tile; larger buckets are cut into tiles.
TILE = 2_048
#: Bits (as a power of two, from 6) that tell rows that surely stay from those that may go; a broadcast of some MB at most.
MARK_BITS = 24
#: Estimated seconds to make, ship and sort a row of the index, and to compare a pair.
_ROW_S, _PAIR_S = 2e-6, 1e-8


def simhash(text: bytes, size: int = SHINGLE) -> int:
    """Fingerprint of one text: bit k is set where over half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    last = ends.tolist()[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, last, strict=False)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; a null text or one without words has fingerprint 0."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                texts = piece.column("text").cast(pa.binary()).fill_null(b"")
                fp = [simhash(t, size) for t in texts.to_pylist()]
                yield pa.record_batch([piece.column("doc_id"), piece.column("text_hash"), pa.array(fp, pa.int64())], ["doc_id", "text_hash", "fp"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows_in = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return rows_in.mapInArrow(rows, f"doc_id {kind}, text_hash long, fp long")


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt to ``parts`` partitions of like size, each filled with those most correlated to it."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    if len(bits) < 2:
        alike = np.zeros((64, 64))
    else:
        bits -= bits.mean(axis=0)
        spread = np.maximum(np.sqrt((bits**2).mean(axis=0)), 1e-9)
        alike = np.abs(bits.T @ bits / len(bits) / np.outer(spread, spread))
    np.fill_diagonal(alike, 0)
    free, out = set(range(64)), []
    for i in range(parts):
        width = (64 - sum(map(len, out))) // (parts - i)
        rest = sorted(free)
        own = [rest[int(alike[np.ix_(rest, rest)].max(axis=1).argmax())]]
        while len(own) < width:
            rest = sorted(free - set(own))
            own.append(rest[int(alike[np.ix_(rest, own)].sum(axis=1).argmax())])
        free -= set(own)
        out.append(sorted(own))
    return out


def plan_partitions(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Partitions with thresholds of least estimated cost for ``n`` distinct fingerprints.

    For every number of partitions, ``radius + 1`` units are allotted among them by dynamic
    programming; a partition with k units has threshold k - 1 and costs the rows of its
    index plus the pairs that the sample lets expect within that threshold.
    """
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    pairs = len(sample) * (len(sample) - 1) / 2
    for parts in range(2, radius + 3):
        groups = group_bits(sample, parts)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for own in groups:
            mask = np.bitwise_or.reduce(np.uint64(1) << np.array(own, np.uint64))
            near = np.zeros(65)
            for i in range(0, len(sample), 256):
                near += np.bincount(np.bitwise_count((sample[i : i + 256, None] ^ sample[None, :]) & mask).ravel(), minlength=65)
            near[0] -= len(sample)
            even = np.array([comb(len(own), k) for k in range(len(own) + 1)]) / 2.0 ** len(own)
            cost = [0.0]
            for t in range(radius + 1):
                t = min(t, len(own))
                share = (near[: t + 1].sum() / 2 + even[: t + 1].sum()) / (pairs + 1)
                made = sum(comb(len(own), k) for k in range((t + 1) // 2 + 1))
                cost.append(n * made * _ROW_S + n * n / 2 * share * _PAIR_S)
            step: dict[int, tuple[float, list[int]]] = {}
            for units, (spent, chosen) in table.items():
                for k in range(radius + 2 - units):
                    if (total := spent + cost[k]) < step.get(units + k, (float("inf"), []))[0]:
                        step[units + k] = (total, [*chosen, k - 1])
            table = step
        spent, thresholds = table[radius + 1]
        if spent < best[0]:
            best = (spent, [(own, t) for own, t in zip(groups, thresholds, strict=True) if t >= 0])
    return best[1]


def index_rows(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``part, key, fp, probe``: the keys under which a fingerprint is stored or looked up.

    With threshold t a fingerprint is stored under all keys within t // 2 bits of its own and
    looked up under those within t - t // 2, so two within t bits meet under some key.
    """
    cells = []
    for i, (own, t) in enumerate(plan):
        mask = sum(1 << b for b in own)
        for k in range(t - t // 2 + 1):
            for bits in combinations(own, k):
                cells.append((i, mask - (mask >> 63 << 64), (flip := sum(1 << b for b in bits)) - (flip >> 63 << 64), k > t // 2))
    schema = "array<struct<part:int,mask:bigint,flip:bigint,probe:boolean>>"
    listed = F.from_json(F.lit("[" + ",".join(f'{{"part":{p},"mask":{m},"flip":{f},"probe":{str(b).lower()}}}' for p, m, f, b in cells) + "]"), schema)
    return prints.select("fp", F.explode(listed).alias("c")).select(
        F.col("c.part").alias("part"), F.col("fp").bitwiseAND(F.col("c.mask")).bitwiseXOR(F.col("c.flip")).alias("key"), "fp", F.col("c.probe").alias("probe")
    )


def tiled(rows: DataFrame, most: int = TILE) -> DataFrame:
    """Buckets of more than ``most`` rows cut into chunks, and a tile for every pair of chunks."""
    large = rows.groupBy("part", "key").count().where(F.col("count") > most).select("part", "key", F.ceil(F.col("count") / most).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    return (
        rows.join(large, ["part", "key"], "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("part", "key", F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"), "fp", "probe")
    )


def spanning_links(group: np.ndarray, fp: np.ndarray, probe: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` among rows of one group (rows are sorted by group), as a spanning forest.

    All pairs of a group are compared, one distance between rows at a time; those whose
    rows are connected already are left out.
    """
    n = len(fp)
    parent = np.arange(n)
    out: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    at, lag, label = np.arange(n), 0, parent.copy()
    while len(at):
        lag += 1
        at = at[at + lag < n]
        at = at[group[at] == group[at + lag]]
        to = at + lag
        near = (label[at] != label[to]) & ~(probe[at] & probe[to])
        a, b = at[near], to[near]
        close = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        if close.any():
            for i, j in zip(a[close].tolist(), b[close].tolist(), strict=True):
                if (x := root(i)) != (y := root(j)):
                    parent[max(x, y)] = min(x, y)
                    if fp[i] != fp[j]:
                        out.append((i, j))
            while (parent != (up := parent[parent])).any():
                parent[:] = up
            label = parent.copy()
    pairs = np.array(out, int).reshape(-1, 2)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def links(prints: DataFrame, plan: list[tuple[list[int], int]], radius: int = RADIUS, most: int = TILE) -> DataFrame:
    """``u, v``: enough links between distinct fingerprints to connect all that are within ``radius``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("part", "key", "a", "b")])
            group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
            u, v = spanning_links(group, table.column("fp").to_numpy().view(np.uint64), table.column("probe").to_numpy(), radius)
            return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            names = ("part", "key", "a", "b")
            last = [batch.column(c)[-1] for c in names]
            same = pc.and_(pc.and_(*(pc.equal(batch.column(c), x) for c, x in zip(names[:2], last[:2], strict=True))), pc.and_(*(pc.equal(batch.column(c), x) for c, x in zip(names[2:], last[2:], strict=True))))
            cut = int(np.flatnonzero(~same.to_numpy(zero_copy_only=False))[-1]) + 1 if pc.any(pc.invert(same)).as_py() else 0
            if cut:
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif held and [held[-1].column(c)[-1] for c in names] != last:
                yield found(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield found(pa.Table.from_batches(held))

    by = ["part", "key", "a", "b"]
    dealt = tiled(index_rows(prints, plan), most).repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(rows, "u long, v long").distinct()


def near_duplicates(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS, work: Workspace | None = None) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` of every row of ``documents``.

    Rows with one fingerprint, null and empty texts among them, are one node of the graph;
    ``root`` names the component by its least fingerprint.  ``component_id`` is its smallest
    ``doc_id``; null ids are linked like any others and do not count, so it is null only where
    a component has no id.  Columns other than ``doc_id`` and ``text`` are not read.
    """
    work = work or Workspace(documents.sparkSession)
    signed = work.keep(fingerprints(documents, size), "fingerprints")
    prints = work.keep(signed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    n = prints.count()
    low = prints.where(lowest_share(F.xxhash64("fp"), SAMPLE, n))
    sample = low.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").collect()
    plan = plan_partitions(np.array([r.fp for r in sample], np.int64).view(np.uint64), n, radius)
    roots = star_roots(links(prints, plan, radius), work, "links")
    classes = prints.join(roots, prints.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    ids = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return signed.join(work.keep(classes.join(ids, "root").select("fp", "root", "component_id"), "classes"), "fp").select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def _word_and_bit(doc_id: str, text_hash: str) -> tuple[Column, Column]:
    slot = F.pmod(F.xxhash64(doc_id, text_hash), F.lit(1 << MARK_BITS))
    return F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))


def marks(gone: DataFrame) -> DataFrame:
    """``word, bits``: a bit for every ``_id, _text``, by their hash, in words of 64; ``2 ** (MARK_BITS - 6)`` rows at most."""
    word, bit = _word_and_bit("_id", "_text")
    return gone.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def by_marks(keyed: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``_doc, _hash`` has no bit in :func:`marks`, and the others.

    The marks are few by themselves, so they are broadcast whatever their size: no row is shuffled.
    """
    word, bit = _word_and_bit("_doc", "_hash")
    met = keyed.join(F.broadcast(marked), word == F.col("word"), "left")
    is_marked = F.coalesce("bits", F.lit(0)).bitwiseAND(bit) != 0
    return met.where(~is_marked).select(keyed.columns), met.where(is_marked).select(keyed.columns)


def keep_first(documents: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest ``doc_id``.

    A row without id stays only where no row of its component has one.  Of rows with the same
    id the one of least text hash stays, then that of least hash over all columns, as JSON.

    What stays is decided on ids.  The rows that go are taken out of the table as it is read: of
    the texts only theirs and the few that share a mark with them are moved, and none where the ids
    are few enough for Spark to broadcast.  Only rows that repeat both id and text are grouped.
    """
    work = Workspace(documents.sparkSession)
    found = near_duplicates(documents, size, radius, work)
    ids = work.keep(found.groupBy("doc_id", "text_hash").agg(F.min("root").alias("root"), F.count("*").alias("n")), "ids")
    best = ids.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias("best"))
    first = work.keep(best.select(F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_text"), F.col("best.n").alias("_n")), "first")
    own = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_text"))
    others = ids.join(first.where("_n = 1"), own, "left_anti")
    gone = work.keep(others.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")), "gone")

    keyed = documents.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_hash"))
    named = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    sure, unsure = by_marks(keyed, work.keep(marks(gone), "marks"))
    alone = sure.unionByName(unsure.join(gone, named, "left_anti"))
    again = work.keep(first.where("_n > 1"), "again")  # stored, so that Spark knows its size
    repeated = unsure.join(again, named, "left_semi")
    one = repeated.groupBy("_doc", "_hash").agg(F.min_by("_row", F.xxhash64(F.to_json("_row", {"ignoreNullFields": "false"}))).alias("_row"))
    return alone.select("_row.*").unionByName(one.select("_row.*"))


def op8_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document of the table."""
    found = near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
