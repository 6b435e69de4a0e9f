"""Documents that hold benchmark items, by SimHash over windows of the item's size.

Items are the stated query set: they reach the tasks in blocks of bounded size, and every
block is held against all documents in one pass without a shuffle.  A window of as many
words as the item that shares none of its shingles has similarity 0, so windows are laid
around shared shingles only.  A text of fewer words than the item is one window as a whole.

Fingerprints (the signs of the summed bits of a window's shingles) are looked up in a
multi-index: for every block of bits a table from the block's value to the items whose own
block is within its share of the radius.  Two fingerprints within the radius agree so far in
some block, so the tables hold all of them.  Candidates are then compared exactly: weighted
Jaccard over shingles, the weight of a shingle being its number of occurrences.

A radius alone cannot promise all windows of a similarity: repetitive ones, with few
distinct shingles, may be alike and lie far apart.  So a window that the tables do not give
is still compared if as many of its shingles are the item's as the similarity takes.  Whole
texts are few, one for an item, and compared without asking fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankflow.llm.bytesarrays import BREAK, Texts, pieces, span_hashes, windows
from rankflow.sources.workspace import Workspace

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 fingerprints differ by 9.7 bits on average, with a deviation of 2.9.
RADIUS = 20
#: Blocks of bits of the multi-index; two fingerprints within the radius are within an eighth of it in one.
BIT_BLOCKS = 8
#: Items and bytes of item text that one pass over the documents looks for, at most.
BLOCK_ITEMS = 4_096
BLOCK_BYTES = 8_000_000
#: Shingles that are unpacked into bits at a time.
_AT_ONCE = 65_536


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and text number of every word of the lower-cased texts."""
    flat = Texts.of(pc.utf8_lower(texts))
    starts, ends, of = flat.spans(BREAK[flat.data])
    return span_hashes(flat.data, starts, ends), of, flat.n


def window_prints(hashes: np.ndarray) -> np.ndarray:
    """SimHash of every row of shingle hashes."""
    out = np.zeros(len(hashes), np.uint64)
    step = max(1, _AT_ONCE // max(1, hashes.shape[1]))
    for i in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[i : i + step])
        bits = np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2, bitorder="little").sum(axis=1, dtype=np.int32)
        out[i : i + step] = np.packbits(2 * bits > part.shape[1], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


class MultiIndex:
    """Tables of item fingerprints, one for each block of bits, by the value of that block.

    A table's row for a value lists, as a bit for each item, the items whose own value differs from
    it in at most the block's share of the radius: 256 rows for blocks of eight bits.
    """

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        width = 64 // BIT_BLOCKS
        self._mask, self._shifts = np.uint64(2**width - 1), [np.uint64(i * width) for i in range(BIT_BLOCKS)]
        values = np.arange(2**width, dtype=np.uint64)
        self._tables = [
            np.packbits(np.bitwise_count(values[:, None] ^ ((prints >> shift) & self._mask)[None, :]) <= radius // BIT_BLOCKS, axis=1, bitorder="little")
            for shift in self._shifts
        ]

    def probe(self, found: np.ndarray, item: int) -> np.ndarray:
        """Which fingerprints have ``item`` in the row of one of their blocks and are within the radius of it."""
        byte, bit = item // 8, np.uint8(1 << item % 8)
        listed = np.zeros(len(found), bool)
        for table, shift in zip(self._tables, self._shifts, strict=True):
            listed |= (table[((found >> shift) & self._mask).astype(np.int64), byte] & bit) > 0
        near = np.flatnonzero(listed)
        listed[near] = np.bitwise_count(found[near] ^ self.prints[item]) <= self.radius
        return listed

    def listed(self, found: np.ndarray) -> np.ndarray:
        """Number of items that the tables give for each fingerprint, before the distance is looked at."""
        rows = np.zeros((len(found), -(-len(self.prints) // 8)), np.uint8)
        for table, shift in zip(self._tables, self._shifts, strict=True):
            rows |= table[((found >> shift) & self._mask).astype(np.int64)]
        return np.bitwise_count(rows).sum(axis=1)


@dataclass
class Items:
    """Distinct item texts of one block with one shingle length: shingles, fingerprints, ids."""

    shingle: int
    ids: list[list]
    hashes: list[np.ndarray]
    prints: np.ndarray
    known: np.ndarray
    first: np.ndarray
    owner: np.ndarray
    index: MultiIndex

    @classmethod
    def of(cls, shingle: int, hashes: list[np.ndarray], ids: list[list], radius: int) -> Items:
        known, of = np.unique(np.concatenate(hashes), return_inverse=True)
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        pairs = np.unique(np.stack([of, owner]), axis=1)
        prints = np.array([window_prints(h[None, :])[0] for h in hashes], np.uint64)
        return cls(shingle, ids, hashes, prints, known, np.searchsorted(pairs[0], np.arange(len(known) + 1)), pairs[1], MultiIndex(prints, radius))


def index_items(rows: list[tuple], radius: int = RADIUS) -> list[Items]:
    """(id, text) pairs by shingle length; texts without words match nothing and are left out."""
    if not rows:
        return []
    hashes, of, n = word_hashes(pa.array([r[1] for r in rows], pa.string()))
    cuts = np.searchsorted(of, np.arange(n + 1))
    groups: dict[int, dict[bytes, tuple[np.ndarray, list]]] = {}
    for i, (name, _) in enumerate(rows):
        words = hashes[cuts[i] : cuts[i + 1]]
        if len(words):
            size = min(SHINGLE, len(words))
            shingles, _ = windows(words, np.zeros(len(words), int), size)
            groups.setdefault(size, {}).setdefault(shingles.tobytes(), (shingles, []))[1].append(name)
    return [Items.of(k, [s for s, _ in g.values()], [i for _, i in g.values()], radius) for k, g in groups.items()]


def matches(texts: pa.Array, index: list[Items], similarity: float) -> Iterator[tuple[int, object, float, int, int]]:
    """(text number, item id, similarity, first word, bits apart) of the best window of every text and item."""
    hashes, of, n = word_hashes(texts)
    begin = np.searchsorted(of, np.arange(n + 1))
    for items in index:
        value, place = windows(hashes, of, items.shingle)
        if not len(value):
            continue
        shingles = np.zeros(len(hashes), np.uint64)
        shingles[place] = value
        at = np.minimum(np.searchsorted(items.known, value), len(items.known) - 1)
        hit = items.known[at] == value
        place, at = place[hit], at[hit]
        count = items.first[at + 1] - items.first[at]
        where = np.repeat(place, count)
        item = items.owner[np.repeat(items.first[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        order = np.lexsort((where, item))
        where, item = where[order], item[order]
        for i, lo, hi in zip(*(x.tolist() for x in _runs(item)), strict=True):
            own = items.hashes[i]
            size, p = len(own), where[lo:hi]
            first = np.maximum(p - size + 1, np.concatenate([[-1], p[:-1]]) + 1)
            first = np.maximum(first, begin[of[p]])
            last = np.minimum(p, begin[of[p] + 1] - (size + items.shingle - 1))
            lengths = np.maximum(last - first + 1, 0)
            yield from _whole(shingles, begin, of[p], items, i, similarity)
            start = np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            for j in range(0, len(start), _AT_ONCE):
                s = start[j : j + _AT_ONCE]
                yield from _verified(shingles, of, begin, s, p, items, i, similarity)


def _whole(shingles, begin, texts, items, i, similarity):  # noqa: ANN001, ANN202
    """Texts of fewer words than the item; one too short to reach the similarity is not looked at."""
    own = items.hashes[i]
    count = begin[texts + 1] - begin[texts] - items.shingle + 1
    short = (count < len(own)) & (count >= (similarity - 1e-12) * len(own))
    if not short.any():
        return
    known, weight = np.unique(own, return_counts=True)
    for text in np.unique(texts[short]).tolist():
        rows = shingles[begin[text] : begin[text + 1] - items.shingle + 1]
        names, times = np.unique(rows, return_counts=True)
        _, a, b = np.intersect1d(names, known, assume_unique=True, return_indices=True)
        common = np.minimum(times[a], weight[b]).sum()
        alike = float(common / (len(rows) + len(own) - common))
        if alike >= similarity - 1e-12:
            bits = int(np.bitwise_count(window_prints(rows[None, :])[0] ^ items.prints[i]))
            for name in items.ids[i]:
                yield text, name, alike, 0, bits


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(values):
        return values, values, values
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[first], first, np.append(first[1:], len(values))


def _verified(shingles, of, begin, start, shared, items, i, similarity):  # noqa: ANN001, ANN202
    own, own_print, ids = items.hashes[i], items.prints[i], items.ids[i]
    step = max(1, 16 * _AT_ONCE // len(own))
    # Two sets of n shingles of similarity x have 2nx / (1 + x) in common.
    least = 2 * len(own) * similarity / (1 + similarity) - 1e-6
    for j in range(0, len(start), step):
        s = start[j : j + step]
        rows = shingles[s[:, None] + np.arange(len(own))]
        found = window_prints(rows)
        near = items.index.probe(found, i)
        near |= np.searchsorted(shared, s + len(own)) - np.searchsorted(shared, s) >= least
        s, rows, found = s[near], rows[near], found[near]
        if not len(s):
            continue
        names, weight = np.unique(own, return_counts=True)
        at = np.minimum(np.searchsorted(names, rows), len(names) - 1)
        cell = (np.arange(len(rows))[:, None] * len(names) + at)[names[at] == rows]
        common = np.minimum(np.bincount(cell, minlength=len(rows) * len(names)).reshape(len(rows), -1), weight).sum(axis=1)
        alike = common / (2 * len(own) - common)
        best: dict[int, tuple[float, int, int]] = {}
        for k in np.flatnonzero(alike >= similarity - 1e-12).tolist():
            text, one = int(of[s[k]]), (float(alike[k]), -int(s[k]), int(np.bitwise_count(found[k] ^ own_print)))
            best[text] = max(best.get(text, one), one)
        for text, (score, minus, bits) in best.items():
            for name in ids:
                yield text, name, score, -minus - int(begin[text]), bits


def item_blocks(benchmark: DataFrame, radius: int = RADIUS) -> Iterator[tuple[list[Items], bool]]:
    """The items in blocks of bounded count and bytes, and whether a block is the last; each is one pass over the documents."""
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-(size.b or 0) // BLOCK_BYTES))
    for b in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield index_items([(r.item_id, r.text) for r in own.orderBy("item_id", "text").collect()], radius), b == blocks - 1


def contamination(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, work: Workspace | None = None) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, bits_apart``: the best window of each document for each item it holds.

    A window has as many words as the item, or is a whole text of fewer words.  Null and empty texts hold nothing, and items without words are held by nothing; an item
    of fewer than five words is one shingle.  Items with one text are all reported, and so are
    repeated documents.  Columns other than the ids and the texts are not read.  What a block of
    items finds is written before the next block is indexed, so the driver and the plan hold one.
    """
    work = work or Workspace(documents.sparkSession)
    kinds = documents.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, first_word long, bits_apart int"

    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)

    def search(index: list[Items]) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    best: dict = {}
                    for text, name, score, at, bits in matches(piece.column("text"), index, similarity):
                        best[text, name] = max(best.get((text, name), (score, -at, bits)), (score, -at, bits))
                    if best:
                        docs = piece.column("doc_id").take(pa.array([k[0] for k in best]))
                        score, at, bits = zip(*best.values(), strict=True)
                        columns = [pa.array([k[1] for k in best], item_type), pa.array(score), pa.array([-x for x in at]), pa.array(bits, pa.int32())]
                        yield pa.record_batch([docs, *columns], ["doc_id", "item_id", "similarity", "first_word", "bits_apart"])

        return documents.select("doc_id", "text").mapInArrow(rows, schema)

    found: list[DataFrame] = []
    for index, last in item_blocks(benchmark, radius):
        found.append(search(index) if last else work.keep(search(index), f"matches_{len(found)}"))
    return reduce(DataFrame.union, found)


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, work: Workspace | None = None
) -> DataFrame:
    """The documents that hold no item, with all their columns; one pass for each block of items.

    What a block leaves is written before the next block is indexed, so the driver and the plan hold one.
    """
    work = work or Workspace(documents.sparkSession)

    def without(index: list[Items]):  # noqa: ANN202
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch):
                    keep = np.ones(piece.num_rows, bool)
                    keep[[m[0] for m in matches(piece.column("text"), index, similarity)]] = False
                    yield piece.filter(pa.array(keep))

        return rows

    for b, (index, last) in enumerate(item_blocks(benchmark, radius)):
        documents = documents.mapInArrow(without(index), documents.schema)
        documents = documents if last else work.keep(documents, f"clean_{b}")
    return documents


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item in every document."""
    return contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
