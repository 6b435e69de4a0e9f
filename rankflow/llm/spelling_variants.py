"""Spelling variants: words one edit apart, grouped under the spelling that is by far the commonest.

Letters are hashed to a few symbols, so that many words share one *reduced word*.  Two words
one edit apart have reduced words at most one edit apart.  So the full one-edit
neighbourhood of every distinct reduced word is generated, as 64-bit hashes that cost a few
operations each whatever the length, and joined with the reduced vocabulary.  Words that
meet this way are compared in their original spelling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import mix
from rankflow.sources.workspace import Workspace

#: A run of letters is a word.
WORD = "[A-Za-zÀ-ÿ]+"
#: Symbols of the reduced alphabet: more make fewer comparisons and longer neighbourhoods.
SYMBOLS = 6
MIN_LENGTH, MIN_COUNT, MIN_RATIO = 6, 5, 5
#: Of so many occurrences one loses a letter in the registered query, told by its hash.
DAMAGE_ONE_IN = 199
#: Distinct words that a task counts before it hands the counts on.
HELD_WORDS = 300_000
#: Entries of an array of neighbourhoods.
CELLS = 2_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def lower_ascii(text: str) -> str:
    """``text`` with A-Z lower-cased and nothing else."""
    return text.encode().translate(_LOWER).decode()


def damaged(doc_id: object, word: str, one_in: int) -> str:
    """``word``, or without one letter where ``one_in`` divides the hash of document and word; a null id is an empty one."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(documents: DataFrame, one_in: int = 0, min_length: int = 1) -> DataFrame:
    """``word, n``: occurrences in all texts of words of at least ``min_length`` letters.

    Words are lower-cased in A-Z only.  With ``one_in``, hashed occurrences lose a letter first.
    Null and empty texts have none; repeated rows count each.  Tasks hand on sums, so a common
    word costs a row per task and flush.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = re.compile(WORD).findall, Counter()

        def flush() -> pa.RecordBatch:
            out = pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                for word, n in Counter(find(lower_ascii(text))).items():
                    if one_in:
                        word = damaged(doc_id, word, one_in)
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) > HELD_WORDS:
                    yield flush()
        if total:
            yield flush()

    source = documents.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return source.mapInArrow(rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _codes(words: list[str], symbols: int) -> np.ndarray:
    """Symbols of words of one length, one row a word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return mix(points.astype(np.uint64)) % np.uint64(symbols) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def reduced_hash(codes: np.ndarray) -> np.ndarray:
    """One hash per row of symbols: the sum of symbol times base to the power of its place."""
    return (codes * _powers(_BASE, codes.shape[1])).sum(1, dtype=np.uint64)


def neighbourhood(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Hashes of each row itself and of all rows one inserted, deleted or replaced symbol away.

    An edit moves what follows it by one place, so its hash comes from sums over beginnings.
    """
    m, n = codes.shape
    places = _powers(_BASE, n + 1)
    sums = np.zeros((m, n + 1), np.uint64)
    np.cumsum(codes * places[:n], axis=1, dtype=np.uint64, out=sums[:, 1:])
    own = sums[:, -1:]
    out = [own, sums[:, :-1] + (own - sums[:, 1:]) * np.uint64(_BACK)]
    for symbol in range(1, symbols + 1):
        s = np.uint64(symbol)
        out += [own + (s - codes) * places[:n], sums + s * places + (own - sums) * np.uint64(_BASE)]
    return np.concatenate(out, 1)


def _keyed(words: DataFrame, symbols: int, around: bool) -> DataFrame:
    """``words`` with ``key``, the hash of the reduced word, or, ``around``, distinct ``keys`` of its neighbourhood."""
    name, kind = ("keys", "array<bigint>") if around else ("key", "bigint")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[int]] = {}
            texts = batch.column("word").to_pylist()
            for i, word in enumerate(texts):
                by_length.setdefault(len(word), []).append(i)
            for length, places in by_length.items():
                step = max(1, CELLS // ((length + 1) * (2 * symbols + 2)))
                for a in range(0, len(places), step):
                    own = places[a : a + step]
                    codes = _codes([texts[i] for i in own], symbols)
                    taken = batch.take(pa.array(own, pa.int64()))
                    if around:
                        hashes = np.sort(neighbourhood(codes, symbols), axis=1).view(np.int64)
                        fresh = np.ones(hashes.shape, bool)
                        fresh[:, 1:] = hashes[:, 1:] != hashes[:, :-1]
                        ends = np.concatenate([[0], np.cumsum(fresh.sum(1))]).astype(np.int32)
                        column = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[fresh]))
                    else:
                        column = pa.array(reduced_hash(codes).view(np.int64))
                    yield pa.record_batch([*taken.columns, column], [*batch.schema.names, name])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)
    return words.mapInArrow(rows, f"{fields}, {name} {kind}")


def near_words(words: DataFrame, work: Workspace, symbols: int = SYMBOLS) -> DataFrame:
    """``word, n, near, near_n`` of all ordered pairs of words one edit apart; ``words`` holds distinct ``word, n``.

    One word stands for its reduced word while neighbourhoods are joined, so they are as many as
    reduced words.  Both joins are on hashes of reduced words; a common one meets its partners in
    as many tasks as skewed joins are split into, and a pair that fails the comparison is dropped there.
    """
    keyed = work.keep(_keyed(words.select("word", "n"), symbols, around=False), "reduced")
    forms = keyed.groupBy("key").agg(F.min("word").alias("word"))
    around = _keyed(forms, symbols, around=True).select("key", F.explode("keys").alias("other"))
    met = around.join(forms.select(F.col("key").alias("other")), "other")
    left = keyed.select("key", "word", "n")
    right = keyed.select(F.col("key").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = met.join(left, "key").join(right, "other")
    close = F.levenshtein("word", "near", 1) == 1
    return pairs.where(F.abs(F.length("word") - F.length("near")) <= 1).where(close).select("word", "n", "near", "near_n")


def variants(words: DataFrame, work: Workspace, ratio: int = MIN_RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``words`` (distinct ``word, n``).

    ``form`` is the commonest near word, the least of equally common ones, if it is ``ratio`` times
    as common as the word; ``root`` is where following forms ends.
    """
    words = work.keep(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    found = near_words(words, work, symbols).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("n"), best.alias("best"))
    formed = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best"))
    forms = work.keep(found.select("word", "n_near", formed["word"].alias("form"), (-formed["n"]).alias("form_n")), "forms")
    roots = _roots(forms.where(F.col("form").isNotNull()).select("word", "form"), work, _steps(words, ratio))
    return (
        words.join(forms, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )


def _steps(words: DataFrame, ratio: int) -> int:
    """Doublings that reach the end of any chain: counts grow by ``ratio`` with every form."""
    if ratio < 2:
        raise ValueError("forms must be at least twice as common as the word, or chains need not end")
    most, longest = words.agg(F.max("n")).first()[0] or 0, 0
    while most >= ratio:
        most, longest = most // ratio, longest + 1
    return longest.bit_length()


def _roots(forms: DataFrame, work: Workspace, steps: int) -> DataFrame:
    """``word, root`` by pointer doubling over ``word, form``."""
    now = forms.select("word", F.col("form").alias("root"))
    for i in range(steps):
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = work.keep(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"roots_{i}")
    return now


def frequent(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The words that occur often enough."""
    return counts.where(F.col("n") >= min_count)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Variants of the words of all documents, some of whose occurrences have lost a letter."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    counts = word_counts(documents, DAMAGE_ONE_IN, MIN_LENGTH)
    return variants(frequent(counts), Workspace(spark))
