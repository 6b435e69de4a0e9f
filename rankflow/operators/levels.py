"""Bounds of many keys as one byte per hashed cell: few enough to be broadcast, however many the keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells: two to this.
LEVEL_BITS = 22


def _cell(key: Column) -> tuple[Column, Column]:
    """The word of a key's cell in :func:`levels`, and where the cell's byte begins."""
    cell = F.pmod(F.xxhash64(key), F.lit(1 << LEVEL_BITS))
    return F.shiftright(cell, 3).alias("word"), (cell.bitwiseAND(F.lit(7)) * 8).cast("int")


def level(score: Column) -> Column:
    """A score as one of 256 levels.  A score that is not below another has no lower level."""
    return F.floor(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)) * 255)


def levels(scored: DataFrame, key: str, of_cell: Callable[[Column], Column]) -> DataFrame:
    """``word, bits``: the ``of_cell`` (greatest or least) ``level`` of the keys of each cell, eight cells in a word.

    Cells are by hash of the key, so there are ``2 ** (LEVEL_BITS - 3)`` words at most.
    """
    word, at = _cell(F.col(key))
    cells = scored.groupBy(word, at.alias("at")).agg(of_cell(F.col("level")).alias("level"))
    return cells.groupBy("word").agg(F.bit_or(F.expr("shiftleft(level, at)")).alias("bits"))


def with_level(rows: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the level of the cell of their ``key`` as ``name``; NULL where no key is in its word.

    ``found`` is broadcast whatever its size, so ``rows`` are not shuffled.
    """
    word, at = _cell(F.col(key))
    table = F.broadcast(found.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    met = rows.withColumn("_at", at).join(table, word == F.col("_word"), "left")
    return met.withColumn(name, F.expr("shiftrightunsigned(_bits, _at) & 255")).drop("_word", "_bits", "_at")
