"""An inverted index dealt to cells of users, which hold all products of their users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions import spread
from rankflow.functions.blocks import deal_posts

#: Products of two scores that a task sums at a time, about.
CELL_PRODUCTS = 1_000_000
#: Cells beyond which they grow, each of them up to so many times its size: every cell costs a task
#: that deals posts a block of its own.
MANY_CELLS = 1024
MOST_GROWTH = 4


def _sized(index: DataFrame, cell_products: int, audience: DataFrame | None = None) -> DataFrame:
    """The index with the number of cells and the size of the largest post on every row.

    ``audience`` has ``n_users`` of each post, where that is cheaper to get than from the index.
    """
    audience = index if audience is None else audience
    total = audience.agg(F.sum(F.col("n_users") * F.col("n_users"))).scalar()
    largest = audience.agg(F.max("n_users")).scalar()
    growth = F.greatest(F.least(total / cell_products / MANY_CELLS, F.lit(MOST_GROWTH)), F.lit(1))
    n_cells = F.greatest(F.ceil(total / cell_products / growth), F.lit(1)).cast("bigint")
    return index.select("found", n_cells.alias("n_cells"), largest.alias("largest"))


def _cells(index: DataFrame, cell_products: int) -> DataFrame:
    """``cell, part, asks, others``: for each post and cell, the users of the cell and whom they meet.

    What :func:`packed_cells` packs.
    """
    entry = index.schema["found"].dataType.elementType
    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in entry if f.name not in ("n_posts", "indexed"))
    kind = f"array<struct<{fields}>>"
    deal = deal_posts(cell_products, packed=False)
    return _sized(index, cell_products).mapInArrow(deal, f"cell bigint, part bigint, asks {kind}, others {kind}")


def packed_cells(
    index: DataFrame, cell_products: int, *, ordered: bool = False, audience: DataFrame | None = None
) -> DataFrame:
    """``cell, part, posts``: each task's posts for a part of a cell as one compressed block, dealt by cell.

    All products of an index go through this shuffle, some three bytes each.
    """
    deal = deal_posts(cell_products, ordered=ordered)
    dealt = _sized(index, cell_products, audience).mapInArrow(deal, "cell bigint, part bigint, posts binary")
    return spread(dealt, "cell", "part")
