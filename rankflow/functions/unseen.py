"""Posts of neighbours that a user has not, found in the Python worker of a task.

Spark deals and sorts the rows; this merges the arrays of one user after the other.  The module is
pickled by value, so executors need not have the package.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEY = ("user_id", "part")


def unseen_posts(kind: str, names: list[str], at_once: int = 1_000_000):
    """A function for ``mapInArrow`` over rows in order of ``user_id, part``.

    A row has the ``posts`` of a neighbour, or where ``own`` of the user, and lists as long beside
    them.  Of the posts that a neighbour has and the user has not come out, by ``kind``: ``each``
    entry, with its similarity and values; ``merged``, one row per post with the mean similarity
    and the sum of ``strengths``; or ``any``, one row per post with the values of one entry, all under ``names``.  A
    missing post equals none.  Some ``at_once`` entries are in hand at a time, or one user's.
    """

    def found(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = np.flatnonzero(_changes(batch))
            if len(starts) > 1 or not held or _key(held[0]) != _key(batch):
                yield from strips([*held, batch.slice(0, starts[-1])])
                held = []
            held.append(batch.slice(0 if len(starts) == 1 else starts[-1]))
        if held:
            yield from strips(held)

    def strips(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        if not table.num_rows:
            return
        starts = np.append(np.flatnonzero(_changes(table)), table.num_rows)
        entries = np.concatenate([[0], np.cumsum(_lengths(table["posts"]))])
        at = 0
        while at < len(starts) - 1:
            until = np.searchsorted(entries[starts], entries[starts[at]] + at_once, "right") - 1
            until = max(int(until), at + 1)
            part = table.slice(starts[at], starts[until] - starts[at])
            yield from _unseen(part, kind).rename_columns(names).to_batches()
            at = until

    return found


def unseen_beside(names: list[str], at_once: int = 1_000_000):
    """A function for ``mapInArrow`` over rows that have the ``posts`` of a neighbour and, beside them, those ``seen``.

    Every entry not ``seen`` comes out, with the user, the similarity and its value, under ``names``.
    A missing post equals none.  Some ``at_once`` entries are in hand at a time, or one row's.
    """

    def found(batches):
        for batch in batches:
            entries = np.cumsum(_lengths(batch["posts"]) + _lengths(batch["seen"]))
            at = 0
            while at < batch.num_rows:
                before = entries[at - 1] if at else 0
                until = max(int(np.searchsorted(entries, before + at_once, "right")), at + 1)
                part = pa.Table.from_batches([batch.slice(at, until - at)])
                yield from _not_seen(part).rename_columns(names).to_batches()
                at = until

    return found


def _not_seen(table: pa.Table) -> pa.Table:
    lists = ("posts", "strengths", "seen")
    flat = {name: pc.list_flatten(table[name]).combine_chunks() for name in lists}
    rows = {name: np.repeat(np.arange(table.num_rows), _lengths(table[name])) for name in ("posts", "seen")}
    key, missing = _entry_keys(np.concatenate([rows["posts"], rows["seen"]]), pa.concat_arrays([flat["posts"], flat["seen"]]))
    n = len(rows["posts"])
    asked, seen = key[:n], np.sort(key[n:], kind="stable")
    place = np.searchsorted(seen, asked)
    known = place < len(seen)
    known[known] = seen[place[known]] == asked[known]
    del flat["seen"]
    return _chosen(table, flat, rows["posts"], np.flatnonzero(~known | missing[:n]), {}, ["cosine_similarity"])


def _key(batch: pa.RecordBatch) -> tuple:
    return tuple(batch.column(name)[0].as_py() for name in _KEY)


def _codes(column) -> tuple[np.ndarray, np.ndarray]:
    """Equal numbers for equal values, and which are missing."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    missing = column.is_null().to_numpy(zero_copy_only=False)
    if not pa.types.is_integer(column.type):
        column = column.dictionary_encode().indices
    return column.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), missing


def _changes(rows) -> np.ndarray:
    """Whether a row has another user or part than the one before it; true for the first."""
    changed = np.zeros(rows.num_rows, bool)
    changed[:1] = True
    for name in _KEY:
        for codes in _codes(rows.column(name)):
            changed[1:] |= codes[1:] != codes[:-1]
    return changed


def _lengths(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)


def _entry_keys(group: np.ndarray, posts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number per entry, the same for entries of one group and post, and which posts are missing."""
    code, missing = _codes(posts)
    low, high = int(code.min(initial=0)), int(code.max(initial=0))
    if (high - low + 2) * (int(group.max(initial=0)) + 1) >= 2**62:
        code = np.unique(code, return_inverse=True)[1]
        low, high = 0, int(code.max(initial=0))
    return group * (high - low + 2) + np.where(missing, high - low + 1, code - low), missing


def _unseen(table: pa.Table, kind: str) -> pa.Table:
    flat = {n: pc.list_flatten(table[n]).combine_chunks() for n in table.column_names if pa.types.is_list(table.schema.field(n).type)}
    row = np.repeat(np.arange(table.num_rows), _lengths(table["posts"]))
    own = table["own"].to_numpy()[row]
    key, missing = _entry_keys(np.cumsum(_changes(table))[row] - 1, flat["posts"])
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    mine = own[order]
    seen, alone = np.logical_or.reduceat(mine, first), np.logical_and.reduceat(mine, first)
    kept = ~alone & (~seen | missing[order[first]])
    if kind == "each":
        size = np.diff(first, append=len(order))
        return _chosen(table, flat, row, order[np.repeat(kept, size) & ~mine], {}, ["cosine_similarity"])
    if kind == "any":
        of_others = np.minimum.reduceat(np.where(mine, len(order), np.arange(len(order))), first)
        return _chosen(table, flat, row, order[of_others[kept]], {})
    cosine = table["cosine_similarity"]
    close = cosine.is_valid().to_numpy()[row][order] & ~mine
    value = pc.fill_null(cosine, 0.0).to_numpy()[row][order]
    n_close = np.add.reduceat(close.astype(np.int64), first)[kept]
    total = np.add.reduceat(np.where(close, value, 0.0), first)[kept]
    known = flat["strengths"].is_valid().to_numpy(zero_copy_only=False)[order] & ~mine
    strength = flat["strengths"].fill_null(0).to_numpy(zero_copy_only=False)[order]
    strength = np.where(known, strength, strength.dtype.type(0))
    n_known = np.add.reduceat(known.astype(np.int64), first)[kept]
    sums = np.add.reduceat(strength, first)[kept]
    if strength.dtype.kind == "i" and np.abs(np.add.reduceat(strength.astype(float), first)).max(initial=0) >= 2.0**63:
        raise OverflowError("the strengths of a post exceed a bigint")
    with np.errstate(invalid="ignore"):
        mean = pa.array(total / n_close, mask=n_close == 0)
    return _chosen(table, flat, row, order[first[kept]], {"similarity": mean, "strength": pa.array(sums, mask=n_known == 0)})


def _chosen(table: pa.Table, flat, row: np.ndarray, entries: np.ndarray, merged: dict, of_row=()) -> pa.Table:
    """The user and post of the entries, what their row has, and their values or those ``merged``."""
    at, where = pa.array(entries), pa.array(row[entries])
    columns = {"user_id": table["user_id"].take(where), "posts": flat["posts"].take(at)}
    columns |= {name: table[name].take(where) for name in of_row}
    return pa.table(columns | (merged or {n: a.take(at) for n, a in flat.items() if n != "posts"}))
