"""Comparing users in the Python worker of a task.

Spark decides which users meet and moves them; this is the arithmetic on one pair
of blocks, or on one cell of an inverted index.  The module is pickled by value, so executors need not have the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMNS_AT_ONCE = 1024
_PAIRS_AT_ONCE = 8_000_000


def cell_neighbours(k: int):
    """A function for ``applyInArrow``: the K closest of ``others`` per user."""

    def neighbours(users: pa.Table, others: pa.Table) -> pa.Table:
        unpacked = _unpack(others.sort_by("user_id"))
        strip = max(_PAIRS_AT_ONCE // max(others.num_rows, 1), 1)
        parts = [strip_neighbours(users.slice(at, strip), unpacked) for at in range(0, max(users.num_rows, 1), strip)]
        return pa.concat_tables(parts)

    def strip_neighbours(users: pa.Table, unpacked) -> pa.Table:
        ids, norms, *entries = _unpack(users)
        other_ids, other_norms, *other_entries = unpacked
        dot, shared = _products(len(ids), entries, len(other_ids), other_entries)
        lengths = np.outer(np.sqrt(norms), np.sqrt(other_norms))
        # Ranked out: users who share nothing, and the user itself.
        shared &= ids[:, None] != other_ids[None, :]
        value = np.where(shared, dot / lengths, -np.inf)
        row, column = _first_k(value, k)
        return pa.table(
            {
                "user_id": ids[row],
                "similar_user": other_ids[column],
                "cosine_similarity": value[row, column],
            }
        )

    return neighbours


def _unpack(block: pa.Table):
    """Ids, squared norms, and the entries of all vectors as (row, post, weight)."""
    posts = block["posts"].combine_chunks()
    row = np.repeat(np.arange(len(posts)), posts.value_lengths().to_numpy(zero_copy_only=False))
    return (
        block["user_id"].to_numpy(),
        block["norm2"].to_numpy().astype(np.float64),
        row,
        posts.flatten().to_numpy(),
        block["weights"].combine_chunks().flatten().to_numpy(),
    )


def _products(n_left: int, left, n_right: int, right):
    """Dot products, and which pairs have a post in common.

    Sums of integers below 2**53 are exact in floating point in any order.
    """
    dot = np.zeros((n_left, n_right))
    common = np.intersect1d(left[1], right[1])
    positive = (left[2] > 0).all() and (right[2] > 0).all()
    shared = np.zeros((n_left, n_right), dtype=bool)

    def dense(n_rows, entries, posts, presence=False):
        row, post, weight = entries
        column = np.minimum(np.searchsorted(posts, post), len(posts) - 1)
        hit = posts[column] == post
        matrix = np.zeros((n_rows, len(posts)))
        matrix[row[hit], column[hit]] = 1.0 if presence else weight[hit]
        return matrix

    for start in range(0, len(common), _COLUMNS_AT_ONCE):
        posts = common[start : start + _COLUMNS_AT_ONCE]
        dot += dense(n_left, left, posts) @ dense(n_right, right, posts).T
        if not positive:
            shared |= (dense(n_left, left, posts, True) @ dense(n_right, right, posts, True).T) > 0
    return dot, (dot > 0 if positive else shared)


def _first_k(value: np.ndarray, k: int):
    """Positions of each row's K largest finite values; of equal values the leftmost."""
    width = value.shape[1]
    if width <= k:
        return np.nonzero(np.isfinite(value))
    last = np.partition(value, width - k, axis=1)[:, width - k, None]
    above = value > last
    at = (value == last) & np.isfinite(value)
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (at & (np.cumsum(at, axis=1) <= room)))


def deal_posts(cell_products: int, *, ordered: bool = False, packed: bool = True, at_once: int = 4_000_000):
    """A function for ``mapInArrow``: posts of an inverted index dealt to cells of users.

    A post has ``found``, its users, with ``n_cells`` and ``largest``, the number of users of the
    largest post.  It goes to each cell that has a user of it: who ``asks`` there, and all ``others``.
    A user whose posts may give more than ``cell_products`` products has a cell of its own, in
    parts that deal whom it meets by hash.  With ``ordered`` only others of a greater id than the
    least that asks are met, and where entries say so, only those ``indexed``.  Rows of a batch
    for one part of a cell leave as one compressed block, or one by one if not ``packed``.
    """

    def deal(batches):
        for batch in batches:
            flat, lengths = _flat(batch.column("found"))
            if len(flat):
                n_cells, largest = batch.column("n_cells")[0].as_py(), batch.column("largest")[0].as_py()
                for rows in dealt(flat, lengths, n_cells, largest):
                    yield _as_blocks(*rows) if packed else _as_rows(*rows)

    def dealt(flat, lengths, n_cells, largest):
        post = np.repeat(np.arange(len(lengths)), lengths)
        user = flat.field("user_id").to_numpy(zero_copy_only=False)
        by_user = np.lexsort((user, post))
        flat, user = flat.take(pa.array(by_user)), user[by_user]
        names = [f.name for f in flat.type if f.name not in ("n_posts", "indexed")]
        entry = {n: flat.field(n) for n in names}
        if packed:
            entry = {n: _numbers(values) for n, values in entry.items()}
        n_posts = flat.field("n_posts").to_numpy(zero_copy_only=False)
        parts = np.maximum(-(-n_posts * largest // cell_products), 1)
        cell = np.where(parts > 1, n_cells + (_mixed(user, 1) >> 4), _mixed(user, 0) % n_cells)
        met = np.ones(len(user), bool)
        if "indexed" in {f.name for f in flat.type}:
            met = flat.field("indexed").to_numpy(zero_copy_only=False)
        of_met, met_before = np.flatnonzero(met), np.cumsum(met)
        # Those of one post that ask in one cell, with where the others they meet begin and end.
        asking = np.lexsort((parts, cell, post))
        same = (np.diff(post[asking]) == 0) & (np.diff(cell[asking]) == 0) & (np.diff(parts[asking]) == 0)
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])
        n_asking, head = np.diff(first, append=len(asking)), asking[first]
        ends = np.cumsum(lengths)
        met_until = np.concatenate([[0], met_before])
        begin = met_before[head] if ordered else met_until[ends - lengths][post[head]]
        size = met_until[ends][post[head]] - begin
        total = np.cumsum(size)
        start = 0
        while start < len(size):
            before = total[start - 1] if start else 0
            stop = max(int(np.searchsorted(total, before + at_once, "right")), start + 1)
            number = np.repeat(np.arange(start, stop), size[start:stop])
            others = of_met[_ranges(begin[start:stop], size[start:stop])]
            part = np.zeros(len(others), np.int64)
            large = parts[head[number]] > 1
            if large.any():
                part[large] = _mixed(user[others[large]], 2) % parts[head[number[large]]]
                order = np.lexsort((part, number))
                number, others, part = number[order], others[order], part[order]
            start = stop
            if not len(others):
                continue
            row = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
            n_others, group, part = np.diff(row, append=len(others)), number[row], part[row]
            order = np.lexsort((part, cell[head[group]]))
            row, n_others, group, part = row[order], n_others[order], group[order], part[order]
            asks = asking[_ranges(first[group], n_asking[group])]
            yield cell[head[group]], part, entry, (n_asking[group], asks), (n_others, others[_ranges(row, n_others)])

    return deal


def _flat(column):
    """The entries of all lists end to end, and how many each list has."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten(), lengths.astype(np.int64)


def _mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    """Ids spread over 63 bits, differently for each seed."""
    x = ids.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).view(np.int64)


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, ``length`` of them, end to end."""
    return np.arange(length.sum()) + np.repeat(begin - (np.cumsum(length) - length), length)


def _lists(entry: dict[str, pa.Array], lengths: np.ndarray, at: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    entries = pa.StructArray.from_arrays([*entry.values()], [*entry])
    return pa.ListArray.from_arrays(pa.array(offsets), entries.take(pa.array(at)))


def _as_rows(cell, part, entry, asks, others) -> pa.RecordBatch:
    columns = [pa.array(cell), pa.array(part), _lists(entry, *asks), _lists(entry, *others)]
    return pa.record_batch(columns, ["cell", "part", "asks", "others"])


def _as_blocks(cell, part, entry, asks, others) -> pa.RecordBatch:
    """One row per part of a cell, its posts as one block of :func:`_packed` arrays."""
    sides, ends = [], []
    for lengths, at in (asks, others):
        sides.append({"lengths": lengths} | {n: values[at] for n, values in entry.items()})
        ends.append(np.concatenate([[0], np.cumsum(lengths)]))
    # Ids of a post are in order, so that those met are small numbers from one to the next.
    who, whom = (side["user_id"] for side in sides)
    step = np.diff(whom, prepend=0)
    step[ends[1][:-1]] = whom[ends[1][:-1]] - who[ends[0][:-1]]
    sides[1]["user_id"] = step
    sides = [{n: _narrow(values) for n, values in side.items()} for side in sides]
    first = np.flatnonzero((np.diff(cell, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
    blocks = []
    for start, stop in zip(first, np.append(first[1:], len(cell)), strict=True):
        named = {}
        for key, side, end in zip(("asks", "others"), sides, ends, strict=True):
            for n, values in side.items():
                named[f"{key}.{n}"] = values[start:stop] if n == "lengths" else values[end[start] : end[stop]]
        blocks.append(_packed(named))
    return pa.record_batch([pa.array(cell[first]), pa.array(part[first]), pa.array(blocks, pa.binary())], ["cell", "part", "posts"])


def _numbers(values: pa.Array) -> np.ndarray:
    """A column as numpy has it; whole numbers as bigint, decimals as doubles."""
    if pa.types.is_decimal(values.type):
        values = values.cast(pa.float64())
    values = values.to_numpy(zero_copy_only=False)
    return values.astype(np.int64) if values.dtype.kind == "i" else values


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds all of them."""
    if values.dtype.kind != "i":
        return values
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    return values.astype(np.min_scalar_type(min(low, -high - 1) if low < 0 else high))


def _packed(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as bytes: first bytes of all entries, then second bytes and so on, each compressed by itself.

    Numbers of one column differ in their low bytes and agree in the high ones.
    """
    codec = pa.Codec("zstd")
    frames, header = [], []
    for name, values in arrays.items():
        table = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
        planes = [codec.compress(plane.tobytes(), asbytes=True) for plane in table.T]
        header.append(f"{name} {values.dtype.str} {len(values)} {' '.join(str(len(p)) for p in planes)}")
        frames += planes
    head = "\n".join(header).encode()
    return b"".join([len(head).to_bytes(4, "little"), head, *frames])


def _unpacked(block: pa.Buffer) -> dict[str, np.ndarray]:
    """The arrays of :func:`_packed`."""
    codec = pa.Codec("zstd")
    at = 4 + int.from_bytes(block[:4].to_pybytes(), "little")
    arrays = {}
    for line in block[4:at].to_pybytes().decode().split("\n"):
        name, kind, length, *sizes = line.split(" ")
        table = np.empty((int(length), len(sizes)), np.uint8)
        for i, size in enumerate(map(int, sizes)):
            plane = codec.decompress(block[at : at + size], decompressed_size=int(length))
            table[:, i] = np.frombuffer(plane, np.uint8)
            at += size
        arrays[name] = table.reshape(-1).view(np.dtype(kind))
    return arrays


def _cell_entries(cell: pa.Table) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Who asks at the posts of a part of a cell, and the others: the fields of all entries end to end, and under ``lengths`` how many each post has."""
    blocks = [_unpacked(one.as_buffer()) for one in cell["posts"]]
    together = {n: np.concatenate([_wide(block[n]) for block in blocks]) for n in blocks[0]}
    asks, others = ({n.removeprefix(f"{key}."): together[n] for n in together if n.startswith(f"{key}.")} for key in ("asks", "others"))
    first_asks, first_met = (np.cumsum(side["lengths"]) - side["lengths"] for side in (asks, others))
    so_far = np.cumsum(others["user_id"])
    before = so_far[first_met] - others["user_id"][first_met] - asks["user_id"][first_asks]
    others["user_id"] = so_far - np.repeat(before, others["lengths"])
    return asks, others


def _wide(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64) if values.dtype.kind in "iu" else values


def index_neighbours(k: int, at_once: int = 4_000_000):
    """A function for ``applyInArrow``: the K closest users of every user that asks in a cell.

    Pairs in which both have a heavy vector come out unranked, with their dot product as it stands.
    """

    def neighbours(cell: pa.Table) -> pa.Table:
        asks, others = _cell_entries(cell)
        users, asking = np.unique(asks["user_id"], return_index=True)
        u, v, dot, _ = _pair_sums(asks, others, users, at_once)
        apart = users[u] != others["user_id"][v]
        u, v, dot = u[apart], v[apart], dot[apart]
        norm2 = asks["norm2"][asking][u].astype(np.float64)
        other_norm2 = others["norm2"][v].astype(np.float64)
        value = dot / (np.sqrt(norm2) * np.sqrt(other_norm2))
        whole = ~(asks["has_vector"][asking][u] & others["has_vector"][v])
        # Pairs are in order of user, then other user; a stable sort leaves ties so.
        order = np.flatnonzero(whole)
        order = order[_near_first_k(u[order], value[order], k)]
        order = order[np.lexsort((-value[order], u[order]))]
        first = np.flatnonzero(np.diff(u[order], prepend=-1))
        place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        taken = np.concatenate([order[place < k], np.flatnonzero(~whole)])
        columns = (users[u], others["user_id"][v], value, norm2, other_norm2, dot, whole)
        names = ("user_id", "similar_user", "cosine_similarity", "norm2", "similar_norm2", "dot", "whole")
        return pa.table({n: c[taken] for n, c in zip(names, columns, strict=True)})

    return neighbours


def _near_first_k(group: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """Whether a value is not below the K-th largest of its group; groups are in order."""
    kept = np.ones(len(value), bool)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    for start, stop in zip(first, first + np.diff(first, append=len(group)), strict=True):
        if stop - start > k:
            part = value[start:stop]
            kept[start:stop] = part >= np.partition(part, len(part) - k)[len(part) - k]
    return kept


def index_pairs(at_once: int = 4_000_000):
    """A function for ``applyInArrow``: all pairs of a cell, the lesser id asking, with sum and number of their products.

    ``rest_b`` is what entries say that the greater id has outside of the index.
    """

    def pairs(cell: pa.Table) -> pa.Table:
        asks, others = _cell_entries(cell)
        users, asking = np.unique(asks["user_id"], return_index=True)
        u, v, dot, shared = _pair_sums(asks, others, users, at_once)
        ahead = users[u] < others["user_id"][v]
        u, v = u[ahead], v[ahead]
        columns = {"user_a": users[u], "user_b": others["user_id"][v]}
        columns |= {"norm2_a": asks["norm2"][asking][u], "norm2_b": others["norm2"][v]}
        columns |= {"dot_product": dot[ahead], "shared_posts": shared[ahead], "rest_b": others["rest"][v]}
        return pa.table(columns)

    return pairs


def _pair_sums(asks, others, users, at_once):
    """For every pair that shares a post: the numbers of who asks and of an entry of the other, sum and number of products.

    Pairs go by who asks, then by the id of the other.
    """
    meets = np.repeat(others["lengths"], asks["lengths"])
    begin = np.repeat(np.cumsum(others["lengths"]) - others["lengths"], asks["lengths"])
    whom, low = others["user_id"], int(others["user_id"].min(initial=0))
    span = int(whom.max(initial=0)) - low + 1
    if span * max(len(users), 1) < 2**62:
        whom = whom - low
    else:
        met, whom = np.unique(whom, return_inverse=True)
        span = len(met)
    who = np.searchsorted(users, asks["user_id"]) * span
    ends = np.cumsum(meets)
    pair, seen, count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.zeros(0, np.result_type(asks["total_score"]))
    # Sums of integers are the same in any order.
    kind = None if total.dtype.kind == "i" else "stable"
    start = 0
    while start < len(meets):
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + at_once, "right")), start + 1)
        part = slice(start, stop)
        number = np.repeat(np.arange(start, stop), meets[part])
        entry = _ranges(begin[part], meets[part])
        pairs = np.concatenate([pair, who[number] + whom[entry]])
        sums = np.concatenate([total, asks["total_score"][number] * others["total_score"][entry]])
        order = np.argsort(pairs, kind=kind)
        pairs = pairs[order]
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        if len(first):
            count = np.add.reduceat(np.concatenate([count, np.ones(len(entry), np.int64)])[order], first)
            total = np.add.reduceat(sums[order], first)
            pair, seen = pairs[first], np.concatenate([seen, entry])[order[first]]
        start = stop
    return pair // max(span, 1), seen, total, count


def pack_vectors():
    """A function for ``applyInArrow``: the scores of a block of users as one compressed Arrow stream."""

    def pack(key: tuple[pa.Scalar, ...], scores: pa.Table) -> pa.Table:
        rows = scores.select(["user_id", "post_id", "total_score", "norm2"]).sort_by([("user_id", "ascending"), ("post_id", "ascending")])
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)
        with pa.ipc.new_stream(sink, rows.schema, options=options) as stream:
            stream.write_table(rows)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "vectors": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return pack


def vector_pairs(least: float | None, min_shared: int, at_once: int = 1_000_000):
    """A function for ``applyInArrow``: all pairs of two blocks of users, or of one with itself, that share a post.

    Only those with a cosine of at least ``least``, if given, and ``min_shared`` common posts come
    out, strip after strip, so that a task holds some ``at_once`` pairs at a time.
    """

    def pairs(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {block: stream for batch in batches for block, stream in zip(*(batch.column(n).to_pylist() for n in ("block", "vectors")), strict=True)}
        first, second = key[0].as_py(), key[1].as_py()
        if first not in blocks or second not in blocks:
            return
        left, right = _scores_of(blocks[first]), _scores_of(blocks[second])
        posts = np.intersect1d(left["post_id"], right["post_id"])
        ids, first_row = np.unique(left["user_id"], return_index=True)
        other_ids, other_row = np.unique(right["user_id"], return_index=True)
        norm2, other_norm2 = left["norm2"][first_row], right["norm2"][other_row]
        dense = _Dense(right, other_ids, posts)
        strip = max(at_once // len(other_ids), 1)
        ends = np.append(first_row, len(left["user_id"]))
        for start in range(0, len(ids), strip):
            stop = min(start + strip, len(ids))
            part = {n: c[ends[start] : ends[stop]] for n, c in left.items()}
            dot, shared = dense.products(part, ids[start:stop])
            met = shared >= min_shared
            if first == second:
                met &= ids[start:stop, None] < other_ids[None, :]
            if least is not None:
                with np.errstate(divide="ignore", invalid="ignore"):
                    met &= dot / np.outer(np.sqrt(norm2[start:stop].astype(float)), np.sqrt(other_norm2.astype(float))) >= least
            u, v = np.nonzero(met)
            if not len(u):
                continue
            a, b = ids[start:stop][u], other_ids[v]
            turned = a > b
            norm_u, norm_v = norm2[start:stop][u], other_norm2[v]
            columns = {"user_a": np.minimum(a, b), "user_b": np.maximum(a, b)}
            columns |= {"norm2_a": np.where(turned, norm_v, norm_u), "norm2_b": np.where(turned, norm_u, norm_v)}
            columns |= {"dot_product": dot[u, v].astype(left["total_score"].dtype), "shared_posts": shared[u, v].astype(np.int64), "rest_b": np.zeros(len(u))}
            yield pa.RecordBatch.from_pydict(columns)

    return pairs


def _scores_of(stream: bytes) -> dict[str, np.ndarray]:
    table = pa.ipc.open_stream(stream).read_all()
    return {n: table[n].to_numpy() for n in table.column_names}


class _Dense:
    """Scores of a block of users as matrices over a list of posts, at most ``_COLUMNS_AT_ONCE`` of them at a time."""

    def __init__(self, scores: dict[str, np.ndarray], ids: np.ndarray, posts: np.ndarray):
        self.scores, self.ids, self.posts = scores, ids, posts
        self._only = self._matrices(scores, ids, posts) if len(posts) <= _COLUMNS_AT_ONCE else None

    def _matrices(self, scores, ids, posts):
        """Summed scores and numbers of rows; sums of integers are exact, in doubles where they stay below 2**53."""
        column = np.minimum(np.searchsorted(posts, scores["post_id"]), max(len(posts) - 1, 0))
        hit = posts[column] == scores["post_id"] if len(posts) else np.zeros(len(column), bool)
        at = np.searchsorted(ids, scores["user_id"][hit]), column[hit]
        whole = scores["total_score"].dtype.kind == "i"
        large = whole and max(int(self.scores["norm2"].max(initial=0)), int(scores["norm2"].max(initial=0))) >= 2**53
        weights = np.zeros((len(ids), len(posts)), np.int64 if large else np.float64)
        counts = np.zeros((len(ids), len(posts)), np.float32)
        np.add.at(weights, at, scores["total_score"][hit])
        np.add.at(counts, at, 1)
        return weights, counts

    def products(self, scores: dict[str, np.ndarray], ids: np.ndarray):
        """Dot products and numbers of common posts of other users with those of the block."""
        dot: np.ndarray | float = np.zeros((len(ids), len(self.ids)))
        shared = np.zeros((len(ids), len(self.ids)), np.float32)
        for start in range(0, len(self.posts), _COLUMNS_AT_ONCE):
            posts = self.posts[start : start + _COLUMNS_AT_ONCE]
            weights, counts = self._only or self._matrices(self.scores, self.ids, posts)
            own_weights, own_counts = self._matrices(scores, ids, posts)
            product = own_weights @ weights.T
            dot = product if start == 0 else dot + product
            shared += own_counts @ counts.T
        return dot, shared
