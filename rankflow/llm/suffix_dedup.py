"""Repeated byte strings removed, by a distributed merge sort of sampled suffixes.

A byte goes where it lies in a string of ``LENGTH`` bytes that starts anywhere else too.

1. Every window of that length picks an anchor by its content alone: its leftmost
   ``GRAM``-byte string of least hash.  Equal windows have equal anchors at equal places, so a window
   whose anchor occurs once is unique.  Anchor hashes are counted over the whole corpus.
2. Windows of repeated anchors are cut into units of ``STEP`` starts, at places fixed by the anchor.
   A unit is the suffix that all its windows share the beginning of, and the bytes to its left.
   A task sorts its units into runs, each distinct one once, and front-codes them: the length
   of the prefix shared with the one before, and the rest.
3. Runs are cut at splitters, sampled from units, in a number that follows the bytes of all units.
   Two suffixes with a window in common share more than the head that splitters are compared with, so
   no cut parts them; a line that many texts hold is split by what follows it.  Runs are exchanged and merged with a loser tree that keeps for
   every run the prefix it shares with the last suffix put out, and compares bytes only beyond equal
   ones.  The merged order comes with all shared prefixes: windows at one place of their
   units are equal where the prefix reaches their end and the bytes to the left agree.
4. What was found goes back by run to the texts, where spans are joined and cut out.

Only distinct units travel.  Their places stay with the run, so a passage that fills
a third of the corpus costs one unit per run.  Texts travel once, packed; those without a repeated
anchor stop there, and their digest is taken where they are read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import PIECE_BYTES, Texts, mix, pieces
from rankflow.llm.labelled import lowest_share
from rankflow.sources.workspace import Workspace

LENGTH = 400
#: Bytes of an anchor; a power of two.
GRAM = 64
STEP = 64
#: Bytes of units in one run, and in one part of the merge.
RUN_BYTES = 16_000_000
PART_BYTES = 8_000_000
#: Units sampled for every part, from whole texts, of which there are at least so many.
SAMPLE_UNITS, SAMPLE_TEXTS = 8, 256
_SEGMENT = 1 << 20
_PLACE_BITS = np.uint64(22)


def _least(keys: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` keys in a row."""
    span = 1
    while 2 * span <= size:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (size - span)], keys[size - span :]) if size > span else keys


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text number, hash, place, first and last window start of each anchor of texts laid end to end; places are within the text."""
    out = [[] for _ in range(5)]
    codes = mix(np.arange(1, 257, dtype=np.uint64))
    for base in range(0, max(len(data) - length + 1, 0), _SEGMENT):
        part = data[base : base + _SEGMENT + length - 1]
        h, span = codes[part], 1
        while span < gram:
            h = h[:-span] * np.uint64(0x9E3779B97F4A7C15) + h[span:]
            h ^= h >> np.uint64(29)
            span *= 2
        h = mix(h)
        place = np.arange(len(h), dtype=np.uint64)
        at = (_least(((h >> _PLACE_BITS) << _PLACE_BITS) | place, length - gram + 1) & np.uint64((1 << 22) - 1)).astype(np.int64)
        start = np.arange(len(at)) + base
        text = np.searchsorted(offsets, start, "right") - 1
        ok = start + length <= offsets[text + 1]
        at, start, text = at[ok], start[ok], text[ok]
        if not len(at):
            continue
        change = np.flatnonzero((at[1:] != at[:-1]) | (text[1:] != text[:-1])) + 1
        first, last = np.concatenate([[0], change]), np.concatenate([change, [len(at)]]) - 1
        own = text[first]
        for column, values in zip(out, (own, h[at[first]], at[first] + base - offsets[own], start[first] - offsets[own], start[last] - offsets[own]), strict=True):
            column.append(values)
    return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)


def anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``h, k``: the hash of every anchor, with the hash of its text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                flat = Texts.of(piece.column("text"))
                of, h, *_ = anchors(flat.data, flat.offsets, length, gram)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(piece.column("k").to_numpy()[of])], ["h", "k"])

    return texts.mapInArrow(rows, "h long, k long")


def packed(texts: DataFrame) -> DataFrame:
    """``k, n, z``: the texts compressed, to be shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                z = [zlib.compress(t.as_buffer(), 1) for t in piece.column("text").cast(pa.binary())]
                yield pa.record_batch([piece.column("k"), piece.column("n"), pa.array(z, pa.binary())], ["k", "n", "z"])

    return texts.mapInArrow(rows, "k long, n int, z binary")


def units_of(text: bytes, hits: list[tuple[int, int, int]], length: int, step: int) -> Iterator[tuple[bytes, bytes, int]]:
    """(suffix, bytes to the left, place of the suffix) for every unit of a text's repeated anchors.

    The window that starts t bytes left of the place takes ``length - t`` bytes of the
    suffix; the suffix ends where the unit's last window does, and the left part starts with its first.
    """
    for p, lo, hi in hits:
        for q in range(p - (p - hi) // step * step, p - (p - lo) // step * step - 1, -step):
            near, far = max(0, q - hi), min(step - 1, q - lo)
            yield text[q : q + length - near], text[q - far : q], q


def shared_prefixes(rows: list[bytes], width: int) -> np.ndarray:
    """Bytes that each of the sorted rows shares with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for i in range(0, len(rows), 8_192):
        part = rows[max(i - 1, 0) : i + 8_192]
        size = np.array([len(r) for r in part])
        table = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in part), np.uint8).reshape(len(part), width)
        differ = table[1:] != table[:-1]
        found = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        out[max(i, 1) : i + len(part) - (i > 0)] = np.minimum(found, np.minimum(size[1:], size[:-1]))
    return out


#: A row is a run's part, or with part -1 the packed text ``z`` of a text with repeated anchors.
_RUN_SCHEMA = "run string, part int, k long, n int, z binary, shared binary, tails binary, tail_sizes binary, lefts binary, left_sizes binary, many binary, occ_unit binary, occ_k binary, occ_n binary, occ_q binary"


def head_bytes(length: int, gram: int, step: int) -> int:
    """Leading bytes that two suffixes with a window in common share at least: the window but for what lies left, or the anchor."""
    return max(gram, length - step + 1)


def unit_heads(texts: DataFrame, length: int, gram: int, step: int) -> DataFrame:
    """``head``: the leading bytes of every unit of ``texts`` (``text``, and its repeated anchors ``hits``)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, hits in zip(batch.column("text"), batch.column("hits").to_pylist(), strict=True):
                raw, again = text.as_py().encode(), set(hits)
                flat = np.frombuffer(raw, np.uint8)
                _, h, p, lo, hi = anchors(flat, np.array([0, len(raw)]), length, gram)
                own = [j for j, x in enumerate(h.view(np.int64).tolist()) if x in again]
                units = units_of(raw, [(int(p[j]), int(lo[j]), int(hi[j])) for j in own], length, step)
                heads = {suffix[: head_bytes(length, gram, step)] for suffix, _, _ in units}
                yield pa.record_batch([pa.array(list(heads), pa.binary())], ["head"])

    return texts.select("text", "hits").mapInArrow(rows, "head binary")


def chosen_splitters(keyed: DataFrame, hits: DataFrame, length: int, gram: int, step: int, part_bytes: int) -> list[bytes]:
    """Heads that cut all units into parts of about ``part_bytes``, from a sample of texts that grows with the units.

    What comes to the driver is some units for every part.
    """
    size = hits.agg(F.sum(F.size("hits")).alias("n"), F.count("*").alias("texts")).first()
    units = (size.n or 0) * (length // 2 // step + 1)
    parts = units * (length + step) // part_bytes
    if parts < 2:
        return []
    need = max(SAMPLE_TEXTS, -(-SAMPLE_UNITS * parts * size.texts // units))
    few = hits.where(lowest_share(F.col("k"), need, size.texts))
    texts = keyed.join(few, "k").dropDuplicates(["k"])
    heads = sorted(bytes(x.head) for x in unit_heads(texts, length, gram, step).distinct().collect())
    return sorted({heads[len(heads) * i // parts] for i in range(1, parts)}) if heads else []


def front_coded_runs(candidates: DataFrame, splitters: list[bytes], length: int, gram: int, step: int, run_bytes: int) -> DataFrame:
    """Sorted, front-coded runs of units, one row for each run and part; ``occ_*`` list the units' places."""
    names, types = zip(*((f.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in _RUN_SCHEMA.split(", ")), strict=True)

    head = head_bytes(length, gram, step)

    def row(**values: object) -> pa.RecordBatch:
        return pa.record_batch([pa.array([values.get(c)], t) for c, t in zip(names, types, strict=True)], list(names))

    def emit(run: str, units: dict, places: list) -> Iterator[pa.RecordBatch]:
        order = sorted(units)
        rank = np.empty(len(order), np.int64)
        rank[[units[u] for u in order]] = np.arange(len(order))
        unit, k, n, q = (np.array(c, np.int64) for c in zip(*places, strict=True))
        unit = rank[unit]
        count = np.bincount(unit, minlength=len(order))
        part = np.array([bisect_right(splitters, u[0][:head]) for u in order])
        shared = shared_prefixes([u[0] for u in order], length)
        by = np.argsort(unit, kind="stable")
        unit, k, n, q = unit[by], k[by], n[by], q[by]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        for a, b in zip(first, np.append(first[1:], len(order)), strict=True):
            own, lcp = order[a:b], shared[a:b].copy()
            lcp[0] = 0
            lo, hi = np.searchsorted(unit, [a, b])
            tails = [u[0][c:] for u, c in zip(own, lcp.tolist(), strict=True)]
            yield row(
                run=run,
                part=int(part[a]),
                shared=lcp.astype("<u2").tobytes(),
                tails=zlib.compress(b"".join(tails), 1),
                tail_sizes=np.array([len(t) for t in tails], "<u2").tobytes(),
                lefts=zlib.compress(b"".join(u[1] for u in own), 1),
                left_sizes=np.array([len(u[1]) for u in own], np.uint8).tobytes(),
                many=(count[a:b] > 1).tobytes(),
                occ_unit=(unit[lo:hi] - a).astype("<i4").tobytes(),
                occ_k=k[lo:hi].astype("<i8").tobytes(),
                occ_n=n[lo:hi].astype("<i4").tobytes(),
                occ_q=q[lo:hi].astype("<i4").tobytes(),
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: dict[tuple[bytes, bytes], int] = {}
        places: list[tuple[int, int, int, int]] = []
        texts: dict[tuple[int, int], bytes] = {}
        held: list[tuple[bytes, int, int, set[int]]] = []
        size, waiting, name, turn = 0, 0, None, 0

        def take() -> int:
            """Units of the held texts; the bytes of those that are new."""
            flat = Texts.of(pa.array([t for t, *_ in held], pa.binary()))
            of, h, p, lo, hi = anchors(flat.data, flat.offsets, length, gram)
            cuts, added = np.searchsorted(of, np.arange(len(held) + 1)).tolist(), 0
            signed = h.view(np.int64).tolist()
            for i, (text, k, n, again) in enumerate(held):
                own = [j for j in range(cuts[i], cuts[i + 1]) if signed[j] in again]
                for suffix, left, q in units_of(text, [(int(p[j]), int(lo[j]), int(hi[j])) for j in own], length, step):
                    before = len(units)
                    places.append((units.setdefault((suffix, left), before), k, n, q))
                    added += (len(suffix) + len(left)) * (len(units) - before) + 16
            held.clear()
            return added

        for batch in batches:
            for i in range(batch.num_rows):
                name = name if name is not None else batch.column("task")[i].as_py()
                z, k, n = batch.column("z")[i].as_py(), batch.column("k")[i].as_py(), batch.column("n")[i].as_py()
                texts[k, n] = z
                held.append((zlib.decompress(z), k, n, set(batch.column("hits")[i].as_py())))
                waiting += n
                if waiting >= PIECE_BYTES:
                    size, waiting = size + take(), 0
                if size >= run_bytes:
                    yield from emit(f"{name}-{turn}", units, places)
                    units, places, size, turn = {}, [], 0, turn + 1
                    yield from (row(part=-1, k=k, n=n, z=z) for (k, n), z in texts.items())
                    texts.clear()
        take()
        if places:
            yield from emit(f"{name}-{turn}", units, places)
        yield from (row(part=-1, k=k, n=n, z=z) for (k, n), z in texts.items())

    return candidates.select("k", "n", "z", "hits", F.spark_partition_id().alias("task")).mapInArrow(rows, _RUN_SCHEMA)


def _beyond(a: bytes, b: bytes, at: int) -> int:
    """Bytes that a and b share, known to be ``at`` at least."""
    end = min(len(a), len(b))
    if a[at:end] == b[at:end]:
        return end
    size = 8
    while a[at : at + size] == b[at : at + size]:
        at += size
        size *= 2
    while size > 1:
        size //= 2
        if a[at : at + size] == b[at : at + size]:
            at += size
    return at


def merge_runs(runs: list[list[tuple[int, bytes]]]) -> Iterator[tuple[int, int, int]]:
    """(run, index in it, bytes shared with the suffix before) in sorted order, by a loser tree.

    ``runs`` hold (bytes shared with the one before, the rest).  The tree's nodes keep the loser of
    each match with the prefix it shares with the winner.  Every contender's prefix refers to the
    last suffix put out: of two, the one that shares more comes first, and only a draw looks at
    bytes, from there on.
    """
    leaves = 1
    while leaves < max(len(runs), 1):
        leaves *= 2
    text: list[bytes | None] = [r[0][1] if r else None for r in runs] + [None] * (leaves - len(runs))
    at = [0] * leaves
    common = [0] * leaves
    loser = [-1] * leaves

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix then refers to the winner."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if common[a] != common[b]:
            return (a, b) if common[a] > common[b] else (b, a)
        same = _beyond(x, y, common[a])
        first = (x[same : same + 1], a) <= (y[same : same + 1], b)
        win, lose = (a, b) if first else (b, a)
        common[lose] = same
        return win, lose

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        win, loser[node] = match(build(2 * node), build(2 * node + 1))
        return win

    win = build(1) if leaves > 1 else 0
    while text[win] is not None:
        yield win, at[win], common[win]
        at[win] += 1
        if at[win] < len(runs[win]):
            keep, rest = runs[win][at[win]]
            text[win], common[win] = text[win][:keep] + rest, keep
        else:
            text[win] = None
        node = (win + leaves) // 2
        while node:
            win, loser[node] = match(win, loser[node])
            node //= 2


def repeated_windows(shared: np.ndarray, size: np.ndarray, lefts: list[bytes], many: np.ndarray, length: int, step: int) -> np.ndarray:
    """For each unit in sorted order, the bits t of windows (t bytes left of the place) that occur twice or more.

    At place t, windows are equal where the shared prefixes reach ``length - t`` and the t bytes
    to the left agree; left parts are named exactly, one byte at a time.
    """
    n = len(size)
    out = np.zeros(n, np.uint64)
    near, far = length - size, np.array([len(x) for x in lefts])
    left = np.frombuffer(b"".join(x[::-1].ljust(step, b"\0") for x in lefts), np.uint8).reshape(n, step).astype(np.int64)
    close = shared >= length - step + 1
    alive = np.flatnonzero(many | close | np.append(close[1:], False))
    name = np.zeros(n, np.int64)
    for t in range(step):
        if t:
            alive = alive[far[alive] >= t]
            _, name[alive] = np.unique(name[alive] * 256 + left[alive, t - 1], return_inverse=True)
        own = alive[near[alive] <= t]
        if not len(own):
            continue
        block = np.cumsum(shared < length - t)[own]
        _, back = np.unique(block * (n + 1) + name[own], return_inverse=True)
        seen = np.bincount(back, 1 + many[own].astype(np.int64))
        out[own[seen[back] >= 2]] |= np.uint64(1) << np.uint64(t)
    return out


def merged_masks(runs: DataFrame, length: int, step: int) -> DataFrame:
    """``run, part, masks``: the repeated windows of every unit of a run's part, after the merge of all runs."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.select(["run", "part", "shared", "tails", "tail_sizes", "lefts", "left_sizes", "many"]).to_pylist()
        coded, lefts, many = [], [], []
        for r in rows:
            ends = np.cumsum(np.frombuffer(r["tail_sizes"], "<u2").astype(np.int64)).tolist()
            raw = zlib.decompress(r["tails"])
            tails = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            coded.append(list(zip(np.frombuffer(r["shared"], "<u2").tolist(), tails, strict=True)))
            ends = np.cumsum(np.frombuffer(r["left_sizes"], np.uint8).astype(np.int64)).tolist()
            raw = zlib.decompress(r["lefts"])
            lefts.append([raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)])
            many.append(np.frombuffer(r["many"], bool))
        run, index, shared = (np.array(c, np.int64) for c in zip(*merge_runs(coded), strict=True))
        sizes = [np.array([c + len(t) for c, t in own]) for own in coded]
        start = np.cumsum([0] + [len(c) for c in coded])
        place = start[run] + index
        found = repeated_windows(shared, np.concatenate(sizes)[place], [lefts[r][i] for r, i in zip(run.tolist(), index.tolist(), strict=True)], np.concatenate(many)[place], length, step)
        back = np.zeros(start[-1], np.uint64)
        back[place] = found
        return pa.table(
            {"run": [r["run"] for r in rows], "part": pa.array([r["part"] for r in rows], pa.int32()), "masks": [back[start[i] : start[i + 1]].tobytes() for i in range(len(rows))]}
        )

    return runs.where("part >= 0").select("run", "part", "shared", "tails", "tail_sizes", "lefts", "left_sizes", "many").groupBy("part").applyInArrow(merge, "run string, part int, masks binary")


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans put together where they overlap or touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate([[True], starts[1:] > ends[:-1]]))
    return starts[first], ends[np.append(first[1:], len(ends)) - 1]


def found_spans(runs: DataFrame, masks: DataFrame, length: int, step: int) -> DataFrame:
    """``k, n, spans``: per text and part of a run, the bytes of repeated windows as joined spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                unit, k, n, q = (np.frombuffer(r[c], t) for c, t in (("occ_unit", "<i4"), ("occ_k", "<i8"), ("occ_n", "<i4"), ("occ_q", "<i4")))
                mask = np.frombuffer(r["masks"], np.uint64)[unit]
                own = np.flatnonzero(mask)
                if not len(own):
                    continue
                own = own[np.lexsort((q[own], n[own], k[own]))]
                k, n, q, mask = k[own], n[own], q[own].astype(np.int64), mask[own]
                cuts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (n[1:] != n[:-1])]))
                names, lists = (k[cuts], n[cuts]), []
                for a, b in zip(cuts, np.append(cuts[1:], len(k)), strict=True):
                    bits = np.unpackbits(mask[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    i, t = np.nonzero(bits)
                    s = q[a:b][i] - t
                    spans = joined_spans(s, s + length)
                    lists.append(np.stack(spans, axis=1).astype("<i4").tobytes())
                yield pa.record_batch([*map(pa.array, names), pa.array(lists, pa.binary())], ["k", "n", "spans"])

    occ = runs.where("part >= 0").select("run", "part", "occ_unit", "occ_k", "occ_n", "occ_q")
    return occ.join(masks, ["run", "part"]).mapInArrow(rows, "k long, n int, spans binary")


def _keyed(documents: DataFrame, *columns: str) -> DataFrame:
    return documents.select(*columns, F.xxhash64("text").alias("k"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"), "text")


def repeated_spans(documents: DataFrame, length: int, work: Workspace, gram: int = GRAM, step: int = STEP, run_bytes: int = RUN_BYTES, part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """Of the distinct texts, named by hash and size, those with repeated anchors: ``k, n, z``, packed,
    and ``k, n, spans``: what to remove from them (lists of start and end, int32)."""
    keyed = _keyed(documents.where(F.octet_length("text") >= length))
    found = work.keep(anchor_rows(keyed, length, gram), "anchors")
    # Stored, so that the join below reads plain shuffles, of which Spark splits that of a hot anchor.
    again = work.keep(found.groupBy("h").count().where(F.col("count") > 1).select("h"), "repeated")
    hits = work.keep(found.join(again, "h", "left_semi").groupBy("k").agg(F.collect_set("h").alias("hits")), "hits")

    splitters = chosen_splitters(keyed, hits, length, gram, step, part_bytes)
    candidates = packed(keyed).join(hits, "k")
    runs = work.keep(front_coded_runs(candidates, splitters, length, gram, step, run_bytes), "runs")
    spans = found_spans(runs, merged_masks(runs, length, step), length, step).groupBy("k", "n").agg(F.collect_set("spans").alias("spans"))
    texts = runs.where("part = -1").groupBy("k", "n").agg(F.first("z").alias("z"))
    return texts, spans


def cut_out(text: bytes, spans: list[bytes]) -> tuple[bytes, int]:
    """What remains of a text, and the number of runs removed."""
    pairs = np.concatenate([np.frombuffer(s, "<i4").reshape(-1, 2) for s in spans]).astype(np.int64)
    starts, ends = joined_spans(pairs[:, 0], pairs[:, 1])
    return b"".join(text[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)), len(starts)


def kept_bytes(documents: DataFrame, length: int = LENGTH, work: Workspace | None = None, **sizes: int) -> DataFrame:
    """``doc_id, kept``: the bytes that remain of every document; a null text is empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                texts = piece.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
                kept = [cut_out(t, s)[0] if s else t for t, s in zip(texts, piece.column("spans").to_pylist(), strict=True)]
                yield pa.record_batch([piece.column("doc_id"), pa.array(kept, pa.binary())], ["doc_id", "kept"])

    _, spans = repeated_spans(documents, length, work or Workspace(documents.sparkSession), **sizes)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return _keyed(documents, "doc_id").join(spans, ["k", "n"], "left").select("doc_id", "text", "spans").mapInArrow(rows, f"doc_id {kind}, kept binary")


def remove_repeats(documents: DataFrame, length: int = LENGTH, work: Workspace | None = None, **sizes: int) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A null text is empty.  Texts under ``length`` bytes lose nothing.  Of equal texts every copy
    loses all it has, as each also starts in another; so do repeated rows.  Columns other than
    ``doc_id`` and ``text`` are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = zlib.decompress(batch.column("z")[i].as_py())
                rest, count = cut_out(text, batch.column("spans")[i].as_py())
                values = [len(text) - len(rest), count, hashlib.sha256(rest).hexdigest()]
                yield pa.record_batch([batch.column("k").slice(i, 1), batch.column("n").slice(i, 1), *(pa.array([v]) for v in values)], ["k", "n", "removed", "spans", "digest"])

    texts, spans = repeated_spans(documents, length, work or Workspace(documents.sparkSession), **sizes)
    changed = texts.join(spans, ["k", "n"]).mapInArrow(rows, "k long, n int, removed long, spans long, digest string")
    own = _keyed(documents, "doc_id").select("doc_id", "k", "n", F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole"))
    nothing = F.lit(0).cast("long")
    return own.join(changed, ["k", "n"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_bytes"),
        F.coalesce("removed", nothing).alias("n_removed"),
        F.coalesce("spans", nothing).alias("n_spans"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What every document of the table loses, and the digest of what remains."""
    return remove_repeats(spark.read.parquet(f"{folder}/documents.parquet"))
