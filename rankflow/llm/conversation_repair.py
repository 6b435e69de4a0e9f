"""Conversations repaired by the cheapest edits that make their roles alternate.

A conversation is a string of *codes*, one character a row: the row's role initial, and what
is wrong with the row.  Repairs are paths through a lattice of (rows read, roles written so
far), whose edges keep, rerole, delete or insert a row.  The cheapest are found from both
ends: forward and reverse heaps meet, all crossings of the least cost are finished, and the
least concatenated audit among them is the repair.

Codes are all that a task needs of a conversation to repair it, one byte a row.  Texts stay in
a table dealt by (conversation, turn, ...), so a conversation of any length is spread over tasks,
and meet the edits of their rows there.  A long conversation is searched in blocks, from every
state to every state, so memory holds one block's lattice.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.sources.workspace import Workspace

#: Rows whose lattice is searched at once.
BLOCK = 256
#: Repairs of short conversations that a task remembers.
KNOWN = 20_000
#: Codes of the conversations that a task hands on together.
MOST_CODES = 4_000_000
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# Classes of characters of the contract, and what a row's hash does to it.
_INK, _END, _ENDS = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z", ".!?"
_DROP, _EMPTY, _CUT, _REPEAT, _TO_USER, _OF = 0, 1, 2, 3, 4, 20

#: Role states: nothing written, after s, after u, after a.  Only the first and last may end.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ACCEPT = (0, 3)
_ROLES = {"u": "user", "a": "assistant"}

#: Codes: initials s, u, a and o (any other), in four columns by fault.
FAULTS = ("none", "blank", "duplicate", "truncated")
_INITIALS = "suao"


def code(initial: str, fault: str) -> str:
    return chr(ord("A") + 4 * FAULTS.index(fault) + _INITIALS.index(initial))


_MEANING = {code(i, f): (i, f) for f in FAULTS for i in _INITIALS}


def _edges(codes: str, i: int, g: int) -> Iterator[tuple[int, int, int, str]]:
    """``(rows read, state, cost, letter)`` one edit on from (i, g)."""
    for r in _ROLES:
        if r in _NEXT[g]:
            yield i, _NEXT[g][r], INSERT, "I"
    if i == len(codes):
        return
    initial, fault = _MEANING[codes[i]]
    yield i + 1, g, DELETE, "D"
    if fault in ("blank", "duplicate"):
        return
    extra = TRUNCATED if fault == "truncated" else 0
    if initial in _NEXT[g]:
        yield i + 1, _NEXT[g][initial], extra, "K"
    for r in _ROLES:
        if r in _NEXT[g] and r != initial:
            yield i + 1, _NEXT[g][r], REROLE + extra, "R"


def _back_edges(codes: str, i: int, g: int) -> Iterator[tuple[int, int, int, str]]:
    """``(rows read, state, cost, letter)`` of the edits that lead to (i, g)."""
    for j in (i, i - 1):
        if j >= 0:
            for h in range(len(_NEXT)):
                for k, to, cost, letter in _edges(codes, j, h):
                    if (k, to) == (i, g):
                        yield j, h, cost, letter


def cheapest(codes: str, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest repairs from state ``start`` to one of ``ends``; ``None`` if no path leads there.

    Of two audits that lead to one place at one cost neither begins with the other, so the least
    beginning and the least rest make the least whole there.
    """
    n = len(codes)
    best: tuple[dict, dict] = ({(0, start): (0, "")}, {(n, g): (0, "") for g in ends})
    # Keeping a row is free, so of equal costs the place nearer to the heap's own end comes first.
    heaps = ([(0, 0, start)], [(0, -n, g) for g in ends])
    heapq.heapify(heaps[1])
    settled: tuple[set, set] = (set(), set())
    least: float = float("inf")
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= least:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, i, g = heapq.heappop(heaps[side])
        place = (abs(i), g)
        if place in settled[side] or cost > best[side][place][0]:
            continue
        settled[side].add(place)
        audit = best[side][place][1]
        if other := best[1 - side].get(place):
            least = min(least, cost + other[0])
        for j, h, more, letter in (_edges if side == 0 else _back_edges)(codes, *place):
            reached = (cost + more, audit + letter if side == 0 else letter + audit)
            old = best[side].get((j, h))
            if old is None or reached < old:
                best[side][j, h] = reached
                if old is None or reached[0] < old[0]:
                    heapq.heappush(heaps[side], (reached[0], j if side == 0 else -j, h))
            if other := best[1 - side].get((j, h)):
                least = min(least, reached[0] + other[0])
    if least == float("inf"):
        return None
    settled[1].update((n, g) for g in ends)
    return int(least), min(_crossings(codes, best, settled, int(least)))


def _crossings(codes: str, best: tuple[dict, dict], settled: tuple[set, set], least: int) -> Iterator[str]:
    """The least audit over every edge between the two settled parts, and every place in both, of a cheapest repair.

    Every place of such a repair is settled from one end or the other, as both together have
    gone beyond its cost.
    """
    for place in settled[0]:
        cost, audit = best[0][place]
        if place in settled[1] and cost + best[1][place][0] == least:
            yield audit + best[1][place][1]
        for j, h, more, letter in _edges(codes, *place):
            if (j, h) in settled[1] and cost + more + best[1][j, h][0] == least:
                yield audit + letter + best[1][j, h][1]


@dataclass(frozen=True)
class Repair:
    cost: int
    audit: str


def repair(codes: str, block: int = BLOCK) -> Repair:
    """The cheapest repair of a conversation with the least audit."""
    if not codes:
        return Repair(0, "")
    done: list[str] = []
    at = {0: (0, "")}
    for a in range(0, len(codes), block):
        part, last = codes[a : a + block], a + block >= len(codes)
        reached: dict[int, tuple[int, str]] = {}
        for g, (cost, audit) in at.items():
            for ends in [_ACCEPT] if last else [(h,) for h in range(len(_NEXT))]:
                if found := cheapest(part, g, ends):
                    new = (cost + found[0], audit + found[1])
                    reached[ends[0]] = min(reached.get(ends[0], new), new)
        agreed = commonprefix([audit for _, audit in reached.values()])
        done.append(agreed)
        at = {g: (cost, audit[len(agreed) :]) for g, (cost, audit) in reached.items()}
    cost, audit = min(at.values())
    return Repair(cost, "".join(done) + audit)


def written(codes: str, audit: str) -> Iterator[tuple[int, str | None]]:
    """For every row that an audit writes, the number of its source row (-1: none) and its new role (``None``: as it was).

    The letters and the roles kept settle the roles written.
    """
    state, row = 0, 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            role = _MEANING[codes[row]][0]
            yield row, None
        else:
            role = "a" if state == 2 else "u"
            yield (row if letter == "R" else -1), _ROLES[role]
        row += letter != "I"
        state = _NEXT[state][role]


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with rows dropped, emptied, cut, repeated or reroled by their hash.

    A dropped row stays, with ``here`` false, to name its conversation.  A null is one space, in the hash and in role and text; ``conv_id`` and ``turn`` stay null.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % _OF
    text, role = text_of("text"), text_of("role")
    damaged = (
        F.when(fate == _EMPTY, "").when(fate == _CUT, F.translate(text, _ENDS, "")).otherwise(text),
        F.when(fate == _TO_USER, "user").otherwise(role),
    )
    copies = F.when(fate == _REPEAT, F.array(F.lit(True), F.lit(True))).otherwise(F.array(fate != _DROP))
    return conversations.select("conv_id", "turn", damaged[1].alias("role"), damaged[0].alias("text"), F.explode(copies).alias("here"))


def _ordered(rows: DataFrame, work: Workspace) -> DataFrame:
    """Rows in a table dealt and sorted by conversation, turn (null first), role and text, with their place ``pos`` in it.

    Rows that are not ``here`` come last in their conversation, so those that are have adjoining
    places in every part of the table.
    """
    keys = ["conv_id", F.desc("here"), "turn", "role", "text"]
    lean = rows.withColumns({c: F.when(F.col("here"), F.col(c)) for c in ("role", "text")})
    dealt = lean.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return work.keep(dealt.select("conv_id", "turn", "role", "text", "here", F.monotonically_increasing_id().alias("pos")), "turns")


def _fault_codes(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, pos, code`` of the rows that are there."""
    key = F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)
    light = turns.where("here").select(
        "conv_id",
        "turn",
        "pos",
        F.when(~F.rlike("text", F.lit(_INK)), "blank").when(~F.rlike("text", F.lit(_END)), "truncated").otherwise("none").alias("fault"),
        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o").alias("initial"),
        F.when(F.rlike("text", F.lit(_INK)), key).alias("key"),
    )
    firsts = light.where("key is not null").groupBy("conv_id", "key").agg(F.min("pos").alias("pos"), F.count("*").alias("n")).where("n > 1")
    repeated = firsts.select(F.col("conv_id").alias("_c"), F.col("key").alias("_k"), F.col("pos").alias("_first"))
    marked = light.join(repeated, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k")), "left")
    fault = F.when(F.col("pos") > F.col("_first"), "duplicate").otherwise(F.col("fault"))
    number = sum((F.when(fault == f, 4 * i).otherwise(0) for i, f in enumerate(FAULTS)), F.lit(ord("A"))) + F.instr(F.lit(_INITIALS), F.col("initial")) - 1
    return marked.select("conv_id", "turn", "pos", F.char(number.cast("bigint")).alias("code"))


def _runs(turns: DataFrame, codes: DataFrame) -> DataFrame:
    """One row a conversation: its turns' range, and its codes in order, by part of the table: a run's first place and its codes."""
    run = codes.groupBy("conv_id", F.shiftright("pos", 33).alias("part")).agg(
        F.min("pos").alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "").alias("codes")
    )
    whole = run.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first", "codes"))).alias("runs"))
    turn = F.when(F.col("here"), F.col("turn"))
    gaps = turns.groupBy("conv_id").agg(F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"))
    named = whole.select(F.col("conv_id").alias("_c"), "runs")
    return gaps.join(named, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select("conv_id", "gaps", F.coalesce("runs", F.array().cast("array<struct<first:bigint,codes:string>>")).alias("runs"))


def _repaired(runs: DataFrame) -> DataFrame:
    """Runs with ``blank, duplicate, truncated, illegal, cost, audit``."""
    kind = runs.schema["conv_id"].dataType.simpleString()
    legal = {"su", "ua", "au"}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Repair] = {}
        for batch in batches:
            start, found, size = 0, [], 0
            for i, runs_of in enumerate(batch.column("runs")):
                codes = "".join(r["codes"] for r in runs_of.as_py())
                fixed = known.get(codes) or repair(codes)
                if len(codes) <= BLOCK and len(known) < KNOWN:
                    known[codes] = fixed
                faults = [_MEANING[c][1] for c in codes]
                initials = "".join(_MEANING[c][0] for c in codes)
                found.append([*(faults.count(f) for f in FAULTS[1:]), sum(initials[k : k + 2] not in legal for k in range(len(initials) - 1)), fixed.cost, fixed.audit])
                size += len(codes)
                if size > MOST_CODES or i == batch.num_rows - 1:
                    columns = [pa.array(x, pa.string() if k == 5 else pa.int64()) for k, x in enumerate(zip(*found, strict=True))]
                    yield pa.record_batch([*batch.slice(start, len(found)).columns, *columns], [*batch.schema.names, *FAULTS[1:], "illegal", "cost", "audit"])
                    start, found, size = i + 1, [], 0

    return runs.mapInArrow(rows, f"conv_id {kind}, gaps long, runs array<struct<first:bigint,codes:string>>, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


def _edits(repaired: DataFrame) -> DataFrame:
    """``conv_id, seq, pos, role`` of every row written; ``pos`` is null for one inserted, ``role`` for one as it was."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "seq", "pos", "role"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, runs, audit in zip(batch.column("conv_id"), batch.column("runs").to_pylist(), batch.column("audit").to_pylist(), strict=True):
                yield from part(conv, runs, audit)

    def part(conv: pa.Scalar, runs: list[dict], audit: str, most: int = 50_000) -> Iterator[pa.RecordBatch]:
        held, seq, run, before = [], 0, 0, 0
        for row, role in written("".join(r["codes"] for r in runs), audit):
            while row >= 0 and row - before >= len(runs[run]["codes"]):
                before += len(runs[run]["codes"])
                run += 1
            held.append((seq, None if row < 0 else runs[run]["first"] + row - before, role))
            seq += 1
            if len(held) == most:
                yield batch_of(conv, held)
                held = []
        if held:
            yield batch_of(conv, held)

    def batch_of(conv: pa.Scalar, held: list[tuple]) -> pa.RecordBatch:
        seqs, places, roles = zip(*held, strict=True)
        return pa.record_batch([pa.array([conv.as_py()] * len(held), conv.type), pa.array(seqs, pa.int64()), pa.array(places, pa.int64()), pa.array(roles, pa.string())], names)

    return repaired.select("conv_id", "runs", "audit").mapInArrow(rows, f"conv_id {kind}, seq long, pos long, role string")


def repair_conversations(conversations: DataFrame, work: Workspace, here: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Two tables: a report, one row per ``conv_id``, and the repaired turns ``conv_id, seq, role, text``.

    Nulls in ``conv_id`` make one conversation, in ``turn`` come first, in ``role`` and ``text`` read
    as one space.  Rows of one turn go by role, then text, so repeated rows are neighbours and all
    but the first are duplicates.  Rows where ``here`` is false only name their conversation, which
    is repaired without them.  Columns other than these are not read.
    """
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    turns = _ordered(conversations.select("conv_id", "turn", *spaced, (F.lit(True) if here is None else here).alias("here")), work)
    report = work.keep(_repaired(_runs(turns, _fault_codes(turns))), "report")
    edits = _edits(report)
    texts = turns.where("here").select("pos", F.col("role").alias("_role"), "text")
    kept = edits.where("pos is not null").join(texts, "pos").select("conv_id", "seq", F.coalesce("role", "_role").alias("role"), "text")
    inserted = edits.where("pos is null").select("conv_id", "seq", "role", F.lit("").alias("text"))
    return report.drop("runs"), kept.unionByName(inserted)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``role:text`` lines in order of ``seq``.

    A digest is read in order, so a conversation's rows pass one task, as a sorted stream of
    which it holds one batch.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, ids, done = None, None, [], []
        name_type = None

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(ids, name_type), pa.array(done, pa.string())], ["conv_id", "repaired_sha256"])

        for batch in batches:
            name_type = batch.column("conv_id").type
            for conv, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if digest is not None and conv == now:
                    digest.update(b"\n" + line.encode())
                    continue
                if digest is not None:
                    ids.append(now)
                    done.append(digest.hexdigest())
                now, digest = conv, hashlib.sha256(line.encode())
            if len(ids) > 10_000:
                yield out()
                ids, done = [], []
        if digest is not None:
            ids.append(now)
            done.append(digest.hexdigest())
            yield out()

    lines = turns.select("conv_id", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "line")
    return dealt.mapInArrow(rows, f"conv_id {kind}, repaired_sha256 string")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired turns of every conversation, after damage by hash."""
    report, turns = repair_conversations(damage(spark.read.parquet(f"{folder}/conversations.parquet")), Workspace(spark), F.col("here"))
    hashed = digests(turns).select(F.col("conv_id").alias("_c"), "repaired_sha256")
    return report.join(hashed, F.col("conv_id").eqNullSafe(F.col("_c")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256")
    )
