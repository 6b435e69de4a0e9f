import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rankflow.llm import conversation_repair as C
from rankflow.sources.workspace import Workspace
from tests.conftest import SMALL

TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()), StructField("role", StringType()), StructField("text", StringType()), StructField("pos", StringType()), StructField("here", StringType()), StructField("_c", StringType())])
INK = re.compile(r"[^\x20\x09-\x0D]")


def slow_repair(rows):
    """Edits in order of (cost, audit) until one ends well: ``rows`` are (role, text, fault)."""
    grammar = re.compile(r"(s?(ua)+)?")
    starts = re.compile(r"(s?(ua)*u?)?")
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and grammar.fullmatch(roles):
            return cost, audit, out

        def go(more, letter, step, line):
            new = roles + (line[0][:1] if line else "")
            if not line or (line[0] and starts.fullmatch(new)):
                heapq.heappush(heap, (cost + more, audit + letter, i + step, new, out + ((line,) if line else ())))  # noqa: B023

        for role in ("user", "assistant"):
            go(2, "I", 0, (role, ""))
        if i < len(rows):
            role, text, fault = rows[i]
            go(3, "D", 1, None)
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            go(extra, "K", 1, (role, text))
            for other in ("user", "assistant"):
                go(2 + extra, "R", 1, (other, text))


def slow_query(table):
    """The contract, row by row."""
    convs = {}
    for conv, turn, role, text in table:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(":".join(shown).encode()) % 20
        rows = convs.setdefault(conv, [])
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        rows += [(turn is not None, turn or 0, role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort()
        seen, marked = set(), []
        for _, _, role, text in rows:
            ink = INK.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "none"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for some, t, _, _ in rows if some}
        initials = [r[0][:1] for r in marked]
        cost, audit, lines = slow_repair(marked)
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(sum(f == m[2] for m in marked) for f in ("blank", "duplicate", "truncated")),
                sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
                cost,
                audit,
                hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.fixture
def query(spark, tmp_path):
    def run(rows):
        spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
        found = C.op13_conversation_repair(spark, str(tmp_path))
        return sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr)

    return run


def test_whole_small_table(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = C.op13_conversation_repair(spark, SMALL)
    assert sorted((tuple(r) for r in found.select(*COLUMNS).collect()), key=repr) == slow_query(table)


def test_odd_rows(query):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "Sure"]
    texts = ["Yes.", "No", "", " \t\n", None, "Why?! \n", "é…", "a ", "Yes.", "x" * 50_000 + "."]
    rows = [(rng.choice([*range(40), None]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(160)]
    rows += rows[:20]
    assert query(rows) == slow_query(rows)


def test_empty_table(query):
    assert query([]) == []


def test_repairs_are_cheapest_and_least():
    rng = random.Random(5)
    kinds = [(i, f) for i in "suao" for f in C.FAULTS]
    weights = [4 if f == "none" else 1 for _, f in kinds]
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for n in [*range(6)] * 60 + [9] * 25:
        rows = rng.choices(kinds, weights, k=n)
        codes = "".join(C.code(*r) for r in rows)
        cost, audit, lines = slow_repair([(names[i], str(k), f) for k, (i, f) in enumerate(rows)])
        assert C.repair(codes) == C.Repair(cost, audit), codes
        for block in (1, 2, 3):
            assert C.repair(codes, block) == C.Repair(cost, audit), (codes, block)
        told = [(names[rows[r][0]] if new is None else new, "" if r < 0 else str(r)) for r, new in C.written(codes, audit)]
        assert tuple(told) == lines


def test_long_conversations_are_searched_in_blocks():
    rng = random.Random(7)
    codes = "".join(C.code(rng.choice("suao"), rng.choices(C.FAULTS, (5, 1, 1, 1))[0]) for _ in range(700))
    assert C.repair(codes, 64) == C.repair(codes, 700)
    plain = "".join(C.code("ua"[k % 2], "none") for k in range(60_000))
    assert C.repair(plain) == C.Repair(0, "K" * 60_000)


def test_a_conversation_spread_over_tasks(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(3_000)] + [(2, 1, "user", "?")]
    report, turns = C.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8), Workspace(spark))
    assert [tuple(r) for r in report.orderBy("conv_id").select("conv_id", "cost", "audit").collect()] == [(1, 4, "I" + "K" * 3_000 + "I"), (2, 2, "KI")]
    one = [tuple(r) for r in turns.where("conv_id = 1").orderBy("seq").select("role", "text").collect()]
    assert one == [("user", ""), *(r[2:] for r in rows[:3_000]), ("assistant", "")]
