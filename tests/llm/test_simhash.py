import random

import numpy as np
import pytest
import xxhash
from conftest import SMALL, plan

from rankflow.llm import simhash_dedup as sim
from rankflow.llm.components import star_roots
from rankflow.sources.workspace import Workspace


def fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, radius=4):
    prints = sorted(set(prints))
    up = {p: p for p in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius and (x := root(a)) != (y := root(b)):
                up[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def crowded(n, seed):
    """Fingerprints in clouds, a few bits from some centres, and far ones."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(6)]
    out = [draw.getrandbits(64) for _ in range(n // 3)]
    while len(out) < n:
        p = draw.choice(centres)
        for _ in range(draw.randint(0, 9)):
            p ^= 1 << draw.randrange(64)
        out.append(p)
    return out


def test_query_matches_brute_force(spark):
    got = sim.op8_simhash_dedup(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {i: fingerprint(t) for i, t in texts.items()}
    up = classes(prints.values())
    first = {}
    for i, p in prints.items():
        first[up[p]] = min(first.get(up[p], i), i)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", first[up[p]]) for i, p in prints.items()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("tile", [8, 2048])
def test_any_plan_connects_the_same(spark, seed, tile):
    prints = np.array(sorted(set(crowded(300, seed))), np.uint64)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    want = len(set(classes(prints.tolist()).values()))
    bits = list(range(64))
    plans = [sim.plan_partitions(prints, n) for n in (300, 10**7, 10**9)] + [[(bits[:32], 1), (bits[32:], 2)], [(bits[:16], 0), (bits[16:32], 3)]]
    for plan in plans:
        assert sum(t + 1 for _, t in plan) == sim.RADIUS + 1
        found = sim.links(frame, plan, most=tile)
        u_v = [(r.u % 2**64, r.v % 2**64) for r in found.collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in u_v)
        if all(set(o).isdisjoint(p) for i, (o, _) in enumerate(plan) for p, _ in plan[i + 1 :]) and plan is not plans[-1]:
            up = {int(p): int(p) for p in prints}

            def root(x, up=up):
                while up[x] != x:
                    x = up[x]
                return x

            for a, b in u_v:
                up[max(root(a), root(b))] = min(root(a), root(b))
            assert len({root(p) for p in up}) == want


def test_bits_are_dealt_once(spark):
    sample = np.array(crowded(200, 5), np.uint64)
    for parts in (2, 3, 5, 6):
        groups = sim.group_bits(sample, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert max(map(len, groups)) - min(map(len, groups)) <= 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in star_roots(links, Workspace(spark), "chain").collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert star_roots(links.where("false"), Workspace(spark), "none").count() == 0


def test_odd_rows(odd, docs):
    got = sim.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    empty = [r for r in got if r.fp == 0]
    assert {r.doc_id for r in empty} >= {1, 2, 5, None} and {r.component_id for r in empty} == {1}
    kept = sim.keep_first(odd)
    assert kept.schema == odd.schema
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["1", "None", "3", "4", "6"])
    assert sim.near_duplicates(docs([])).count() == 0 and sim.keep_first(docs([])).count() == 0


def test_one_of_each_group_stays(docs):
    draw = random.Random(4)
    base = [" ".join(draw.choice("abcdefghij") + str(draw.randrange(50)) for _ in range(400)) for _ in range(3)]
    rows = [(10 + i, base[i % 3]) for i in range(30)] + [(7, base[1] + " tail")]
    kept = {r.doc_id for r in sim.keep_first(docs(rows)).collect()}
    up = classes([fingerprint(t) for _, t in rows])
    want = {}
    for i, t in rows:
        want[up[fingerprint(t)]] = min(want.get(up[fingerprint(t)], i), i)
    assert kept == set(want.values())


def test_rows_repeated_in_id_and_text_leave_one_whole_row(spark):
    one = "a few words that make a text of their own, long enough"
    rows = [(1, one, {"k": i % 3}, None if i == 2 else i) for i in range(6)] * 2
    rows += [(None, one, {}, 9), (2, "another text with other words in each and every place", {"z": 1}, 1), (None, "nobody owns this one text of so many words", None, None)] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, marks map<string,int>, _n int")
    kept = [sim.keep_first(table.repartition(n)) for n in (1, 5)]
    got = [sorted(map(repr, k.collect())) for k in kept]
    assert got[0] == got[1] and kept[0].schema == table.schema
    assert len(got[0]) == 3 and set(got[0]) <= {repr(r) for r in table.collect()}
    assert sorted(str(r.doc_id) for r in kept[0].collect()) == ["1", "2", "None"]


def test_few_rows_that_go_move_no_text(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = sim.keep_first(documents)
    assert kept.count() == len(classes_of(documents))
    steps = plan(kept)
    assert "LeftAnti, BuildRight" in steps and "SortMergeJoin" not in steps
    assert steps.count("hashpartitioning") == 1  # of rows that repeat both id and text


@pytest.mark.parametrize("bits", [6, 24])
def test_many_rows_that_go_move_only_marked_texts(spark, odd, monkeypatch, bits):
    """The pipeline's shuffle of all texts: only rows that share a mark with one that goes are joined."""
    monkeypatch.setattr(sim, "MARK_BITS", bits)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    tables = (odd.unionByName(odd.limit(3)), documents.unionByName(documents))
    want = [sorted(map(repr, sim.keep_first(t).collect())) for t in tables]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = [sim.keep_first(t) for t in tables]
        steps = [plan(k) for k in kept]
        assert [sorted(map(repr, k.collect())) for k in kept] == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all("LeftAnti" in s and "BroadcastHashJoin" in s.split("LeftAnti")[0] for s in steps)
    assert [len(w) for w in want] == [5, len(classes_of(documents))]


def test_marks_part_the_rows(spark):
    """All rows that go are marked, missing ids too, few others are, and no row is shuffled for it."""
    keyed = spark.range(20_000).selectExpr("if(id < 9, null, id) as _doc", "id * 7 as _hash", "'text' as _row")
    gone = keyed.where("_hash % 10 = 0").selectExpr("_doc as _id", "_hash as _text")
    marked = sim.marks(gone)
    sure, unsure = sim.by_marks(keyed, marked)
    assert sure.columns == unsure.columns == keyed.columns
    assert sure.count() + unsure.count() == 20_000 and marked.count() <= 2_000
    assert sure.where("_hash % 10 = 0").isEmpty() and 2_000 <= unsure.count() < 2_050
    assert "Exchange" not in plan(sure).split("BroadcastExchange")[0] and "SortMergeJoin" not in plan(sure)


def classes_of(documents):
    return set(classes([fingerprint(r.text) for r in documents.collect()]).values())
