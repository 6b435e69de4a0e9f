import collections
import random
import re

import numpy as np
from conftest import SMALL, plan

from rankflow.llm import decontaminate as dec


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def best(text, item, size=5):
    w, i = words(text), words(item)
    size = min(size, len(i))
    if not i:
        return 0
    own = collections.Counter(tuple(i[j : j + size]) for j in range(len(i) - size + 1))
    top = 0
    for s in range(len(w) - len(i) + 1):
        here = collections.Counter(tuple(w[j : j + size]) for j in range(s, s + len(i) - size + 1))
        common = sum((own & here).values())
        top = max(top, common / (2 * (len(i) - size + 1) - common))
    return top


def found(documents, items):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in dec.contamination(documents, items).collect()}


def test_given_tables_match_brute_force(spark):
    got = {(r.doc_id, r.item_id) for r in dec.op3_decontaminate(spark, SMALL).collect()}
    docs, items = (spark.read.parquet(f"{SMALL}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = {(d.doc_id, i.item_id) for d in docs for i in items if words(i.text)[0] in words(d.text) and best(d.text, i.text) >= 0.8}
    assert got == want


def test_edited_passages(docs, items):
    draw = random.Random(1)
    noise = lambda n: " ".join(f"n{draw.randrange(3000)}" for _ in range(n))
    passages = [noise(draw.randint(30, 60)) for _ in range(12)]
    rows = []
    for i in range(150):
        p = draw.choice(passages).split()
        for _ in range(draw.randint(0, 3)):
            j = draw.randrange(len(p))
            p[j : j + 1] = draw.choice([[f"e{i}"], [], [p[j], f"e{i}"]])
        rows.append((i, f"{noise(draw.randint(0, 40))}. {' '.join(p).upper()}! {noise(20)}"))
    got = found(docs(rows), items(list(enumerate(passages))))
    want = {(i, j): round(b, 9) for i, t in rows for j, p in enumerate(passages) if (b := best(t, p)) >= 0.8}
    assert len(want) > 40 and got == want


def test_blocks_of_items_change_nothing(docs, items, monkeypatch):
    rows, own = [(i, f"a{i} b c d e f g h{i} i j") for i in range(20)], [(i, f"a{i} b c d e f g") for i in range(20)]
    whole = found(docs(rows), items(own))
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 3)
    assert found(docs(rows), items(own)) == whole and len(whole) == 20
    assert dec.drop_contaminated(docs(rows), items(own[:7])).count() == 13


def test_a_plan_holds_one_block_of_items(docs, items, monkeypatch):
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 3)
    own = items([(i, f"a{i} b c d e f g") for i in range(9)])
    rows = docs([(i, f"a{i} b c d e f g h i") for i in range(12)])
    assert plan(dec.contamination(rows, own)).count("MapInArrow") == 1
    kept = dec.drop_contaminated(rows, own)
    assert plan(kept).count("MapInArrow") == 1 and sorted(r.doc_id for r in kept.collect()) == [9, 10, 11]


def test_multi_index_loses_nothing_within_the_radius():
    draw = np.random.default_rng(0)
    items = draw.integers(0, 2**64, 300, dtype=np.uint64)
    of = draw.integers(0, 300, 4000)
    found = items[of]
    for k in range(4000):
        for bit in draw.choice(64, k % 30, replace=False):
            found[k] ^= np.uint64(1) << np.uint64(bit)
    index = dec.MultiIndex(items, 20)
    for i in range(300):
        apart = np.bitwise_count(found ^ items[i])
        assert (index.probe(found, i) == (apart <= 20)).all()
    listed = index.listed(found)
    assert (listed >= [(np.bitwise_count(f ^ items) <= 20).sum() for f in found]).all()


def test_the_tables_give_few_items_for_a_fingerprint():
    draw = np.random.default_rng(1)
    items, found = (draw.integers(0, 2**64, n, dtype=np.uint64) for n in (2000, 500))
    share = dec.MultiIndex(items, 20).listed(found).mean() / 2000
    blocks = 1 - (1 - 37 / 256) ** 8
    assert abs(share - blocks) < 0.02 and dec.MultiIndex(items, 7).listed(found).mean() / 2000 < 0.05


def test_repetitive_windows_far_apart_are_found(docs, items):
    """Items of a short period, and texts that begin at another place of it: alike, with all signs free to differ."""
    pairs = []
    for k in range(60):
        period = [f"p{k}x{j}" for j in range(2 + k % 4)]
        long = period * 12
        for size in (13, 17, 20):
            pairs.append((" ".join(long[:size]), " ".join(long[1 : size + 1])))
    documents, benchmark = docs([(i, d) for i, (_, d) in enumerate(pairs)]), items([(i, b) for i, (b, _) in enumerate(pairs)])
    got = found(documents, benchmark)
    want = {(i, i) for i, (b, d) in enumerate(pairs) if best(d, b) >= 0.8}
    assert len(want) > 30 and want <= got.keys()
    alone = dec.contamination(documents, benchmark).where("bits_apart > 20").count()
    assert alone > 0


def test_odd_rows_and_items(odd, docs, items):
    own = items([(1, None), (2, ""), (3, "!!"), (4, "null id"), (None, "word and word word and"), (5, "word and word word and"), (6, "日本"), (6, "日本")])
    got = found(odd, own)
    assert (None, 4) in got and (6, 6) in got
    assert not {k for k in got if k[1] in (1, 2, 3)}
    assert dec.contamination(odd, items([])).count() == 0 and dec.contamination(docs([]), own).count() == 0
    kept = dec.drop_contaminated(odd, own)
    assert kept.schema == odd.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "2", "None", "3", "5"])


def test_texts_shorter_than_the_item_are_compared_whole(docs, items):
    draw = random.Random(5)
    own = [[f"w{draw.randrange(400)}" for _ in range(n)] for n in (60, 60, 33, 14, 9, 6, 5, 4)]
    own.append(["a", "b", "c"] * 8)
    rows = []
    for item in own:
        for cut in range(12):
            rows += [item[: len(item) - cut], item[cut:], item[: len(item) // 2] + item[len(item) // 2 + cut :]]
        rows.append([*item[:7], "else", *item[8 : len(item) - 1]])

    def alike(a, b):
        size = min(5, len(b))
        x, y = (collections.Counter(tuple(w[j : j + size]) for j in range(len(w) - size + 1)) for w in (a, b))
        return (x & y).total() / (x | y).total()

    documents, benchmark = docs([(i, " ".join(r)) for i, r in enumerate(rows)]), items([(j, " ".join(b)) for j, b in enumerate(own)])
    want = {(i, j): round(x, 9) for i, r in enumerate(rows) for j, b in enumerate(own) if (x := alike(r, b) if len(r) < len(b) else best(" ".join(r), " ".join(b))) >= 0.8}
    short = {k for k in want if len(rows[k[0]]) < len(own[k[1]])}
    assert len(short) > 50 and found(documents, benchmark) == want
    assert dec.drop_contaminated(documents, benchmark).count() == len(rows) - len({i for i, _ in want})
