import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rankflow.llm import spelling_variants as V
from rankflow.sources.workspace import Workspace
from tests.conftest import SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def slow_counts(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def slow_variants(n):
    words = sorted(n)
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        near[w] = [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, []) if one_edit(w, v)]
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


def test_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n = slow_counts(rows)
    kept = dict(sorted(n.items(), key=lambda x: zlib.crc32(x[0].encode()))[:1500])
    assert len(kept) == min(len(n), 1500)
    counted = V.frequent(V.word_counts(spark.read.parquet(f"{SMALL}/documents.parquet"), V.DAMAGE_ONE_IN, V.MIN_LENGTH))
    assert {r["word"]: r["n"] for r in counted.collect()} == n
    assert told(V.op11_spelling_variants(spark, SMALL)) == slow_variants(n)


@pytest.mark.parametrize("symbols", [1, 2, 6, 40])
def test_all_pairs_one_edit_apart_are_found(spark, symbols):
    rng = random.Random(symbols)
    words = {"".join(rng.choices("abéÿ", k=rng.randint(1, 6))): rng.choice([1, 2, 5, 7, 30, 150, 150, 900]) for _ in range(300)}
    words |= {"x" * 3_000: 5, "x" * 2_999: 30, "x" * 1_500 + "y" + "x" * 1_499: 200}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert told(V.variants(df, Workspace(spark), symbols=symbols)) == slow_variants(words)


def test_chains_end_at_the_commonest(spark):
    words = {"aaaaaaaaaa"[:k] + "b" * (10 - k): 5**k for k in range(1, 11)}
    found = told(V.variants(spark.createDataFrame(list(words.items()), "word string, n long"), Workspace(spark)))
    assert found == slow_variants(words)
    assert {r[2] for r in found} == {"a" * 10}


def test_neighbourhoods_are_those_of_the_strings():
    rng = np.random.default_rng(0)
    for length in (1, 2, 5, 9):
        codes = rng.integers(1, 4, (6, length)).astype(np.uint64)
        for row, got in zip(codes.tolist(), V.neighbourhood(codes, 3), strict=True):
            edits = {tuple(row)}
            for i in range(length + 1):
                edits |= {tuple(row[:i] + [s] + row[i:]) for s in (1, 2, 3)}
                if i < length:
                    edits |= {tuple(row[:i] + row[i + 1 :])} | {tuple(row[:i] + [s] + row[i + 1 :]) for s in (1, 2, 3)}
            want = {int(V.reduced_hash(np.array([e], np.uint64))[0]) if e else 0 for e in edits}
            assert set(got.tolist()) == want


def test_odd_rows_and_empty_tables(spark, odd, docs, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert told(V.op11_spelling_variants(spark, str(tmp_path))) == slow_variants(slow_counts(rows))
    docs([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert told(V.op11_spelling_variants(spark, f"{tmp_path}/none")) == []


def test_counts_do_not_depend_on_the_flush(spark, docs, monkeypatch):
    df = docs([(i, f"Straße straße ÀÉ {'word' * (i % 3 + 1)} w{i}x") for i in range(300)])
    want = {r["word"]: r["n"] for r in V.word_counts(df, 7).collect()}
    monkeypatch.setattr(V, "HELD_WORDS", 3)
    assert {r["word"]: r["n"] for r in V.word_counts(df, 7).collect()} == want


def test_a_ratio_under_two_is_refused(spark):
    with pytest.raises(ValueError, match="twice"):
        V.variants(spark.createDataFrame([("word", 1)], "word string, n long"), Workspace(spark), ratio=1)
