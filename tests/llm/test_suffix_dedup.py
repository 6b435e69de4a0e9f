import collections
import hashlib
import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rankflow.llm import suffix_dedup as suf


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = collections.Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if times[x[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(x)))
        kept = bytes(v for v, g in zip(x, gone, strict=True) if not g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(frame, length, **sizes):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suf.remove_repeats(frame, length, **sizes).collect())


@pytest.mark.parametrize(("length", "gram", "step", "run"), [(40, 16, 8, 3000), (40, 8, 64, 10**6), (50, 16, 16, 2000), (41, 32, 5, 500)])
def test_matches_brute_force(docs, length, gram, step, run):
    draw = random.Random(length + step)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(draw.choice(words) for _ in range(draw.randint(5, 60))) for _ in range(8)]
    texts = [None, "", "x" * 200, "ab" * 100]
    for _ in range(50):
        parts = [draw.choice([draw.choice(passages), draw.choice(passages)[draw.randint(0, 40) :], " ".join(draw.choice(words) for _ in range(draw.randint(0, 30)))]) for _ in range(draw.randint(0, 5))]
        texts.append(" ".join(parts))
    texts += texts[5:9]
    want = sorted((str(i), *b) for i, b in enumerate(brute(texts, length)))
    assert got(docs(enumerate(texts)).repartition(5), length, gram=gram, step=step, run_bytes=run) == want


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = sorted((str(d.doc_id), *b) for d, b in zip(docs, brute([d.text for d in docs], 400), strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suf.op6_suffix_dedup(spark, SMALL).collect()) == want


def test_odd_rows(odd, docs):
    rows = {(str(r.doc_id), r.n_bytes): (r.n_removed, r.n_spans) for r in suf.remove_repeats(odd).collect()}
    left = [(str(r.doc_id), len(r.kept)) for r in suf.kept_bytes(odd).collect()]
    assert sorted(left) == sorted((i, n - rows[i, n][0]) for i, n in [("1", 0), ("2", 0), ("2", 0), ("None", 0), ("None", 9), ("3", 300_000), ("4", 420_000), ("5", 4), ("6", 23), ("6", 23)])
    assert rows["3", 300_000] == (300_000, 1) and rows["4", 420_000] == (420_000, 1)
    assert rows["1", 0] == rows["2", 0] == rows["None", 0] == (0, 0)
    assert suf.remove_repeats(docs([])).count() == 0


def test_equal_copies_lose_everything(docs):
    text = " ".join(f"w{i}" for i in range(300))
    assert [r.n_removed for r in suf.remove_repeats(docs([(1, text), (2, text)])).collect()] == [len(text)] * 2
    assert [r.n_removed for r in suf.remove_repeats(docs([(1, text)])).collect()] == [0]


def test_loser_tree_merges_and_counts_shared_prefixes():
    draw = random.Random(9)
    for _ in range(30):
        runs = [sorted({"".join(draw.choice("ab") for _ in range(draw.randint(0, 12))).encode() for _ in range(draw.randint(0, 20))}) for _ in range(draw.randint(1, 9))]
        coded = []
        for run in runs:
            shared = suf.shared_prefixes(run, 12).tolist() if run else []
            coded.append([(c, r[c:]) for c, r in zip(shared, run, strict=True)])
        merged = list(suf.merge_runs(coded))
        rows = [runs[r][i] for r, i, _ in merged]
        assert rows == sorted(x for run in runs for x in run)
        for (a, b), (_, _, c) in zip(zip(rows, rows[1:], strict=False), merged[1:], strict=True):
            assert c == len([1 for k in range(min(len(a), len(b))) if a[: k + 1] == b[: k + 1]])


def test_units_cover_every_window_once():
    text = bytes(random.Random(2).randrange(97, 123) for _ in range(3000))
    of, h, p, lo, hi = suf.anchors(np.frombuffer(text, np.uint8), np.array([0, 3000]), 100, 16)
    starts = []
    for suffix, left, q in suf.units_of(text, list(zip(p.tolist(), lo.tolist(), hi.tolist(), strict=True)), 100, 16):
        near, far = 100 - len(suffix), len(left)
        starts += [q - t for t in range(near, far + 1)]
        assert suffix == text[q : q + len(suffix)] and left == text[q - far : q]
    assert sorted(starts) == list(range(2901))


@pytest.mark.parametrize(("length", "gram", "step"), [(40, 16, 8), (40, 8, 64), (50, 16, 16)])
def test_small_parts_change_nothing(docs, monkeypatch, length, gram, step):
    monkeypatch.setattr(suf, "SAMPLE_TEXTS", 20)
    draw = random.Random(length)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(1, 6))) for _ in range(40)]
    passages = [" ".join(draw.choice(words) for _ in range(draw.randint(20, 60))) for _ in range(6)]
    texts = ["x" * 200, "ab" * 100]
    for _ in range(60):
        texts.append(" ".join(draw.choice([draw.choice(passages), draw.choice(passages)[draw.randint(0, 40) :], draw.choice(words)]) for _ in range(draw.randint(0, 5))))
    want = sorted((str(i), *b) for i, b in enumerate(brute(texts, length)))
    assert got(docs(enumerate(texts)).repartition(5), length, gram=gram, step=step, run_bytes=2000, part_bytes=600) == want


def test_a_line_in_every_text_is_split_by_what_follows(docs, tmp_path, spark):
    """One licence line of some 170 bytes: its units begin alike, and part after it."""
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(3, 8)))
    line = " ".join(word() for _ in range(27))[:170]
    part_bytes = 60_000
    for n in (600, 1200):
        texts = [(i, " ".join(word() for _ in range(70)) + f"\n{line}\n" + " ".join(word() for _ in range(70))) for i in range(n)]
        keyed = suf._keyed(docs(texts))
        found = suf.anchor_rows(keyed, 400, 64).cache()
        again = found.groupBy("h").count().where("count > 1").select("h")
        hits = found.join(again, "h", "left_semi").groupBy("k").agg(F.collect_set("h").alias("hits")).cache()
        splitters = suf.chosen_splitters(keyed, hits, 400, 64, 64, part_bytes)
        runs = suf.front_coded_runs(suf.packed(keyed).join(hits, "k"), splitters, 400, 64, 64, 10**6).where("part >= 0").collect()
        sizes = collections.Counter()
        for r in runs:
            shared = np.frombuffer(r.shared, "<u2").astype(int).sum() + np.frombuffer(r.tail_sizes, "<u2").astype(int).sum()
            sizes[r.part] += int(shared) + int(np.frombuffer(r.left_sizes, np.uint8).astype(int).sum())
        assert len(sizes) > n // 600 * 4 and max(sizes.values()) < 2 * part_bytes, (n, len(splitters), sizes.most_common(3))
