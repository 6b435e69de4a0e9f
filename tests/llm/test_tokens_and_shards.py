import io
import random

import duckdb
import numpy as np
import pytest
import tiktoken
from conftest import SMALL

from rankflow.llm import sharding, token_counts as tok


def blocks_of(spark, streams, size):
    rows = []
    for name, ids in streams.items():
        for b in range(0, max(len(ids), 1), size):
            rows.append((name, b // size, np.array(ids[b : b + size], "<u2").tobytes()))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "stream string, block int, ids binary")


def brute(streams, stop):
    out = []
    for name, ids in streams.items():
        n = place = 0
        for t in [*ids, None]:
            if t == stop or (t is None and n):
                out.append((name, place, n, t == stop))
                n, place = 0, place + 1
            else:
                n += 1
    return sorted(out)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_documents_across_blocks(spark, size):
    draw = random.Random(size)
    streams = {f"s{i}": [draw.choice([9, 9, 1, 2, 3, 4]) for _ in range(draw.randint(0, 40))] for i in range(6)}
    streams |= {"none": [], "only": [9], "open": [1, 2, 3], "long": [5] * 50 + [9], "empty ones": [9, 9, 9]}
    got = tok.token_counts(blocks_of(spark, streams, size), 9).collect()
    assert sorted(tuple(r) for r in got) == brute(streams, 9)


def test_files_without_index(spark, tmp_path):
    streams = {f"{i}.bin": [random.Random(i).choice([9, 1, 2]) for _ in range(50)] for i in range(3)}
    for name, ids in streams.items():
        np.array(ids, "<u2").tofile(tmp_path / name)
    got = tok.token_counts(tok.read_blocks(spark, str(tmp_path), tokens=8), 9).collect()
    assert sorted((r.stream.rsplit("/", 1)[1], r.ordinal, r.n_tokens, r.closed) for r in got) == brute(streams, 9)


def test_ranges_of_files_read_alike(spark, tmp_path):
    """However files are dealt to tasks, and where a name has blanks, the counts are the same."""
    draw = np.random.default_rng(5)
    flat = {"one file.bin": draw.integers(0, 12, 1_001), "empty.bin": draw.integers(0, 12, 0), "short.bin": draw.integers(0, 12, 3)}
    for name, ids in flat.items():
        (tmp_path / name).write_bytes(ids.astype("<u2").tobytes())
    for range_bytes in (1, 16, 100, 10**9):
        blocks = tok.read_blocks(spark, str(tmp_path), tokens=8, range_bytes=range_bytes)
        assert {r.stream.rsplit("/", 1)[1] for r in blocks.select("stream").collect()} == set(flat) - {"empty.bin"}
        got = tok.token_counts(blocks, 9).collect()
        assert sorted((r.stream.rsplit("/", 1)[1], r.ordinal, r.n_tokens, r.closed) for r in got) == brute({n: i.tolist() for n, i in flat.items()}, 9)


def test_a_file_beyond_2_gb(spark, tmp_path):
    """A sparse file: separators near its begin, around 2 GB, and as its last id."""
    size = (2**31 + 4_000_000) // 2
    places = [5, 2**30 - 1, 2**30, 2**30 + 77, size - 1]
    with open(tmp_path / "long.bin", "wb") as file:
        file.truncate(2 * size)
        for place in places:
            file.seek(2 * place)
            file.write(b"\x09\x00")
    got = tok.token_counts(tok.read_blocks(spark, str(tmp_path), tokens=1 << 20), 9).orderBy("ordinal").collect()
    assert [r.n_tokens for r in got] == [b - a - 1 for a, b in zip([-1, *places], places, strict=False)]
    assert all(r.closed for r in got)


def test_an_opener_and_a_file_shorter_than_listed(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x01\x00" * 50)
    whole = tok.read_blocks(spark, str(tmp_path), tokens=8, opener=lambda uri: io.BytesIO(b"\x09\x00" * 50))
    assert tok.token_counts(whole, 9).count() == 50
    short = tok.read_blocks(spark, str(tmp_path), tokens=8, opener=lambda uri: io.BytesIO(b"\x01\x00" * 20))
    with pytest.raises(Exception, match="ends before its listed length"):
        short.collect()


def test_query_matches_the_tokenizer(spark):
    encoding = tiktoken.Encoding("own", pat_str=tok._PATTERN, mergeable_ranks=tok.read_ranks(), special_tokens={})
    want = {r.doc_id: len(encoding.encode_ordinary(r.text)) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in tok.op1_token_counts(spark, SMALL).collect()} == want


def test_odd_texts_count(odd, docs):
    got = tok.document_token_counts(odd, tok.read_ranks()).collect()
    assert len(got) == odd.count()
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (1, 2))
    assert tok.document_token_counts(docs([]), tok.read_ranks()).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 40_000, 3_000])
def test_shards_match_sql(spark, limit):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(sharding.OP7_SQL.replace(str(sharding.SHARD_BYTES), str(limit))).fetchall()
    got = [tuple(r) for r in sharding.assign_shards(frame, limit=limit).collect()]
    assert sorted(got) == sorted(want)
    assert all(size <= limit or alone for _, _, _, size, alone in got)


def test_one_hot_key_is_split_by_its_texts(docs):
    rows = sharding.assign_shards(docs([(1, f"text {i} " * 20) for i in range(100)]), limit=3_000).collect()
    assert len(rows) == 100 and max(r.shard_bytes for r in rows) <= 3_000
    assert min(r.depth for r in rows) > sharding.KEY_BITS


def test_shards_of_odd_rows(odd, docs):
    rows = sharding.assign_shards(odd, limit=10).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id for r in rows if r.oversized} >= {3, 4, 6}  # too long alone, or equal rows
    assert sharding.assign_shards(docs([]), limit=10).count() == 0


def test_written_shards(spark, docs, tmp_path):
    frame = docs([(i, "text " * i) for i in range(40)])
    sharding.write_shards(frame, str(tmp_path / "out"), limit=1_000)
    folders = sorted((tmp_path / "out").glob("_shard=b*"))
    back = [spark.read.parquet(str(f)).agg({"n_chars": "sum", "doc_id": "count"}).first() for f in folders]
    assert len(back) > 3 and sum(r["count(doc_id)"] for r in back) == 40
    assert all(r["sum(n_chars)"] <= 1_000 for r in back)


def test_long_runs_of_blanks_are_counted(docs):
    """As the library counts them where it can, and piece by piece where its matcher gives up."""
    encoding = tiktoken.Encoding("own", pat_str=tok._PATTERN, mergeable_ranks=tok.read_ranks(), special_tokens={})
    rng = random.Random(1)
    for blank in (" ", "\t", "\n", "\r\n", "  ", "\x1c 　"):
        for n in (tok.LONG_RUN - 1, tok.LONG_RUN, 30_001):
            run = (blank * n)[:n]
            for text in (run, "a" + run, run + "b", f"it's{run}x 1{run}!? {run}", f"é{run}日本"):
                assert tok.encode_text(encoding, text).tolist() == encoding.encode_ordinary(text), (blank, n, text[:5])
    mixed = "".join(rng.choices(" \t\n", k=50_000))
    assert tok.encode_text(encoding, f"a{mixed}b").tolist() == encoding.encode_ordinary(f"a{mixed}b")
    huge = [(i, "a" + blank * 2_000_000 + "b") for i, blank in enumerate((" ", "\t", "\n"))]
    counted = {r.doc_id: r.n_tokens for r in tok.document_token_counts(docs(huge), tok.read_ranks()).collect()}
    for i, text in huge:
        single = len(encoding._encode_single_piece(text[1 : 2_000_000]))
        assert counted[i] == 1 + single + len(encoding.encode_ordinary(text[2_000_000:]))
