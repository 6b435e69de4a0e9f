import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from rankflow.llm import byte_pairs as B
from tests.conftest import SMALL

PATTERN = public_tokenizers.PATTERN


def ranks_of(name):
    return B.read_ranks(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def ranks():
    return ranks_of("byte_bpe_50k.tiktoken")


def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def expected(rows, ranks):
    known, out = reference(ranks), []
    for doc_id, text in rows:
        ids = known.encode_ordinary(text or "")
        out.append((doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_small_table(spark, ranks):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in B.op12_byte_pairs(spark, SMALL).collect()), key=repr) == expected(rows, ranks)


def test_odd_rows_and_clashing_columns(odd, docs, ranks, tmp_path, spark):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in B.op12_byte_pairs(spark, str(tmp_path)).collect()), key=repr) == expected(rows, ranks)
    docs([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert B.op12_byte_pairs(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_texts_of_all_kinds(name):
    ranks, rng = ranks_of(name), random.Random(2)
    encoder, known = B.Encoder(ranks, PATTERN), reference(ranks)
    letters = "aeinorst lhd'x0 19\n\t.-éüß日本🙂ÐÑ\x1c\x85​"
    for n in [*range(1, 120)] * 8:
        text = "".join(rng.choices(letters, k=n))
        assert encoder.encode(text) == packed(known.encode_ordinary(text)), text


def test_single_long_matches(ranks):
    encoder, known, rng = B.Encoder(ranks, PATTERN), reference(ranks), random.Random(4)
    for text in ("x" * 20_000, "ab" * 9_000, "".join(rng.choices("abcdefgh", k=20_000)), "=" * 5_001, "日" * 3_000):
        assert encoder.encode(text) == packed(known.encode_ordinary(text))
    blanks = encoder.encode("a" + " " * 2_000_000 + "b")
    assert b"".join(B.Decoder(ranks).stream(np.frombuffer(blanks, "<u4").tolist())) == b"a" + b" " * 2_000_000 + b"b"


def test_a_full_store_changes_nothing(ranks):
    small, large, rng = B.Transducer(ranks, most_states=40), B.Transducer(ranks), random.Random(6)
    for _ in range(300):
        raw = bytes(rng.choices(b"etaoin shr\xc3\xa9", k=rng.randint(1, 40)))
        assert small.encode(raw) == large.encode(raw)
    assert len(small._states) <= 41 + 40


def test_output_lags_by_a_bounded_number_of_bytes(ranks):
    machine, decoder, rng = B.Transducer(ranks), B.Decoder(ranks), random.Random(8)
    longest = max(map(len, ranks))
    for _ in range(20):
        raw = "".join(rng.choices("thequickbrown", k=2_000)).encode()
        state, emitted = machine._start, 0
        for read, byte in enumerate(raw, 1):
            state, ids = state.get(byte) or machine._step(state, byte)
            emitted += len(decoder.decode(np.frombuffer(ids, "<u4")))
            assert read - emitted <= 2 * longest


def test_what_may_follow_is_what_merges_leave_apart(ranks):
    rng, merges = random.Random(3), B.Merges(ranks)

    def parts(data):
        own = [data[i : i + 1] for i in range(len(data))]
        while len(own) > 1:
            rank, i = min((ranks.get(own[i] + own[i + 1], 10**9), i) for i in range(len(own) - 1))
            if rank == 10**9:
                break
            own[i : i + 2] = [own[i] + own[i + 1]]
        return own

    tokens = [t for t in ranks if len(t) < 20]
    pieces = [t for t in tokens if t.strip().isalpha() and len(t) < 5]
    for a, b in [*(rng.choices(tokens, k=2) for _ in range(3_000)), *(rng.choices(pieces, k=2) for _ in range(20_000))]:
        assert merges.may_follow(a, b) == (parts(a + b) == [a, b]), (a, b)


def test_ranks_in_which_a_token_cannot_be_made():
    # "abc" has a rank but no merge makes it: it is that token only where it is a whole match.
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 258, b"abc": 300, b"abcd": 299}
    del ranks[b"bc"]
    ranks |= {b"cd": 257}
    known = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    encoder = B.Encoder(ranks, r"\S+|\s+")
    for text in ("abc", "abcd", "abcabc", "xabcd", "ab cd abcdabcd"):
        assert encoder.encode(text) == packed(known.encode_ordinary(text)), text


def test_missing_bytes_are_an_error():
    with pytest.raises(ValueError, match="single bytes"):
        B.Transducer({b"a": 0})


def test_decoding_streams_whole_characters(ranks):
    decoder, text = B.Decoder(ranks), "日本🙂é a"
    ids = [ranks[bytes([b])] for b in text.encode()]
    assert [c.decode() for c in decoder.stream(ids)] == list(text)
    broken = b"a\xe6\x97b\xff\xc3"
    assert b"".join(decoder.stream([ranks[bytes([b])] for b in broken])) == broken
    assert [*decoder.stream([ranks[b"\xc3"]])] == [b"\xc3"]


def test_the_machine_of_bytes_knows_exactly_the_valid_texts():
    rng = random.Random(1)
    for _ in range(20_000):
        raw = bytes(rng.choices([0x41, 0x7F, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC1, 0xC2, 0xE0, 0xE1, 0xED, 0xEF, 0xF0, 0xF1, 0xF4, 0xF5], k=rng.randint(1, 5)))
        state = B.BETWEEN
        for byte in raw:
            state = B.utf8_step(state, byte)
        try:
            raw.decode()
            valid = True
        except UnicodeDecodeError:
            valid = False
        assert (state != B.BROKEN and not state[0]) == valid, raw


def test_ranks_are_read_as_written(tmp_path):
    (tmp_path / "r").write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(256)))
    assert B.read_ranks(tmp_path / "r") == {bytes([b]): b for b in range(256)}


def test_decoding_at_once_is_decoding_by_the_stream(ranks):
    rng, decoder = random.Random(5), B.Decoder(ranks)
    encoder = B.Encoder(ranks, PATTERN)
    for _ in range(300):
        text = "".join(rng.choices("ab é日本🙂𝕏ßя \n", k=rng.randint(0, 60)))
        ids = np.frombuffer(encoder.encode(text), "<u4")
        assert decoder.decode(ids) == b"".join(decoder.stream(ids.tolist())) == text.encode()
        loose = np.array(rng.choices(range(len(ranks)), k=rng.randint(0, 30)), "<u4")
        assert decoder.decode(loose) == b"".join(decoder.stream(loose.tolist())) == b"".join(decoder.tokens[i] for i in loose.tolist())
    with pytest.raises(KeyError):
        decoder.decode(np.array([10**6], "<u4"))
