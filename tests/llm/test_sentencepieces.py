import random

import numpy as np
import sentencepiece
from conftest import SMALL
from sentencepiece import sentencepiece_model_pb2 as pb

from rankflow.llm import sentencepieces as sp


def unigram_model(prefix=True, squeeze=False, fallback=True):
    """A hand-made unigram model; nothing is trained."""
    model = pb.ModelProto()
    own = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{i:02X}>", 0, 6) for i in range(256) if fallback]
    own += [(p, -1 - (i * 37 % 17) * 0.413 - i * 0.0137, 1) for i, p in enumerate(["▁", "a", "b", "c", "▁a", "ab", "abc", "▁ab", "bc", "ca", "▁the", "the", "t", "h", "e", "▁▁"])]
    for piece, score, kind in own:
        model.pieces.add(piece=piece, score=score, type=kind)
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback, model.trainer_spec.unk_id = 1, fallback, 0
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces = "identity", prefix, squeeze
    return model.SerializeToString()


def charsmap(rules):
    """The format's table of rewritten characters for rules of one ASCII letter each: a double-array trie, then the texts that take their place."""
    units, texts = [0] * 1024, b""
    base = 256
    units[0] = base << 10
    for i, (letter, new) in enumerate(sorted(rules.items())):
        node = base ^ ord(letter)
        leaf = 512 + 2 * i
        units[node] = ((node ^ leaf) << 10) | (1 << 8) | ord(letter)
        units[leaf] = (1 << 31) | len(texts)
        texts += new.encode() + b"\x00"
    trie = np.array(units, "<u4").tobytes()
    return len(trie).to_bytes(4, "little") + trie + texts


def odd_texts(letters, n=400):
    draw = random.Random(1)
    return ["", " ", "  a", "a  "] + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def test_bpe_parity_and_round_trip():
    model = sp.read_model()
    texts = odd_texts([" ", "  ", "the", "ing", "\n", "é", "日", "🙂", "<s>", "\x00", "\t", " " * 17, " " * 40, "123"])
    ends, ids, parity, trip = sp.Rebuilt.of(model).encode(texts)
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == reference.encode(texts)
    assert all(parity) and all(trip)


def test_a_literal_marker_does_not_come_back():
    _, _, parity, trip = sp.Rebuilt.of(sp.read_model()).encode(["a▁b", "a b"])
    assert parity == [True, True] and trip == [False, True]


def test_unigram_parity():
    for prefix in (True, False):
        for squeeze in (True, False):
            model = unigram_model(prefix, squeeze)
            texts = odd_texts(["a", "b", "c", "abc", "the", " ", "  ", "é"])
            ends, ids, parity, trip = sp.Rebuilt.of(model).encode(texts)
            reference = sentencepiece.SentencePieceProcessor(model_proto=model)
            got, want = [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)], reference.encode(texts)
            assert got == want, (prefix, squeeze)
            assert all(parity) and (squeeze or all(trip))


def rewriting_model(rules):
    model = pb.ModelProto()
    model.ParseFromString(unigram_model())
    model.normalizer_spec.name, model.normalizer_spec.precompiled_charsmap = "own", charsmap(rules)
    return model.SerializeToString()


def test_a_model_that_rewrites_characters():
    """Ids are the library's where the two agree on the rewriting, and ``parity`` says where."""
    model = rewriting_model({"A": "a", "B": "bc", "T": "th"})
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    assert reference.encode("AB The") == reference.encode("abc thhe")
    texts = odd_texts(["A", "B", "T", "a", "b", "e", " ", "  ", "é"])
    ends, ids, parity, _ = sp.Rebuilt.of(model).encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == reference.encode(texts)
    assert all(parity)


def test_a_wrong_normaliser_is_seen():
    """Each unit by itself agrees with the library; the text does not."""
    rebuilt = sp.Rebuilt.of(rewriting_model({"A": "a"}))
    rebuilt.charsmap = sp.normalizers.Replace("A", "b")
    _, _, parity, _ = rebuilt.encode(["abc", "Abc", ""])
    assert parity == [True, False, True] and not rebuilt.unlike


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(sp, "CACHE_UNITS", 3)
    rebuilt, texts = sp.Rebuilt.of(sp.read_model()), ["one two three four five", "six seven one two", "one two three"]
    alone = [sp.Rebuilt.of(sp.read_model()).encode([t])[1].tolist() for t in texts]
    for t, want in zip(texts, alone, strict=True):
        assert rebuilt.encode([t])[1].tolist() == want


def test_query_round_trip(spark):
    encoded = sp.op10_sentencepiece(spark, SMALL)
    assert encoded.where("not parity or not round_trip").isEmpty()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id: r.text for r in sp.decode_documents(encoded, sp.read_model()).collect()} == texts
    assert encoded.where("n_tokens <> size(ids)").isEmpty()


def test_odd_rows(odd, docs):
    got = sp.encode_documents(odd, sp.read_model())
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.parity for r in rows)
    assert all(r.ids == [] for r in rows if r.doc_id in (1, 2))
    assert sp.encode_documents(docs([]), sp.read_model()).count() == 0
    back = sp.decode_documents(got, sp.read_model()).collect()
    assert {r.doc_id: r.text for r in back}[4] == "word and word " * 30_000
