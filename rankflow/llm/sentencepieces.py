"""SentencePiece models run by the tokenizers library.

The model file is parsed as its protobuf and rebuilt: normaliser, metaspace marker, the
pieces with their scores (unigram) or the merges that the scores stand for (BPE), and byte
fallback.  A normalised text is cut where a marker follows another character, which no piece
of such a model spans, so every distinct unit of a batch is encoded once, many at a time
on several threads.  Every unit's ids are compared with the sentencepiece library's own and
decoded again, and so the parity and the round trip of a text are known in full.  A model that
rewrites characters or drops spaces is compared on whole texts, its normalising included.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer, decoders, models, normalizers

from rankflow.llm.bytesarrays import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct units, and bytes of them and their ids, that a task keeps from batch to batch.
CACHE_UNITS = 300_000
CACHE_BYTES = 64_000_000
THREADS = 2
#: Units in one string handed to the tokenizer.
_JOINED = 64

# Fixed values of the model format: the marker of a space, model types, piece types.
_MARK = "▁"
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNUSED_BY_MERGES = 1, (2, 3, 5, 6)


@dataclass
class Rebuilt:
    """A model file taken apart: the tokenizer, and what surrounds it."""

    model: bytes
    tokenizer: Tokenizer
    prefix: bool
    squeeze: bool
    charsmap: normalizers.Normalizer | None
    whole: bool
    reference: sentencepiece.SentencePieceProcessor
    sizes: np.ndarray | None
    known: dict[str, bytes] = field(default_factory=dict)
    held: int = 0
    unlike: set[str] = field(default_factory=set)
    lost: set[str] = field(default_factory=set)

    @classmethod
    def of(cls, model: bytes) -> Rebuilt:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rule, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if any(p.type == 4 for p in proto.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        if not rule.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that mark a space before a word are supported")
        unknown = next((i for i, p in enumerate(proto.pieces) if p.type == 2), None)
        fallback = proto.trainer_spec.byte_fallback
        if kind == _UNIGRAM:
            low = min((p.score for p in proto.pieces if p.type == _NORMAL), default=0.0)
            scores = [(p.piece, p.score if p.type == _NORMAL else low - 10.0) for p in proto.pieces]
            core = models.Unigram(scores, unknown, fallback)
        elif kind == _BPE:
            core = models.BPE({p.piece: i for i, p in enumerate(proto.pieces)}, _merges(proto), unk_token=proto.pieces[unknown].piece, fuse_unk=True, byte_fallback=fallback)
        else:
            raise ValueError("only unigram and BPE models are supported")
        tokenizer = Tokenizer(core)
        spans = any(_MARK in p.piece.lstrip(_MARK) for p in proto.pieces if p.type == _NORMAL)
        whole = spans or (rule.remove_extra_whitespaces and not rule.add_dummy_prefix)
        sizes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces])
        strip = [decoders.Strip(" ", 1, 0)] if rule.add_dummy_prefix else []
        tokenizer.decoder = decoders.Sequence([decoders.Replace(_MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
        charsmap = normalizers.Precompiled(rule.precompiled_charsmap) if rule.precompiled_charsmap else None
        return cls(model, tokenizer, rule.add_dummy_prefix, rule.remove_extra_whitespaces, charsmap, whole, sentencepiece.SentencePieceProcessor(model_proto=model), sizes if fallback and not whole else None)

    def normalise(self, text: str) -> str:
        """The text as the model sees it, with markers for spaces; empty stays empty."""
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.prefix:
            text = " " + text
        return text.replace(" ", _MARK)

    def units(self, text: str) -> list[str]:
        plain = self.normalise(text)
        return ([plain] if plain else []) if self.whole else _FIND_UNITS(plain)

    def learn(self, units: list[str]) -> None:
        """Encode units not known yet, compare with the reference, and decode.

        Units that begin with a marker and go on are joined, some dozens to a string: nothing
        merges across their edges, and the bytes of the pieces tell where each unit ends.
        """
        if len(self.known) > CACHE_UNITS or self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
            self.unlike.clear()
            self.lost.clear()
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        joins = [u for u in new if self.sizes is not None and u[0] == _MARK and u[-1] != _MARK]
        self._learn([joins[i : i + _JOINED] for i in range(0, len(joins), _JOINED)])
        self._learn([[u] for u in new if u not in self.known])

    def _learn(self, groups: list[list[str]]) -> None:
        for i in range(0, len(groups), 2_000):
            part = groups[i : i + 2_000]
            whole = ["".join(g) for g in part]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]
            plain = [(u.removeprefix(_MARK) if self.prefix else u).replace(_MARK, " ") for u in whole]
            own = self.reference.encode(plain, num_threads=THREADS)
            if self.prefix and _MARK in whole:  # a last space by itself: the reference adds a prefix to a word only
                own[whole.index(_MARK)] = self.reference.encode("a ")[len(self.reference.encode("a")) :]
            back = self.tokenizer.decode_batch(found, skip_special_tokens=False)
            flat = np.fromiter(chain.from_iterable(found), "<i4")
            if len(part[0]) > 1:
                reach = np.cumsum(self.sizes[flat])
                ends = 4 * (np.searchsorted(reach, np.cumsum([len(u.encode()) for g in part for u in g])) + 1)
            else:
                ends = 4 * np.cumsum([len(f) for f in found])
            raw, at = flat.tobytes(), 0
            for u, end in zip(chain.from_iterable(part), ends.tolist(), strict=True):
                self.known[u] = raw[at:end]
                self.held += len(u) + end - at
                at = end
            odd = [g for g, a, b, p, d in zip(part, found, own, plain, back, strict=True) if a != b or p != d]
            for group in odd:
                if len(group) > 1:
                    self._learn([[u] for u in group])
                else:
                    k = part.index(group)
                    self.unlike.update(group if found[k] != own[k] else ())
                    self.lost.update(group if plain[k] != back[k] else ())

    def survives(self, text: str) -> bool:
        """Whether normalising, with the marker for the space, can be undone."""
        if not self.charsmap and not self.squeeze:
            return _MARK not in text
        return self.normalise(text).replace(_MARK, " ").removeprefix(" " if self.prefix else "") == text

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool], list[bool]]:
        """Offsets and ids of all texts, and per text the parity and the round trip."""
        cut = [self.units(t) for t in texts]
        self.learn([u for own in cut for u in own])
        parts = [b"".join(map(self.known.__getitem__, own)) for own in cut]
        ends = np.cumsum([0] + [len(p) // 4 for p in parts])
        if self.charsmap or self.squeeze:
            # Units come after this class's own normalising, so only whole texts can tell whether that is right.
            wanted = self.reference.encode(texts, num_threads=THREADS)
            parity = [p == np.asarray(w, "<i4").tobytes() for p, w in zip(parts, wanted, strict=True)]
        else:
            parity = [not self.unlike or self.unlike.isdisjoint(own) for own in cut]
        trip = [(not self.lost or self.lost.isdisjoint(own)) and self.survives(t) for own, t in zip(cut, texts, strict=True)]
        return ends.astype(np.int32), np.frombuffer(b"".join(parts), "<i4"), parity, trip


#: A run of markers with what follows it up to the next marker.
_UNIT = f"{_MARK}*[^{_MARK}]+|{_MARK}+"
_FIND_UNITS = re.compile(_UNIT).findall


def _merges(proto: sentencepiece_model_pb2.ModelProto) -> list[tuple[str, str]]:
    """Every way to put a piece together from two others; the piece of higher score goes first."""
    rank = {p.piece: (-p.score, i) for i, p in enumerate(proto.pieces) if p.type not in _UNUSED_BY_MERGES}
    halves = [(r, w[:k], w[k:]) for w, r in rank.items() for k in range(1, len(w)) if w[:k] in rank and w[k:] in rank]
    return [(a, b) for _, a, b in sorted(halves, key=lambda h: h[0])]


def encode_documents(documents: DataFrame, model: bytes, threads: int = THREADS) -> DataFrame:
    """``doc_id, n_tokens, ids, parity, round_trip`` of every document.

    ``parity``: the ids are the sentencepiece library's own.  ``round_trip``: decoding gives the
    text back; a literal marker character, which the format cannot tell from a space, does not.
    A null or empty text has no ids.  Repeated rows are encoded each; columns other than
    ``doc_id`` and ``text`` are not read.  The model, half a megabyte, travels with the task.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        rebuilt = Rebuilt.of(model)
        for batch in batches:
            for piece in pieces(batch, most=1_000_000):
                ends, ids, parity, trip = rebuilt.encode(piece.column("text").fill_null("").to_pylist())
                yield pa.record_batch(
                    [piece.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(parity, pa.bool_()), pa.array(trip, pa.bool_())],
                    ["doc_id", "n_tokens", "ids", "parity", "round_trip"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids array<int>, parity boolean, round_trip boolean")


def decode_documents(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give an empty text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Rebuilt.of(model).tokenizer
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = tokenizer.decode_batch([x or [] for x in part.column("ids").to_pylist()], skip_special_tokens=False)
                yield pa.record_batch([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, text string")


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document of the table."""
    return encode_documents(spark.read.parquet(f"{folder}/documents.parquet"), read_model())
