"""Byte-level BPE by a finite-state transducer that is determinised while it runs.

A sequence of tokens is what the merges make of its bytes exactly if they make every two
neighbours of it of their own bytes: no merge then crosses an edge, and whatever crosses one
in the whole crosses it in the two neighbours alone.  So the merges compile into a transducer
that reads bytes along tokens and, at a token's end, goes on to any token that may follow.
Of every beginning of a text exactly one sequence of tokens is right, so the transducer is
unambiguous, and a set of its states has one member for each place where a token may have
begun: as many as the longest token has bytes.

The subset construction runs on demand: a state of the deterministic machine is the set of
(tokens not yet emitted, bytes read of the next one), a step that was taken once is stored,
and the store is dropped when it is full.  What all members agree on is emitted at once,
so output lags by the bytes in which the members can still differ.

Decoding streams as well: a machine over tokens, itself filled in on demand from one over
bytes, tells after every token how many bytes of an open character are pending.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from os.path import commonprefix

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm.bytesarrays import pieces

#: Deterministic states, and bytes of remembered matches, that a task holds before it starts afresh.
MOST_STATES = 200_000
MOST_KNOWN_BYTES = 64_000_000
_BYTES = [bytes([b]) for b in range(256)]
_MEMBERS = -1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Merges:
    """The merges that a table of ranks stands for: parts join while their bytes together have a rank, least rank first, leftmost of equal ones.

    Whether one token may follow another is read off two short histories: the parts that stand at
    the left token's right end, and at the right one's left end, while each is merged by itself, with
    the greatest rank used so far.  The tokens stay apart if at no moment the two parts that
    face each other have a lesser rank together than what either side does next.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{len(missing)} single bytes have no rank, so some texts cannot be encoded")
        self.ranks = ranks
        self._histories: dict[bytes, tuple[list, list] | None] = {}
        self._follows: dict[tuple[bytes, bytes], bool] = {}

    def history(self, token: bytes) -> tuple[list, list] | None:
        """Left and right end part of ``token`` over time, each as (part, greatest rank used until it goes); ``None`` if merges don't make it."""
        if token not in self._histories:
            self._histories[token] = self._traced(token)
        return self._histories[token]

    def _traced(self, token: bytes) -> tuple[list, list] | None:
        parts, rank, latest = [token[i : i + 1] for i in range(len(token))], self.ranks.get, -1
        left, right = [], []
        while len(parts) > 1:
            best, at = min(((r, i) for i in range(len(parts) - 1) if (r := rank(parts[i] + parts[i + 1])) is not None), default=(None, 0))
            if best is None:
                return None
            latest = max(latest, best)
            if at == 0:
                left.append((parts[0], latest))
            if at == len(parts) - 2:
                right.append((parts[-1], latest))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        end = (token, float("inf"))
        return [*left, end], [*right, end]

    def may_follow(self, left: bytes, right: bytes) -> bool:
        """Whether ``right`` can stand after ``left``; after nothing, whether it can stand at all."""
        key = (left, right)
        known = self._follows.get(key)
        if known is None:
            known = self._follows[key] = self._apart(left, right)
        return known

    def _apart(self, left: bytes, right: bytes) -> bool:
        after = self.history(right)
        if after is None or not left:
            return after is not None
        ends, starts, rank, i, j = self.history(left)[1], after[0], self.ranks.get, 0, 0
        while True:
            (u, until), (v, till) = ends[i], starts[j]
            together = rank(u + v)
            if together is not None and together < until and together <= till:
                return False
            if until <= till:
                i += 1
                if i == len(ends):
                    return True
            else:
                j += 1

    def forget(self) -> None:
        self._follows.clear()


class Transducer:
    """Tokens of byte strings, by a deterministic machine built on demand.

    A state is a dictionary from a byte to the next state and the ids emitted on the way; under
    ``_MEMBERS`` it holds its members, three values each: the last token of a sequence, the packed
    ids of those of its tokens not yet emitted, and the bytes read since its end.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self._merges = Merges(ranks)
        self._ids = {token: i.to_bytes(4, "little") for token, i in ranks.items()}
        self._begun = {token[:i] for token in ranks for i in range(1, len(token))}
        self._most = most_states
        self._fresh()

    def _fresh(self) -> None:
        self._states: dict[tuple, dict] = {}
        self._merges.forget()
        gc.collect()  # states refer to each other
        self._start = self._state((b"", b"", b""))

    def _state(self, members: tuple) -> dict:
        state = self._states.get(members)
        if state is None:
            state = self._states[members] = {_MEMBERS: members}
        return state

    def _step(self, state: dict, byte: int) -> tuple[dict, bytes]:
        """Take and store the step of ``state`` on ``byte``."""
        members, states = state[_MEMBERS], self._states
        if len(states) > self._most:
            self._fresh()
            state, states = self._state(members), self._states
        add, after, ended, begun, ids = _BYTES[byte], [], None, self._begun, self._ids
        each = iter(members)
        for last, pending, read in zip(each, each, each, strict=True):
            read += add
            if ended is None and read in ids and self._merges.may_follow(last, read):
                ended = (read, pending + ids[read], b"")
            if read in begun:
                after += (last, pending, read)
        if ended is None:
            raise ValueError("the ranks leave a text without a tokenisation")
        after += ended
        out = b""
        if after[1]:
            out = commonprefix(after[1::3])
            out = out[: len(out) // 4 * 4]
            if out:
                after[1::3] = [pending[len(out) :] for pending in after[1::3]]
        key = tuple(after)
        following = states.get(key)
        if following is None:
            following = states[key] = {_MEMBERS: key}
        state[byte] = step = (following, out)
        return step

    def encode(self, data: bytes) -> bytes:
        """Ids of ``data`` as little-endian unsigned 32-bit integers; bytes that are one token as they stand are that token."""
        if data in self._ids:
            return self._ids[data]
        state, out = self._start, []
        for byte in data:
            state, ids = state.get(byte) or self._step(state, byte)
            if ids:
                out.append(ids)
        out.append(state[_MEMBERS][-2])
        return b"".join(out)


class Encoder:
    """Ids of texts: every match of a pattern goes through the transducer by itself, repeated matches once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._transducer = Transducer(ranks)
        self._find = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self._held = 0

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text.  New matches go in order, so that those which begin alike meet the same states in a row."""
        known, cut = self._known, [self._find(text) for text in texts]
        if self._held > MOST_KNOWN_BYTES:
            known.clear()
            self._held = 0
        for match in sorted(set().union(*cut).difference(known)):
            raw = match.encode()
            ids = known[match] = self._transducer.encode(raw)
            self._held += len(raw) + len(ids) + 150
        return [b"".join(map(known.__getitem__, own)) for own in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


#: The state after any byte that no character can go on from.
BROKEN = -1


def utf8_step(state: tuple[int, int, int] | int, byte: int) -> tuple[int, int, int] | int:
    """The UTF-8 machine: a state is (continuation bytes due, least and greatest value of the next), or ``BROKEN``."""
    if state == BROKEN:
        return BROKEN
    due, least, greatest = state
    if due:
        return (due - 1, 0x80, 0xBF) if least <= byte <= greatest else BROKEN
    if byte < 0x80:
        return state
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF)
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF)
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF)
    return BROKEN


BETWEEN = (0, 0x80, 0xBF)


class Decoder:
    """Texts of ids, token by token; whole characters come out as soon as their last byte is in."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: token for token, i in ranks.items()}
        self._after: dict[tuple, tuple] = {}
        self._whole = np.zeros(max(self.tokens) + 1, bool)
        self._listed = [self.tokens.get(i) for i in range(len(self._whole))]
        for i in self.tokens:
            self._whole[i] = self._read(BETWEEN, i)[0] == BETWEEN

    def _read(self, state: tuple | int, i: int) -> tuple:
        """State after token ``i``, and how many of its bytes end a character."""
        now, done = state, 0
        for k, byte in enumerate(self.tokens[i], 1):
            now = utf8_step(now, byte)
            if now == BROKEN:
                break
            if not now[0]:
                done = k
        self._after[state, i] = (now, done)
        return now, done

    def stream(self, ids: Iterable[int]) -> Iterator[bytes]:
        """Bytes of whole characters as ids come in.  An unfinished or broken character comes out as it stands, where the stream ends or breaks; what follows a break is passed on as bytes."""
        state, held, after, tokens = BETWEEN, b"", self._after, self.tokens
        for i in ids:
            if state == BROKEN:
                yield tokens[i]
                continue
            state, done = after.get((state, i)) or self._read(state, i)
            if state == BROKEN:
                yield held + tokens[i]
                held = b""
            elif state[0]:
                if done:
                    yield held + tokens[i][:done]
                    held = tokens[i][done:]
                else:
                    held += tokens[i]
            else:
                yield held + tokens[i]
                held = b""
        if held:
            yield held

    def decode(self, ids: np.ndarray) -> bytes:
        """All bytes of ``ids``: runs of tokens that are whole characters at once, the rest through the stream."""
        values, token = ids.tolist(), self._listed.__getitem__
        if not len(ids) or int(ids.max()) >= len(self._whole):
            return b"".join(map(self.tokens.__getitem__, values))  # of an id without a token, the error says which
        broken = np.flatnonzero(~self._whole[ids])
        if not len(broken):
            return b"".join(map(token, values))
        first = np.flatnonzero(np.diff(broken, prepend=-2) > 1)
        begin, end = broken[first].tolist(), (broken[np.append(first[1:], len(broken)) - 1] + 1).tolist()
        out, at = [], 0
        for a, b in zip(begin, end, strict=True):
            out += map(token, values[at:a])
            out += self.stream(values[a:b])
            at = b
        out += map(token, values[at:])
        return b"".join(out)


@contextmanager
def _no_collector() -> Iterator[None]:
    """The states are many small objects that live long; the collector would walk them again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def encode_documents(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row; ids are little-endian unsigned 32-bit integers in one binary value.

    A null or empty text has no ids.  Null ids and repeated rows are kept as they are; columns
    other than ``doc_id`` and ``text`` are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for piece in pieces(batch):
                with _no_collector():
                    ids = encoder.encode_all([text or "" for text in piece.column("text").to_pylist()])
                yield pa.record_batch([piece.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(rows, f"doc_id {kind}, ids binary")


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for; null ids stand for none.

    An id without a token is an error, since nothing can be put in its place.
    """
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks)
        for batch in batches:
            for piece in pieces(batch, "ids"):
                texts = [decoder.decode(np.frombuffer(ids or b"", "<u4")) for ids in piece.column("ids").to_pylist()]
                yield pa.record_batch([piece.column("doc_id"), piece.column("ids"), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {kind}, ids binary, decoded binary")


def op12_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = encode_documents(spark.read.parquet(f"{folder}/documents.parquet"), ranks, public_tokenizers.PATTERN)
    ids = F.coalesce("ids", F.lit(b""))
    return decode_documents(encoded, ranks).select(
        "doc_id",
        (F.octet_length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
