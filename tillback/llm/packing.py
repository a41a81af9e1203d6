"""Cost-balanced packing of documents into training sequences of at most ``size`` tokens.

A document's tokens and one end token are laid out whole where possible. Every task tokenizes its
own documents and packs them shard by shard: full blocks of a long document fill sequences alone;
the rest goes, in descending order of length, to the sequence with the lowest estimated cost that
still has room, where a piece of n tokens costs n + n * n / ``balance`` (linear layers and
attention). A piece that fits nowhere whole is cut. What is left over moves on to the task's next
shard, and the last one is closed with sequences of power-of-two lengths, so no sequence needs
padding. Memory is bounded by one shard and one document; nothing is shuffled. A sequence number is
the task's partition number and a running number, so a task that runs again gives the same rows.

Defined results: a null text is an empty one, whose only token is the end token. Rows keep their id,
null or repeated, as it is. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillback.llm.frames import keyed_texts, lists, slices

LATIN_LEADS = 0xC9  # UTF-8 bytes below this: code points up to U+023F


@dataclass(frozen=True)
class Packing:
    """Tokenizer files and the shape of sequences."""

    vocabulary: str
    ranks: str
    size: int = 2048
    end_id: int = 1
    shard_sequences: int = 256
    balance: int = 2048


def packing(**changes) -> Packing:
    """The byte-level vocabulary of 50,000 merges, whose files every executor has installed."""
    import public_tokenizers

    return Packing(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), **changes)


@lru_cache(maxsize=2)
def _encoders(vocabulary: str, ranks: str):
    import public_tokenizers
    import tiktoken
    import tokenizers

    whole = tokenizers.Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {token.content: number for number, token in whole.get_added_tokens_decoder().items()}
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens=special)
    return whole, quick, frozenset(special)


def token_ids(text: str, p: Packing) -> np.ndarray:
    """Ids of a text without the end token.

    Latin texts take the faster of two libraries that hold the same vocabulary; others take the one
    that defines the ids, because the two may sort rare characters into other classes. That one also
    takes texts that the faster one gives up on, such as a million blanks in a row.
    """
    whole, quick, special = _encoders(p.vocabulary, p.ranks)
    if not text:
        return np.zeros(0, np.uint32)
    if text.isascii() or max(text.encode("utf-8", "surrogatepass")) < LATIN_LEADS:
        try:
            if any(mark in text for mark in special):
                return np.array(quick.encode(text, allowed_special="all"), np.uint32)
            return np.array(quick.encode_ordinary(text), np.uint32)
        except BaseException as failure:  # the library's own panic is no Exception
            if type(failure).__name__ != "PanicException":
                raise
    return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)


class Piece:
    """A run of one document's ids that is not placed yet."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, ids: np.ndarray, start: int, total: int):
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.ids[:length], self.start, self.total),
                Piece(self.doc, self.ids[length:], self.start + length, self.total))


def powers_of_two(tokens: int) -> list[int]:
    return [1 << bit for bit in reversed(range(tokens.bit_length())) if tokens >> bit & 1]


def fill(pieces: list[Piece], capacities: list[int], balance: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Place pieces in descending order into the cheapest sequence with room; cut those without.

    Gives the pieces of every sequence and what is left when all sequences are full.
    """
    placed: list[list[Piece]] = [[] for _ in capacities]
    room = list(capacities)
    open_ = [(0.0, k) for k in range(len(capacities))]

    def put(piece: Piece, cost: float, k: int) -> None:
        n = len(piece.ids)
        placed[k].append(piece)
        room[k] -= n
        if room[k]:
            heapq.heappush(open_, (cost + n + n * n / balance, k))

    left, widest = [], max(room, default=0)
    for piece in sorted(pieces, key=lambda x: -len(x.ids)):
        n, passed = len(piece.ids), []
        if n <= widest:
            while open_:
                cost, k = heapq.heappop(open_)
                if room[k] >= n:
                    put(piece, cost, k)
                    piece = None
                    break
                passed.append((cost, k))
            if piece is not None:
                widest = max((room[k] for _, k in passed), default=0)
            for entry in passed:
                heapq.heappush(open_, entry)
        while piece is not None and open_:
            cost, k = heapq.heappop(open_)
            if len(piece.ids) <= room[k]:
                put(piece, cost, k)
                piece = None
            else:
                head, piece = piece.cut(room[k])
                put(head, cost, k)
        if piece is not None:
            left.append(piece)
    return placed, left


class Shards:
    """Packs one task's documents; hands out finished sequences as lists of pieces."""

    def __init__(self, p: Packing):
        self.p, self.rest, self.tokens = p, [], 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list[Piece]]:
        piece = Piece(doc, ids, 0, len(ids))
        while len(piece.ids) >= self.p.size:
            head, piece = piece.cut(self.p.size)
            yield [head]
        if len(piece.ids):
            self.rest.append(piece)
            self.tokens += len(piece.ids)
        if self.tokens >= self.p.shard_sequences * self.p.size:
            yield from self._close([self.p.size] * (self.tokens // self.p.size))

    def end(self) -> Iterator[list[Piece]]:
        yield from self._close([self.p.size] * (self.tokens // self.p.size) + powers_of_two(self.tokens % self.p.size))

    def _close(self, capacities: list[int]) -> Iterator[list[Piece]]:
        placed, self.rest = fill(self.rest, capacities, self.p.balance)
        self.tokens = sum(len(piece.ids) for piece in self.rest)
        yield from (pieces for pieces in placed if pieces)


FIELDS = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _packed(p: Packing, with_ids: bool):
    def rows(number: int, sequence: list[Piece]) -> Iterator[tuple]:
        offset = 0
        for piece in sequence:
            ids = piece.ids
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            yield piece.doc, piece.start, len(ids), crc, piece.total, number, offset, ids
            offset += len(ids)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        names = [field.split()[0] for field in FIELDS.split(", ")]
        columns = {name: pa.array([row[k] for row in found], pa.int64()) for k, name in enumerate(names)}
        if with_ids:
            ends = np.concatenate([[0], np.cumsum([len(row[7]) for row in found])])
            columns["ids"] = lists(np.concatenate([row[7] for row in found]).astype(np.int32), ends, pa.int32())
        return pa.record_batch(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, number = Shards(p), TaskContext.get().partitionId() << 32
        end = np.array([p.end_id], np.uint32)
        found: list[tuple] = []
        for whole in batches:
            for part in slices(whole, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    for sequence in shards.add(doc, np.concatenate([token_ids(text, p), end])):
                        found += rows(number, sequence)
                        number += 1
                if found:
                    yield batch(found)
                    found = []
        for sequence in shards.end():
            found += rows(number, sequence)
            number += 1
        if found:
            yield batch(found)

    return run


def packed(docs: DataFrame, p: Packing, *, with_ids: bool = True) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, its ids.

    ``ids_crc32`` is the checksum of the piece's ids as little-endian unsigned 32-bit numbers.
    """
    schema = FIELDS + (", ids array<int>" if with_ids else "")
    return keyed_texts(docs).mapInArrow(_packed(p, with_ids), schema)
