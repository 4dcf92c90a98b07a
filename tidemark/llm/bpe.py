"""Byte-level BPE with a rank queue: bitmaps find the next rank, buckets hold the places to merge."""

from __future__ import annotations

import base64
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few_rows

#: Bounds of the broadcast rank file, of the bytes in which a worker remembers pieces, and of such a piece.
MAX_FILE, MAX_HELD, MAX_PIECE = 64 << 20, 96 << 20, 64
#: About what a piece takes beside its characters and ids: two objects and a place in a table.
_PIECE_BYTES = 200
_WORD = 8  # a bitmap word has 2 ** _WORD bits


class RankQueue:
    """Places by rank: a bucket for each rank, and bitmaps that find the least rank with a bucket.

    A bit of the lowest bitmap says that a rank has a bucket, a bit of each higher one that a word of the one
    below is not 0; so the next rank takes one find-first-set for each level.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while not self.levels or ranks > 1:
            ranks = (ranks + (1 << _WORD) - 1) >> _WORD
            self.levels.append([0] * max(ranks, 1))

    def fill(self, rank: int, places: list[int]) -> None:
        """Set the bucket of a rank that has none."""
        self.buckets[rank] = places
        for level in self.levels:
            bit = 1 << (rank & ((1 << _WORD) - 1))
            rank >>= _WORD
            filled = level[rank]
            level[rank] = filled | bit
            if filled:
                break

    def take(self) -> tuple[int, list[int]]:
        """Remove and give the least rank and its places from left to right; (-1, []) when empty."""
        if not self.levels[-1][0]:
            return -1, []
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << _WORD | ((word & -word).bit_length() - 1)
        at = rank
        for level in self.levels:
            bit = 1 << (at & ((1 << _WORD) - 1))
            at >>= _WORD
            level[at] ^= bit
            if level[at]:
                break
        places = self.buckets.pop(rank)
        places.sort()
        return rank, places


class Encoder:
    """Encodes and decodes by a table of ranks; every byte must have one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        self.pairs = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            self.tokens[rank] = token
            if len(token) == 2:
                self.pairs[token[0] << 8 | token[1]] = rank
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # pieces known before; those in use come back from here
        self.held = 0  # bytes that ``known`` takes

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, which must not be empty, as little-endian 32-bit integers.

        The pair of least rank merges first, the leftmost of several. All pieces share one queue, as they do not
        touch each other: symbols are a linked list over their places, and no pair crosses the start of a piece.
        """
        queue, data = self.queue, b"".join(pieces)
        rank_of, bucket_of = self.ranks.get, queue.buckets.get
        n, codes = len(data), np.frombuffer(data, np.uint8).astype(np.int64)
        starts = np.cumsum([0, *map(len, pieces)])
        begins = np.zeros(n + 1, bool)
        begins[starts] = True
        pairs = np.append(self.pairs[codes[:-1] << 8 | codes[1:]], -1)
        pairs[begins[1:]] = -1
        places = np.flatnonzero(pairs >= 0)
        places = places[np.argsort(pairs[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(pairs[places], prepend=-2, append=-2))
        ordered = places.tolist()
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            queue.fill(int(pairs[places[a]]), ordered[a:b])
        due = pairs.tolist()  # rank of the pair that starts at a place; a place in another bucket is stale
        begins, symbols = begins.tolist(), self.bytes[codes].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while True:
            rank, bucket = queue.take()
            if rank < 0:
                break
            least = rank
            for i, place in enumerate(bucket):
                if due[place] != rank:
                    continue
                if least < rank:  # a merge in this bucket made a pair that goes first
                    queue.fill(rank, bucket[i:])
                    break
                second = after[place]
                end = after[place] = after[second]
                symbols[place], symbols[second], due[second] = rank, -1, -1
                before[end] = place
                if begins[end]:
                    due[place] = -1
                else:
                    due[place] = fresh = rank_of(data[place : after[end]], -1)
                    if fresh >= 0:
                        other = bucket_of(fresh)
                        if other is None:
                            queue.fill(fresh, [place])
                        else:
                            other.append(place)
                        if fresh < least:
                            least = fresh
                if not begins[place]:
                    left = before[place]
                    due[left] = fresh = rank_of(data[left:end], -1)
                    if fresh >= 0:
                        other = bucket_of(fresh)
                        if other is None:
                            queue.fill(fresh, [left])
                        else:
                            other.append(left)
                        if fresh < least:
                            least = fresh
        ids = np.array(symbols, np.int64)
        lengths = np.add.reduceat(ids >= 0, starts[:-1], dtype=np.int64) if n else []
        ends = (np.cumsum(lengths) * 4).tolist()
        flat = ids[ids >= 0].astype("<u4").tobytes()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [self.split(text) for text in texts]
        if self.held > MAX_HELD // 2:
            self.known, self.older, self.held = {}, self.known, 0
        known, older, fresh = self.known, self.older, {}
        new = {piece for pieces in split for piece in pieces if piece not in known}
        rare = []
        for piece in new:
            data = piece.encode()
            if piece in older:
                fresh[piece] = older[piece]
            elif data in self.ranks:
                fresh[piece] = struct.pack("<I", self.ranks[data])
            else:
                rare.append((piece, data))
        if rare:
            fresh.update(zip((p for p, _ in rare), self.merge([d for _, d in rare])))
        known.update(fresh)
        found = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for piece, ids in fresh.items():
            if len(piece) > MAX_PIECE:
                del known[piece]
            else:
                self.held += _PIECE_BYTES + len(piece) + len(ids)
        return found

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def encoder(rank_file: bytes, pattern: str) -> Encoder:
    """The encoder of a rank file: a token in Base64 and its rank on each line."""
    lines = (line.split() for line in rank_file.splitlines() if line)
    return Encoder({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def shared_ranks(frame: DataFrame, path: str):
    """The rank file, broadcast; at most ``MAX_FILE`` bytes."""
    with open(path, "rb") as file:
        data = file.read(MAX_FILE + 1)
    if len(data) > MAX_FILE:
        raise ValueError(f"{path} has more than {MAX_FILE} bytes")
    return frame.sparkSession.sparkContext.broadcast(data)


def encoded(
    docs: DataFrame, path: str, pattern: str, also: list[Column] | None = None, separator: int | None = None, width: int = 4
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the columns ``also``, ids (binary: little-endian integers of ``width`` bytes).

    Each match of ``pattern`` in the whole text is encoded by the ranks in the file at ``path``, without special
    tokens; null is empty. A separator, if there is one, follows. Ids that do not fit, and a separator that is a
    token, are an error. Other columns of ``docs`` are not read, and no row moves to another task.
    """
    ranks = shared_ranks(docs, path)
    check_ids(encoder(ranks.value, pattern).ranks, path, separator, width)
    end = b"" if separator is None else separator.to_bytes(width, "little")

    def run(batches):
        encode = encoder(ranks.value, pattern).encode
        for batch in few_rows(batches):
            found = encode(batch.column("text").to_pylist())
            if width != 4 or end:
                found = [np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes() + end for ids in found]
            columns = [batch.column("doc_id"), *batch.columns[2:], pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *batch.schema.names[2:], "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *(also or []))
    others = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema.fields[2:])
    return rows.mapInArrow(run, f"doc_id long, {others}ids binary")


def check_ids(ranks: dict[bytes, int], path: str, separator: int | None, width: int) -> None:
    """An error if an id, or the separator, does not fit ``width`` bytes, or if the separator is a token."""
    ids = ranks.values()
    if max(ids) >= 1 << 8 * width or separator is not None and not 0 <= separator < 1 << 8 * width:
        raise ValueError(f"ids of {path}, or the separator, do not fit {width} bytes")
    if separator in ids:
        raise ValueError(f"the separator {separator} is a token of {path}")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens`` (doc_id, ids) with the bytes that the ids stand for; null ids are none."""
    ranks = shared_ranks(tokens, path)

    def run(batches):
        decode = encoder(ranks.value, pattern).decode
        for batch in few_rows(batches):
            found = [decode(i or b"") for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
