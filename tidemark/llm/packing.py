"""Best-fit packing of documents into bins, with conflicts between sources and between duplicates.

``packed`` gives places for any sizes, ``sequences`` the filled bins themselves, ready to train on.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import whole_text, written

CAPACITY = 16384
#: Documents, and bytes of their ids, that a packing task is dealt on average.
GROUP_ROWS, GROUP_BYTES = 4096, 64 << 20


class Bin:
    __slots__ = ("number", "residual", "sources", "clusters", "size")

    def __init__(self, number: int, capacity: int):
        self.number, self.residual, self.sources, self.clusters, self.size = number, capacity, 0, 0, 0


class Bins:
    """Open bins by residual, and a bitmap of the residuals that have one."""

    def __init__(self, capacity: int):
        self.capacity, self.filled, self.made = capacity, 0, 0
        self.by_residual: list[list[Bin]] = [[] for _ in range(capacity + 1)]

    def tightest(self, size: int, source: int, cluster: int) -> Bin | None:
        """Remove and give the bin with the least sufficient residual that has neither the source nor the cluster."""
        rest = self.filled >> size
        residual = size - 1
        while rest:
            step = (rest & -rest).bit_length()
            residual += step
            rest >>= step
            held = self.by_residual[residual]
            for i, found in enumerate(held):
                if not (found.sources & source or found.clusters & cluster):
                    del held[i]
                    if not held:
                        self.filled ^= 1 << residual
                    return found
        return None

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, position in it) for an item; opens a bin where none is compatible."""
        best = self.tightest(size, source, cluster)
        if best is None:
            best = Bin(self.made, self.capacity)
            self.made += 1
        place = best.number, best.size
        best.residual -= size
        best.sources |= source
        best.clusters |= cluster
        best.size += 1
        if best.residual:
            self.by_residual[best.residual].append(best)
            self.filled |= 1 << best.residual
        return place


def bits_of(values: list, shared_only: bool) -> list[int]:
    """A bit for each distinct value; none for null or, if asked, for a value that occurs once."""
    seen: dict = {}
    for value in values:
        seen[value] = seen.get(value, 0) + 1
    numbers = {v: 1 << i for i, v in enumerate(v for v, n in seen.items() if v is not None and (n > 1 or not shared_only))}
    return [numbers.get(value, 0) for value in values]


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """(bin, position) of each item, largest first, as they are given when of one size."""
    bins = Bins(capacity)
    source_bits, cluster_bits = bits_of(sources, False), bits_of(clusters, True)
    places = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        places[i] = bins.place(sizes[i], source_bits[i], cluster_bits[i])
    return places


def packed(docs: DataFrame, size: Column, source: Column, cluster: Column, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, size, bin (group and number), position.

    A document of more than ``capacity`` fills bins of its own with all but its last piece; every document has a
    last piece, of size 0 where it is empty (or its size null). No bin holds more than the capacity, two documents
    of one source, or two of one cluster; a null source or cluster conflicts with none. A piece goes to the
    tightest compatible bin. Rows that repeat a doc_id, or have none, are separate documents. An empty table
    gives an empty result; other columns are not read.

    Documents are numbered and dealt to groups by a hash of the number, ``GROUP_ROWS`` to a group on average,
    and each group is packed in one task: equal rows, sources and clusters of any size spread over the groups, and
    the bins that a group leaves open are few against the bins it fills. Only these columns are written and shuffled.
    """
    items = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(size, F.lit(0)).cast("long").alias("size"), source.cast("string").alias("source"), cluster.alias("cluster")
    )

    def run(key, table):
        rows = [(doc_id, *rest) for doc_id, _, *rest in pieces_of(ordered(table), capacity)]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        group = pa.array([key[0].as_py()] * len(rows), pa.int64())
        return pa.Table.from_arrays([*columns[:4], group, *columns[4:]], ["doc_id", "piece", "start", "size", "group", "bin", "position"])

    out = "doc_id long, piece long, start long, size long, group long, bin long, position long"
    return dealt(items).groupBy("group").applyInArrow(run, out)


def dealt(items: DataFrame) -> DataFrame:
    """The items, written, with the group that each is dealt to by a hash of its number."""
    # numbers are fixed by being written: a lost task finds the same ones
    items = written(items.withColumn("number", F.monotonically_increasing_id()))
    size = F.sum(F.octet_length("ids")) if "ids" in items.columns else F.lit(0)
    n, total = items.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    groups = max(1, math.ceil(n / GROUP_ROWS), math.ceil(total / GROUP_BYTES))
    return items.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups))).drop("number")


def ordered(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("size", "ascending"), ("cluster", "ascending"), ("source", "ascending")])


def pieces_of(table: pa.Table, capacity: int) -> list[tuple]:
    """(doc_id, row, piece, start, size, bin, position) for the pieces of the items in a group's table."""
    ids, sizes, sources, clusters = (table[c].to_pylist() for c in ("doc_id", "size", "source", "cluster"))
    last = [s and (s - 1) % capacity + 1 for s in sizes]
    places = pack(last, sources, clusters, capacity)
    rows, opened = [], 1 + max(b for b, _ in places)
    for row, (doc_id, whole, rest, (number, position)) in enumerate(zip(ids, sizes, last, places)):
        for piece in range((whole - rest) // capacity):
            rows.append((doc_id, row, piece, piece * capacity, capacity, opened, 0))
            opened += 1
        rows.append((doc_id, row, (whole - rest) // capacity, whole - rest, rest, number, position))
    return rows


_PIECE = pa.struct([(name, pa.int64()) for name in ("doc_id", "piece", "start", "size", "at")])
_SEQUENCES = pa.schema([("group", pa.int64()), ("bin", pa.int64()), ("size", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("pieces", pa.list_(_PIECE)), ("ids", pa.binary())])


def sequences(docs: DataFrame, ids: Column, source: Column, cluster: Column, capacity: int = CAPACITY, width: int = 1) -> DataFrame:
    """One row per filled bin: group, bin, size, doc_ids, pieces, ids.

    ``ids`` are the token ids of a document, ``width`` bytes each (null: none); a bin's ``ids`` are those of its
    pieces one after the other, at most ``capacity``. ``pieces`` say for each its doc_id, its number, where it
    starts in the document, its size, and where it lies in the bin: all in tokens. ``doc_ids`` are theirs. Bins
    are those of ``packed``; documents travel with their ids once, in groups of bounded size.
    """
    tokens = F.coalesce(ids, F.lit("").cast("binary")).alias("ids")
    items = docs.select(F.col("doc_id").cast("long"), source.cast("string").alias("source"), cluster.alias("cluster"), tokens)
    items = items.withColumn("size", F.floor(F.octet_length("ids") / F.lit(width)))

    def run(key, table):
        table = ordered(table)
        data = table["ids"].combine_chunks()
        bins: dict[int, list] = {}
        for doc_id, row, piece, start, size, number, position in pieces_of(table, capacity):
            bins.setdefault(number, []).append((position, doc_id, row, piece, start, size))
        rows = []
        for number, held in sorted(bins.items()):
            at, pieces, parts = 0, [], []
            for _, doc_id, row, piece, start, size in sorted(held, key=lambda p: p[0]):
                pieces.append({"doc_id": doc_id, "piece": piece, "start": start, "size": size, "at": at})
                parts.append(data[row].as_buffer()[start * width : (start + size) * width])
                at += size
            whole = b"".join(p.to_pybytes() for p in parts)
            rows.append({"group": key[0].as_py(), "bin": number, "size": at, "doc_ids": [p["doc_id"] for p in pieces], "pieces": pieces, "ids": whole})
        return pa.Table.from_pylist(rows, _SEQUENCES)

    piece = "array<struct<doc_id:long,piece:long,start:long,size:long,at:long>>"
    return dealt(items).groupBy("group").applyInArrow(run, f"group long, bin long, size long, doc_ids array<long>, pieces {piece}, ids binary")


def text_cluster(text: Column) -> Column:
    """Texts that are equal without white space and case are a cluster."""
    return F.xxhash64(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def packed_texts(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``packed`` for the UTF-8 bytes of ``text``; texts that are equal without white space and case are a cluster."""
    return packed(docs, F.octet_length("text"), F.col("source"), text_cluster(F.col("text")), capacity)


def byte_sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequences`` of the UTF-8 bytes of ``text``, one id for each byte."""
    return sequences(docs, whole_text(), F.col("source"), text_cluster(F.col("text")), capacity)


def token_sequences(docs: DataFrame, path: str, pattern: str, separator: int, capacity: int, width: int = 2) -> DataFrame:
    """``sequences`` of the byte-level BPE tokens of ``text``, each document followed by the separator."""
    source, cluster = F.col("source").cast("string").alias("source"), text_cluster(F.col("text")).alias("cluster")
    tokens = bpe.encoded(docs, path, pattern, [source, cluster], separator, width)
    return sequences(tokens, F.col("ids"), F.col("source"), F.col("cluster"), capacity, width)
