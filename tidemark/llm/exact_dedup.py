"""Exact duplicates: Patricia tries over whole byte strings, whose terminal nodes own the copies."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import digest_of_text, few_rows, id_text, one_row_each, whole_text

WHITE_SPACE = b" \t\n\x0b\x0c\r"


class Node:
    __slots__ = ("label", "children", "owner", "copies")

    def __init__(self, label: bytes, owner=None, copies: int = 0):
        self.label, self.children, self.owner, self.copies = label, {}, owner, copies


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Byte strings by compressed radix edges; a terminal node has its smallest owner and the number of copies."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner, copies: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], owner, copies)
                self.size += len(key) - at
                return
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            n = common_length(child.label, key[at:])
            fork = Node(child.label[:n])
            child.label = child.label[n:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            node, at = fork, at + n
        node.owner = owner if node.owner is None else min(node.owner, owner)
        node.copies += copies

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """Remove the largest subtree below the root and give its strings, owners and copies."""
        first = max(self.root.children, key=lambda c: weight(self.root.children[c]))
        node = self.root.children.pop(first)
        self.size -= weight(node)
        yield from terminals(node)

    def drain(self) -> Iterator[tuple[bytes, tuple, int]]:
        yield from terminals(self.root)
        self.__init__()


def weight(top: Node) -> int:
    total, rest = 0, [top]
    while rest:
        node = rest.pop()
        total += len(node.label)
        rest.extend(node.children.values())
    return total


def terminals(top: Node) -> Iterator[tuple[bytes, tuple, int]]:
    rest = [(b"", top)]
    while rest:
        prefix, node = rest.pop()
        key = prefix + node.label
        if node.copies:
            yield key, node.owner, node.copies
        rest.extend((key, child) for child in node.children.values())


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE_SPACE)


def trie_key(text: bytes) -> bytes:
    """Content hash and length, which choose the part of the trie, and the whole string."""
    return xxhash.xxh64_digest(text) + len(text).to_bytes(8, "big") + text


def owner_of(n_chars: int, doc_id: int | None, digest: bytes) -> tuple:
    """Smallest first: most code points, then smallest id, ids before null; the text's digest tells rows of one id apart."""
    return (-n_chars, doc_id is None, doc_id or 0, digest)


OWNED = pa.schema([("part", pa.binary()), ("norm", pa.binary()), ("n_chars", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("copies", pa.int64())])
CLASSES = pa.schema([("sha", pa.binary()), ("keep_id", pa.int64()), ("keep_digest", pa.binary()), ("group_size", pa.int64())])


def _owned(rows) -> pa.RecordBatch:
    rows = [(k[:16], k[16:], -o[0], None if o[1] else o[2], o[3], n) for k, o, n in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 6, OWNED)], schema=OWNED)


def _chunks(rows, most: int = 8 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def duplicate_classes(docs: DataFrame, trie_bytes: int = 32 << 20) -> DataFrame:
    """(sha, keep_id, keep_digest, group_size) for each distinct normalised text of (doc_id, text).

    ``keep_digest`` is the SHA-256 of the text that stays, as it came.
    Each input task inserts its texts into a trie of at most ``trie_bytes`` of edges (one more text may exceed
    it); beyond, the largest subtree goes on to the shuffle. So a text with any number of copies is sent about
    once a task. The shuffle is by length and content hash; the receiving task merges one such pair after the
    other in a trie, so it holds texts of one hash only.
    """

    def pre_aggregate(batches):
        trie = PatriciaTrie()
        for batch in few_rows(batches):
            for doc_id, text, n_chars in zip(*(c.to_pylist() for c in batch.columns)):
                trie.insert(trie_key(normalised(text)), owner_of(n_chars, doc_id, hashlib.sha256(text).digest()))
                while trie.size > trie_bytes:
                    for rows in _chunks(trie.spill()):
                        yield _owned(rows)
        for rows in _chunks(trie.drain()):
            yield _owned(rows)

    def merge(batches):
        trie, part, done = PatriciaTrie(), None, []
        for batch in few_rows(batches):
            for key, norm, n_chars, doc_id, digest, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if key != part:
                    done.extend(_classes(trie))
                    part = key
                trie.insert(norm, owner_of(n_chars, doc_id, digest), copies)
            yield _class_batch(done)
            done = []
        yield _class_batch([*_classes(trie)])

    texts = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))
    owned = texts.mapInArrow(pre_aggregate, "part binary, norm binary, n_chars long, doc_id long, digest binary, copies long")
    merged = owned.repartition("part").sortWithinPartitions("part")
    return merged.mapInArrow(merge, "sha binary, keep_id long, keep_digest binary, group_size long")


def _classes(trie: PatriciaTrie):
    for norm, owner, copies in trie.drain():
        yield hashlib.sha256(norm).digest(), None if owner[1] else owner[2], owner[3], copies


def _class_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, CLASSES)], schema=CLASSES)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, sha (of the normalised text), keep_id, group_size, kept.

    Texts are equal when they are identical without ASCII white space; null counts as empty. The row with the
    most code points in its original text stays, then the one with the smallest doc_id; a null id comes last.
    Rows that repeat the doc_id that stays are that document and are all marked as kept. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """

    def digests(batches):
        for batch in few_rows(batches):
            ids, texts = batch.columns
            shas = [hashlib.sha256(normalised(t)).digest() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(shas, pa.binary())], ["doc_id", "sha"])

    members = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    members = members.mapInArrow(digests, "doc_id long, sha binary")
    return members.join(duplicate_classes(docs), "sha").select(
        "doc_id", "sha", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each normalised text, with all its columns: the one that ``exact_duplicates`` keeps.

    That is decided for each row by its text and its doc_id, so rows without an id, and other texts of a repeated id,
    stay or go like all others. Of rows that agree in both, one stays. Columns of any name pass.
    """
    kept = duplicate_classes(docs).select(F.lower(F.hex("keep_digest")).alias("digest"), id_text(F.col("keep_id")).alias("id"))
    return one_row_each(docs, kept, {"digest": digest_of_text(), "id": id_text(F.col("doc_id"))})
