"""Repeated passages, removed byte for byte with the triggers of prefix-free parsing.

This is not the whole of prefix-free parsing: no suffix array, of the dictionary or of the parse, is built, and there is
no parse sequence. Phrases are not the stretches between triggers but the 34 bytes on either side of one, and sorts of
both sides, bounded to that depth, take the place of the suffix arrays. A passage is removed for equal strings of 50
bytes, for which no deeper order is needed; a suffix array of the parse would order the whole corpus in one piece,
while bounded sorts are independent for each trigger. Results are exact.

Rolling-hash triggers mark each text. A trigger is the least hash of 16 bytes among the starts in
some window of 50 bytes, so every such window has one, and equal windows have it at the same place. The corpus is
worked on in *chunks* (runs of documents) and *buckets* (ranges of trigger hashes), which write to each other:

1. chunk to bucket: the distinct triggers, and about how many phrases each has. Bucket to chunk: a bit for each,
   whether another document has it too, and another, whether it is *hot*: too many phrases for one task.
2. chunk to bucket: the distinct phrases around shared triggers. The bucket sorts the dictionary of phrases, on the
   right of the trigger as suffixes and on the left reversed; each phrase pairs the two ranks. Runs of phrases that
   share enough bytes, by their LCP, give for each window the class of equal strings in corpus order, without any
   hash. Bucket to chunk: for each phrase, which windows also start in a document with a smaller id.
   Phrases around hot triggers are not sent; their distinct windows are, byte for byte, each with the smallest id in
   the chunk, to the bucket of the window's hash. Bucket to chunk: a bit for each window.
3. Each chunk marks the windows in its documents.

A chunk sends a trigger, phrase or window once, however many of its documents have it. A passage that a third of all
documents share costs each chunk one entry for a trigger well inside of it. Near its edges each document has a phrase of
its own; there the trigger becomes hot, and the unit of work is a class of equal windows, with one entry a chunk.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quoted
from tidemark.llm.common import few_rows, whole_text, written
from tidemark.workspace import new_database

TRIGGER = 16
#: Bytes of a text whose hashes are held at a time.
STRETCH = 1 << 20
#: Phrases around one trigger (86 bytes and an id each) that one task sorts.
HOT = 1 << 18
#: Files by chunk that the documents are written to at most; a file has any number of chunks.
MAX_FILES = 1 << 14
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_NO_ID = np.iinfo(np.int64).max


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def slide(values: np.ndarray, k: int, fold) -> np.ndarray:
    """``fold`` over each k neighbours."""
    span = 1
    while span * 2 <= k:
        values = fold(values[:-span], values[span:])
        span *= 2
    return fold(values[: len(values) - (k - span)], values[k - span :]) if span < k else values


def triggers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the triggers in a text of bytes; none in a text shorter than ``length``.

    A position depends on the windows around it only, so a long text is searched in stretches.
    """
    at, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for start in range(0, len(data) if len(data) >= length else 0, STRETCH):
        low = max(0, start - length)
        found, hashes = _triggers(data[low : start + STRETCH + length], length)
        own = (found + low >= start) & (found + low < start + STRETCH)
        at.append(found[own] + low)
        keys.append(hashes[own])
    return np.concatenate(at), np.concatenate(keys)


def _triggers(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, span = data.astype(np.uint64) + np.uint64(1), 1
    while span < TRIGGER:
        hashes = hashes[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + hashes[span:]
        span *= 2
    hashes = _mixed(hashes)
    k = length - TRIGGER + 1
    least = slide(hashes, k, np.minimum)
    padded = np.zeros(len(least) + 2 * (k - 1), np.uint64)
    padded[k - 1 : k - 1 + len(least)] = least
    at = np.flatnonzero(hashes == slide(padded, k, np.maximum))
    return at, _mixed(hashes[at] + np.uint64(1))


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes, to deal and to count them; equality is always judged on the bytes."""
    words = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    words[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for word in words.view(np.uint64).T:
        out = _mixed((out + np.uint64(1)) * np.uint64(_BASE) ^ word)
    return out


def _documents(of: np.ndarray):
    """(document, start, end) of the triggers of each document that has some."""
    cuts = np.flatnonzero(np.diff(of, prepend=-1, append=-2))
    for start, end in zip(cuts[:-1], cuts[1:]):
        yield int(of[start]), int(start), int(end)


class Chunk:
    """The triggers of some documents, and the distinct ones in the order in which they are sent."""

    def __init__(self, ids, texts, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.reach = length - TRIGGER
        self.ids = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.data = [np.frombuffer(t, np.uint8) for t in texts]
        found = [triggers(d, length) for d in self.data]
        self.at = np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)])
        self.of = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        keys = np.concatenate([np.zeros(0, np.uint64), *(f[1] for f in found)])
        self.keys, self.key_of = np.unique(keys, return_inverse=True)

    def bucket_bounds(self, keys: np.ndarray) -> np.ndarray:
        """Where each bucket's part of sorted keys ends."""
        bucket = ((keys >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        return np.searchsorted(bucket, np.arange(self.buckets + 1, dtype=np.uint64))

    def trigger_messages(self):
        """(bucket, five bytes of each key, a byte each: whether two documents here have it, and log2 of its phrases)."""
        low = np.full(len(self.keys), _NO_ID)
        high = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.key_of, self.ids[self.of])
        np.maximum.at(high, self.key_of, self.ids[self.of])
        raw = self.keys.view(np.uint8).reshape(-1, 8)[:, :5]
        sizes = np.ceil(np.log2(np.maximum(1, self.count_phrases()))).astype(np.uint8)
        told = (low < high) | sizes << np.uint8(1)
        for bucket, a, b in self.parts(self.keys):
            yield bucket, raw[a:b].tobytes(), told[a:b].tobytes()

    def count_phrases(self) -> np.ndarray:
        """How many distinct phrases each trigger has here."""
        count = np.bincount(self.key_of, minlength=len(self.keys))
        several = np.flatnonzero(count[self.key_of] > 1)
        hashes = row_hashes(self.around(self.at[several], self.of[several]))
        _, first = np.unique(_mixed(hashes ^ self.keys[self.key_of[several]]), return_index=True)
        return np.where(count > 1, np.bincount(self.key_of[several[first]], minlength=len(self.keys)), count)

    def parts(self, keys):
        bounds = self.bucket_bounds(keys)
        for bucket in np.flatnonzero(np.diff(bounds)):
            yield int(bucket), int(bounds[bucket]), int(bounds[bucket + 1])

    def keep_shared(self, answers: dict[int, bytes]) -> None:
        """Take the buckets' bits; then find the distinct phrases around the shared triggers."""
        shared, hot = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        for bucket, a, b in self.parts(self.keys):
            bits = np.frombuffer(answers[bucket], np.uint8)
            shared[a:b] = np.unpackbits(bits, count=b - a)
            if len(bits) > (b - a + 7) // 8:
                hot[a:b] = np.unpackbits(bits[(b - a + 7) // 8 :], count=b - a)
        here = np.flatnonzero(shared[self.key_of])
        self.at, self.of, key_of = self.at[here], self.of[here], self.key_of[here]
        rows = self.around(self.at, self.of)
        order, first, self.phrase_of = distinct_rows(rows, self.keys[key_of])
        self.phrases = rows[first]
        self.least = np.full(len(first), _NO_ID)
        np.minimum.at(self.least, self.phrase_of, self.ids[self.of])
        hot = hot[key_of][first]
        self.cold, self.hot = np.flatnonzero(~hot), np.flatnonzero(hot)
        self.cold_keys = self.keys[key_of][first][self.cold]
        self.find_windows()

    def around(self, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The phrase around each trigger, and the first and last offset of a window in it that the text has."""
        width = 2 * self.reach + TRIGGER
        rows = np.zeros((len(at), width + 2), np.uint8)
        for doc, start, end in _documents(of):
            data, here = self.data[doc], at[start:end]
            padded = np.zeros(len(data) + 2 * self.reach, np.uint8)
            padded[self.reach : self.reach + len(data)] = data
            rows[start:end, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[here]
            rows[start:end, width] = np.maximum(0, self.reach - here)
            rows[start:end, width + 1] = np.minimum(self.reach, len(data) - self.length - here + self.reach)
        return rows

    def find_windows(self) -> None:
        """The distinct windows of the phrases around hot triggers: their bytes, hashes and least ids.

        ``placed`` has, for each offset, the phrases that have a window there, and the window's number.
        """
        width = self.phrases.shape[1] - 2
        windows, hashes, least, placed = [], [], [], []
        for offset in range(self.reach + 1 if len(self.hot) else 0):
            low, high = self.phrases[self.hot, width], self.phrases[self.hot, width + 1]
            phrase = self.hot[(low <= offset) & (offset <= high)]
            found = self.phrases[phrase, offset : offset + self.length]
            keys = row_hashes(found)
            _, first, which = distinct_rows(found, keys)
            owner = np.full(len(first), _NO_ID)
            np.minimum.at(owner, which, self.least[phrase])
            placed.append((offset, phrase, which + sum(map(len, windows))))
            windows.append(found[first])
            hashes.append(keys[first])
            least.append(owner)
        rows = np.concatenate([np.zeros((0, self.length), np.uint8), *windows])
        keys = np.concatenate([np.zeros(0, np.uint64), *hashes])
        _, first, which = distinct_rows(rows, keys)
        self.windows, self.window_keys = rows[first], keys[first]
        self.window_least = np.full(len(first), _NO_ID)
        np.minimum.at(self.window_least, which, np.concatenate([np.zeros(0, np.int64), *least]))
        self.placed = [(offset, phrase, which[n]) for offset, phrase, n in placed]

    def phrase_messages(self):
        """(bucket, phrases or windows, least id of each); the buckets of windows come after those of phrases."""
        phrases, least = self.phrases[self.cold], self.least[self.cold]
        for bucket, a, b in self.parts(self.cold_keys):
            yield bucket, phrases[a:b].tobytes(), least[a:b].tobytes()
        for bucket, a, b in self.parts(self.window_keys):
            yield self.buckets + bucket, self.windows[a:b].tobytes(), self.window_least[a:b].tobytes()

    def masks(self, answers: dict[int, bytes]) -> np.ndarray:
        """For each phrase a mask of the windows that also start in a document with an id below its least."""
        masks = np.zeros(len(self.phrases), np.uint64)
        for bucket, a, b in self.parts(self.cold_keys):
            masks[self.cold[a:b]] = np.frombuffer(answers[bucket], np.uint64)
        earlier = np.zeros(len(self.windows), bool)
        for bucket, a, b in self.parts(self.window_keys):
            earlier[a:b] = np.unpackbits(np.frombuffer(answers[self.buckets + bucket], np.uint8), count=b - a)
        for offset, phrase, window in self.placed:
            found = earlier[window] | (self.window_least[window] < self.least[phrase])
            masks[phrase[found]] |= np.uint64(1 << offset)
        return masks

    def removed(self, answers: dict[int, bytes]) -> list[list[tuple[int, int]]]:
        """The spans to remove from each document."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.data]
        if not len(self.at):
            return spans
        masks = self.masks(answers)
        width = self.phrases.shape[1] - 2
        offsets = np.arange(self.reach + 1, dtype=np.uint64)
        for doc, start, end in _documents(self.of):
            phrase = self.phrase_of[start:end]
            windows = ((masks[phrase][:, None] >> offsets) & np.uint64(1)).astype(bool)
            later = self.ids[doc] > self.least[phrase]
            low, high = self.phrases[phrase, width], self.phrases[phrase, width + 1]
            windows |= later[:, None] & (offsets >= low[:, None]) & (offsets <= high[:, None])
            row, offset = np.nonzero(windows)
            if not len(row):
                continue
            starts = np.unique(self.at[start:end][row] - self.reach + offset)
            gaps = np.flatnonzero(np.diff(starts) > self.length)
            begins = starts[np.concatenate([[0], gaps + 1])]
            ends = starts[np.concatenate([gaps, [len(starts) - 1]])] + self.length
            spans[doc] = list(zip(begins.tolist(), ends.tolist()))
        return spans


def distinct_rows(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, which): rows sorted by key and bytes, the first of each distinct row, and each row's number."""
    width = rows.shape[1]
    packed = np.zeros((len(rows), 8 + width), np.uint8)
    packed[:, :8] = keys.astype(">u8").view(np.uint8).reshape(-1, 8)
    packed[:, 8:] = rows
    flat = packed.view(f"V{8 + width}").reshape(-1)
    order = np.argsort(flat, kind="stable")
    new = np.ones(len(rows), bool)
    new[1:] = (packed[order[1:]] != packed[order[:-1]]).any(1) if len(rows) else True
    which = np.empty(len(rows), np.int64)
    which[order] = np.cumsum(new) - 1
    return order, order[new], which


def sorted_phrases(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each row among the distinct rows in byte order, LCP of each distinct row with the one before)."""
    flat = np.ascontiguousarray(phrases).view(f"V{phrases.shape[1]}").reshape(-1)
    order = np.argsort(flat, kind="stable")
    ordered = phrases[order]
    differs = ordered[1:] != ordered[:-1]
    new = differs.any(1)
    rank = np.empty(len(phrases), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(new)])
    return rank, np.concatenate([[0], differs[new].argmax(1)])


def earlier_windows(phrases: np.ndarray, owners: np.ndarray, reach: int) -> np.ndarray:
    """For each phrase a mask of the windows that also start in a document with an id below its owner's."""
    masks = np.zeros(len(phrases), np.uint64)
    width = phrases.shape[1] - 2
    right, right_lcp = sorted_phrases(phrases[:, reach:width])
    left, left_lcp = sorted_phrases(phrases[:, reach + TRIGGER - 1 :: -1])
    for offset in range(reach + 1):
        valid = np.flatnonzero((phrases[:, width] <= offset) & (offset <= phrases[:, width + 1]))
        if not len(valid):
            continue
        right_class = np.cumsum(right_lcp < TRIGGER + offset)[right[valid]]
        left_class = np.cumsum(left_lcp < TRIGGER + reach - offset)[left[valid]]
        key = left_class * (len(phrases) + 1) + right_class
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[True], np.diff(key[order]) != 0])
        least = np.minimum.reduceat(owners[valid][order], np.flatnonzero(new))[np.cumsum(new) - 1]
        masks[valid[order][least < owners[valid][order]]] |= np.uint64(1 << offset)
    return masks


def earlier_equals(windows: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Whether an equal window has a smaller owner, for each window."""
    _, first, which = distinct_rows(windows, np.zeros(len(windows), np.uint64))
    least = np.full(len(first), _NO_ID)
    np.minimum.at(least, which, owners)
    return least[which] < owners


_SENT = "bucket int, chunk long, items binary, extra binary"
_ANSWER = "chunk long, bucket int, step int, answer binary"


def _sent(rows, chunk: int) -> pa.Table:
    bucket, items, extra = zip(*rows) if rows else ([], [], [])
    return pa.table({"bucket": pa.array(bucket, pa.int32()), "chunk": pa.array([chunk] * len(bucket), pa.int64()), "items": pa.array(items, pa.binary()), "extra": pa.array(extra, pa.binary())})


def _answered(table: pa.Table, step: int, answers: list[bytes]) -> pa.Table:
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "step": pa.array([step] * len(answers), pa.int32()), "answer": pa.array(answers, pa.binary())})


def _answers(table: pa.Table, step: int) -> dict[int, bytes]:
    rows = zip(table["bucket"].to_pylist(), table["step"].to_pylist(), table["answer"].to_pylist())
    return {bucket: answer for bucket, at, answer in rows if at == step}


def shared_bits(table: pa.Table, hot_phrases: int) -> list[bytes]:
    """For the triggers in each row, a bit: another row has it, or two documents of its chunk do.

    Where some are hot, another bit for each follows: about more than ``hot_phrases`` phrases of all chunks have it.
    """
    items, extra = table["items"].to_pylist(), table["extra"].to_pylist()
    sizes = [len(x) for x in extra]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :5] = np.frombuffer(b"".join(items), np.uint8).reshape(-1, 5)
    _, which, count = np.unique(raw.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    told = np.frombuffer(b"".join(extra), np.uint8)
    shared = (count[which] > 1) | (told & 1 > 0)
    hot = shared & (np.bincount(which, np.exp2((told >> 1).astype(float))) > hot_phrases)[which]
    cuts = np.cumsum(sizes)[:-1]
    parts = zip(np.split(shared, cuts), np.split(hot, cuts))
    return [np.packbits(a).tobytes() + (np.packbits(b).tobytes() if b.any() else b"") for a, b in parts]


def chunked(batches, chunk_rows: int, chunk_bytes: int):
    """The rows with the number of their chunk, a run of a task's rows; a row that exceeds a bound opens the next."""
    first = TaskContext.get().partitionId() << 32
    number, rows, size = 0, 0, 0
    for batch in few_rows(batches):
        chunks = []
        for n in pc.binary_length(batch.column("text")).to_pylist():
            if rows and (rows == chunk_rows or size + n > chunk_bytes):
                number, rows, size = number + 1, 0, 0
            rows, size = rows + 1, size + n
            chunks.append(first + number)
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), *batch.columns], ["chunk", *batch.schema.names])


def repeated_passages(
    docs: DataFrame, length: int = 50, chunk_rows: int = 1024, chunk_bytes: int = 4 << 20, hot_phrases: int = HOT, as_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (array of start and end), kept (binary), rest (struct).

    ``spans`` are the maximal runs of bytes covered by strings of ``length`` bytes (17 to 79) that also start in a
    document with a smaller doc_id, all judged on the input; matches never cross documents. ``kept`` is the rest of
    the text, ``rest`` has all columns but the text. A null text is empty. A null doc_id counts as larger than any
    other; rows with the same doc_id do not remove each other's text. The documents are written once, bucketed by
    chunk, so that no later step shuffles a text. ``chunk_rows`` and ``chunk_bytes`` bound a chunk, which one task
    holds; a longer text is a chunk of its own. Triggers with more than about ``hot_phrases`` phrases are compared
    window by window. With ``as_text``, ``kept`` is text, without the bytes of characters that are cut in two.
    """
    if not TRIGGER < length < TRIGGER + 64:
        raise ValueError(f"length must be {TRIGGER + 1} to {TRIGGER + 63}")
    spark = docs.sparkSession
    reach = length - TRIGGER
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(1, math.ceil(n / chunk_rows), math.ceil(size / chunk_bytes))
    rest = F.struct(*(F.col(quoted(c)) for c in docs.columns if c != "text"))
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), rest.alias("rest"))
    kinds = T.StructType([T.StructField("chunk", T.LongType()), *rows.schema])
    rows = rows.mapInArrow(lambda batches: chunked(batches, chunk_rows, chunk_bytes), kinds)
    table = f"{quoted(new_database(spark, 'passages'))}.{quoted('t' + uuid.uuid4().hex)}"
    rows.write.format("parquet").bucketBy(min(buckets, MAX_FILES), "chunk").sortBy("chunk").saveAsTable(table)
    stored = spark.table(table)

    def opened(table: pa.Table) -> Chunk:
        return Chunk(table["doc_id"].to_pylist(), table["text"].to_pylist(), length, buckets)

    def send_triggers(key, table):
        return _sent([*opened(table).trigger_messages()], key[0].as_py())

    def find_shared(key, table):
        return _answered(table, 1, shared_bits(table, hot_phrases))

    def send_phrases(key, table, answers):
        if not len(table) or not len(answers):
            return _sent([], 0)
        here = opened(table)
        here.keep_shared(_answers(answers, 1))
        return _sent([*here.phrase_messages()], key[0].as_py())

    def find_earlier(key, table):
        items, extra = table["items"].to_pylist(), table["extra"].to_pylist()
        data, owners = np.frombuffer(b"".join(items), np.uint8), np.frombuffer(b"".join(extra), np.int64)
        cuts = np.cumsum([len(x) // 8 for x in extra])[:-1]
        if key[0].as_py() >= buckets:
            found = earlier_equals(data.reshape(-1, length), owners)
            return _answered(table, 2, [np.packbits(part).tobytes() for part in np.split(found, cuts)])
        masks = earlier_windows(data.reshape(-1, 2 * reach + TRIGGER + 2), owners, reach)
        return _answered(table, 2, [part.tobytes() for part in np.split(masks, cuts)])

    def remove(key, table, answers):
        texts = table["text"].to_pylist()
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        if len(answers):
            here = opened(table)
            here.keep_shared(_answers(answers, 1))
            spans = here.removed(_answers(answers, 2))
        kept = [without(text, found) for text, found in zip(texts, spans)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        found = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind)
        sizes = pa.array([len(t) for t in texts], pa.int64())
        kept = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        return pa.table({"doc_id": table["doc_id"], "n_bytes": sizes, "spans": found, "kept": kept, "rest": table["rest"]})

    ids = stored.select("chunk", "doc_id", "text")
    first = ids.groupBy("chunk").applyInArrow(send_triggers, _SENT)
    first = written(first.groupBy("bucket").applyInArrow(find_shared, _ANSWER))
    second = ids.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(send_phrases, _SENT)
    second = written(second.groupBy("bucket").applyInArrow(find_earlier, _ANSWER))
    answers = first.unionByName(second)
    rest_type = stored.schema["rest"].dataType.simpleString()
    kept_type = "string" if as_text else "binary"
    out = f"doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept {kept_type}, rest {rest_type}"
    return stored.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, out)


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside of the spans."""
    if not spans:
        return text
    ends = [0, *(b for _, b in spans)]
    starts = [*(a for a, _ in spans), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends, starts))


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """All rows and columns of ``docs``, the text without passages of earlier documents.

    Bytes of a character that is cut in two are left out, so that the text stays UTF-8. A null text becomes empty.
    """
    found = repeated_passages(docs, length, as_text=True)
    text = F.col("kept").alias("text")
    return found.select(*(text if c == "text" else F.col(f"rest.{quoted(c)}").alias(c) for c in docs.columns))
