"""SimHash near-duplicates, found with a generalised pigeonhole principle."""

from __future__ import annotations

import itertools
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import connected_components, digest_of_text, few_rows, id_text, one_row_each, whole_text, written

BITS = 64
#: Costs that weigh a probing row against a comparison of two fingerprints, in seconds.
ROW_COST, PAIR_COST = 3e-6, 3e-9
#: Distinct fingerprints under one probing key beyond which the key is widened.
HOT = 1 << 16
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the shingles' hashes; 0 without words.

    A-Z are lowered, words are runs without ASCII white space, shingles count as often as they occur, and fewer
    words than ``shingle`` make one shingle of all.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())], np.uint64)
    # eight counters of eight bits in each word: 255 hashes fit before one overflows
    lanes = (hashes[:, None] >> _SHIFTS) & _LANES
    sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)
    counts = sums.view(np.uint8).reshape(-1, 8, 8).sum(0, dtype=np.int64)  # [shift, byte]
    bits = (2 * counts > len(hashes)).T.reshape(-1)  # bit 8 * byte + shift
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, digest: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text as a signed long; null is empty. If asked, a digest of the text too."""

    def run(batches):
        for batch in few_rows(batches):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            others = [batch.column("doc_id"), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*others, pa.array(found.view(np.int64))], ["doc_id", *batch.schema.names[2:], "fp"])

    also = [digest_of_text().alias("digest")] if digest else []
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), *also)
    return rows.mapInArrow(run, f"doc_id long, {'digest string, ' if digest else ''}fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how often each two bits are set together (64 x 64), over all of them."""

    def run(batches):
        n, together = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(values), 65536):
                bits = np.unpackbits(values[at : at + 65536], axis=1, bitorder="little").astype(np.float32)
                together += bits.T @ bits
            n += len(values)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([together.ravel().tolist()])], ["n", "together"])

    parts = distinct.select("fp").mapInArrow(run, "n long, together array<double>")
    cells = parts.select("n", F.posexplode("together").alias("cell", "v"))
    rows = cells.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    together = np.zeros(BITS * BITS)
    for row in rows:
        together[row["cell"]] = row["v"]
    return (int(rows[0]["n"]) if rows else 0), together.reshape(BITS, BITS)


def correlated_groups(n: int, together: np.ndarray, m: int) -> list[list[int]]:
    """The bits in m groups of equal size, each grown from its first bit by the strongest correlation."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    strength = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    rest, groups = list(range(BITS)), []
    for i in range(m):
        size = len(rest) // (m - i)
        group = [max(rest, key=lambda b: strength[b, rest].sum())]
        rest.remove(group[0])
        while len(group) < size:
            group.append(max(rest, key=lambda b: strength[b, group].sum()))
            rest.remove(group[-1])
        groups.append(group)
    return groups


def within(p: np.ndarray, t: int) -> float:
    """Chance that two fingerprints differ in at most t of the bits that are set with chances p."""
    chance = np.zeros(t + 1)
    chance[0] = 1.0
    for q in p**2 + (1 - p) ** 2:
        chance[1:] = chance[1:] * q + chance[:-1] * (1 - q)
        chance[0] *= q
    return float(chance.sum())


def allocate(n: int, together: np.ndarray, distance: int) -> tuple[float, list[tuple[list[int], int]]]:
    """The cheapest (estimated cost, [(bits, threshold)]).

    With thresholds t that satisfy sum(t + 1) = distance + 1 over the groups, two fingerprints within the distance
    are within t of each other in some group; -1 leaves a group out. A dynamic program over the groups finds the
    thresholds with the least estimated cost, for each number of groups.
    """
    n = max(n, 1)
    p = np.diag(together) / n
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for m in range(1, distance + 2):
        groups = correlated_groups(n, together, m)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for bits in groups:
            after: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in states.items():
                for t in range(-1, min(distance - spent, len(bits) - 1) + 1):
                    own = 0.0 if t < 0 else ROW_COST * n * math.comb(len(bits), t) + PAIR_COST * n * n / 2 * within(p[bits], t)
                    if spent + t + 1 not in after or cost + own < after[spent + t + 1][0]:
                        after[spent + t + 1] = (cost + own, [*chosen, t])
            states = after
        cost, chosen = states.get(distance + 1, (math.inf, []))
        best = min(best, (cost, list(zip(groups, chosen))), key=lambda x: x[0])
    return best


def probe_masks(allocation: list[tuple[list[int], int]]) -> list[int]:
    """For each group, masks that leave out each choice of as many bits as its threshold allows to differ."""
    masks = []
    for bits, t in allocation:
        if t >= 0:
            masks.extend(sum(1 << b for b in bits if b not in out) for out in itertools.combinations(bits, t))
    return masks


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def star_edges(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """(smallest of the component, member) for the components of distinct fingerprints, without listing pairs."""
    edges, rest = [], np.sort(values)
    while len(rest) > 1:
        root, front, rest = rest[0], [rest[0]], rest[1:]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                edges.extend((int(root), int(v)) for v in found)
    return edges


def linked(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints within the distance.

    All fingerprints that agree under a probing mask meet in one task, which verifies the distance and keeps one
    edge a member. No pairs leave the task, and it holds one key's fingerprints (8 bytes each) at a time. A key that
    more than ``HOT`` fingerprints share is probed again under wider masks: of distance + 1 classes of bits, two
    fingerprints within the distance agree on at least one. ``distinct`` is read several times.
    """
    n, together = bit_statistics(distinct)
    masks = probe_masks(allocate(n, together, distance)[1])
    probes = distinct.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask"))
    found, classes, step = [], max(2, distance + 1), 1
    while True:
        probes = probes.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp")
        if step >= BITS:  # all classes are in use
            break
        hot = written(probes.groupBy("mask", "value").count().where(F.col("count") > HOT).select("mask", "value"))
        if hot.isEmpty():
            break
        found.append(probes.join(hot, ["mask", "value"], "left_anti"))
        wider = [sum(1 << b for b in range(BITS) if b // step % classes == c) for c in range(classes)]
        widened = F.array(*(F.col("mask").bitwiseOR(F.lit(signed(w))) for w in wider))
        probes = probes.join(hot, ["mask", "value"], "left_semi").select("fp", F.explode(widened).alias("mask"))
        step *= classes
    probes = reduce(DataFrame.unionByName, found, probes)

    def run(batches):
        held = None
        for batch in batches:
            mask, value, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if held is not None:
                mask, value, fp = (np.concatenate(x) for x in zip(held, (mask, value, fp)))
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            last = cuts[-1] if len(cuts) else 0
            held = (mask[last:], value[last:], fp[last:])
            yield batch_of(fp, np.concatenate([[0], cuts]) if last else np.zeros(1, int))
        if held is not None:
            yield batch_of(held[2], np.array([0, len(held[2])]))

    def batch_of(fp, bounds):
        edges = []
        for i in np.flatnonzero(np.diff(bounds) > 1):
            edges.extend(star_edges(fp[bounds[i] : bounds[i + 1]], distance))
        a, b = zip(*edges) if edges else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return probes.repartition("mask", "value").sortWithinPartitions("mask", "value").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fp (signed long), component_id.

    Documents link when their fingerprints differ in at most ``distance`` bits; component_id is the smallest
    doc_id that links reach. Null and empty texts, and those of white space alone, have fingerprint 0. A null
    doc_id counts only where a component has no other id. Other columns of ``docs`` are not read.
    """
    fps = written(fingerprints(docs, shingle))
    rooted = rooted_fingerprints(fps, distance, F.min("doc_id").alias("first"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id")


def rooted_fingerprints(fps: DataFrame, distance: int, of_each) -> DataFrame:
    """(fp, first, root) for each distinct fingerprint: ``of_each`` over its rows, and what names its component."""
    distinct = written(fps.groupBy("fp").agg(of_each))
    roots = connected_components(linked(distinct.select("fp"), distance))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    return joined.select("fp", "first", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one with the smallest doc_id.

    Ids come before null; of several texts of that id the one with the least digest stays, of equal rows one. So
    rows without an id stay only where nothing in their component has one, one for each component.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    fps = written(fingerprints(docs, shingle, digest=True))
    rooted = rooted_fingerprints(fps, distance, F.min(order).alias("first"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    kept = least.select(id_text(F.col("first.doc_id")).alias("id"), F.col("first.digest").alias("digest"))
    return one_row_each(docs, kept, {"id": id_text(F.col("doc_id")), "digest": digest_of_text()})
