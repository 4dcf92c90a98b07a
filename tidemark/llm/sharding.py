"""Sharding by a hash tree of regions, racks and shards, descended with weighted draws."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Documents of a shard that are numbered in one task, on average.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class Part:
    """A subtree, or what was added to one later; a shard has a number and no parts."""

    name: str
    weight: float
    parts: tuple[Part, ...] = ()
    shard: int | None = None


def built(regions: int, racks: int, shards: int, weight: float = 1.0) -> Part:
    """A tree of equal shards, numbered from 0."""

    def level(name: str, sizes: tuple[int, ...], first: int) -> Part:
        if not sizes:
            return Part(name, weight, shard=first)
        each = math.prod(sizes[1:])
        parts = tuple(level(f"{name}/{i}", sizes[1:], first + i * each) for i in range(sizes[0]))
        return Part(name, sum(p.weight for p in parts), parts)

    return level("", (regions, racks, shards), 0)


def grown(tree: Part, region: int, rack: int, shard: int, weight: float = 1.0) -> Part:
    """The tree with one more shard in a rack.

    The weight that its region and rack gain is a part of its own beside the old ones: the old draws stay as they
    were, and a key that the new part wins goes to the new shard. So nothing else moves.
    """
    new = Part(f"/{region}/{rack}+{shard}", weight, shard=shard)
    for name in (f"/{region}/{rack}+{shard}:rack", f"/{region}+{shard}:region"):
        new = Part(name, weight, (new,))
    return replace(tree, weight=tree.weight + weight, parts=(*tree.parts, new))


def shard_of(tree: Part, key: Column) -> Column:
    """The shard of the key: a draw among the regions, then among the winner's racks, then among its shards.

    A part's draw is exponential with its weight as the rate, from a hash of its name and the key; the least wins.
    """
    parts: list[Column] = []
    shards: list[Column] = []
    rest, depth = [tree], 0
    while rest[0].parts:
        for part in rest:
            inner = F.array(*(F.struct(F.lit(p.name).alias("name"), F.lit(float(p.weight)).alias("weight")) for p in part.parts))
            parts += [F.lit(part.name), inner]
        rest, depth = [p for part in rest for p in part.parts], depth + 1
    for part in rest:
        shards += [F.lit(part.name), F.lit(part.shard)]
    inner, numbers = F.create_map(*parts), F.create_map(*shards)

    def drawn(part: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(part["name"], key), 11)
        return F.struct((-F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / part["weight"]).alias("draw"), part["name"].alias("name"))

    winner = F.lit(tree.name)
    for _ in range(depth):
        winner = F.array_min(F.transform(F.element_at(inner, winner), drawn))["name"]
    return F.element_at(numbers, winner)


def sharded(docs: DataFrame, tree: Part, later: Part | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot, grown_shard.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 16, ``grown_shard`` the shard in ``later`` (null
    without it). The doc_id and the tree decide the shard; without a doc_id, the text does. ``slot`` numbers
    the documents of a shard from 0 without gaps, by a hash of the doc_id: each of several hash ranges numbers its own, and
    starts after the sum of those before, so that no task sees a whole shard. Rows that repeat a doc_id share
    its shard and have slots of their own; where very many do, they are numbered in parts as well. An empty table
    gives an empty result; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("doc_id"))
    rows = docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), key.alias("_draw"),
    )
    after = shard_of(later, F.col("_draw")) if later else F.lit(None).cast("int")
    rows = rows.withColumns({"shard": shard_of(tree, F.col("_draw")), "grown_shard": after})
    # written without the texts, which are read once; the numbers of the rows are fixed by that
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()))
    shards = sum(1 for _ in _leaves(tree))
    ranges = max(1, math.ceil(rows.count() / (shards * SLOT_ROWS)))
    repeated = rows.groupBy("_draw").agg(F.ceil(F.count("*") / SLOT_ROWS).alias("_pieces")).where("_pieces > 1")
    rows = rows.join(repeated, "_draw", "left")
    part = {"_range": F.pmod(F.xxhash64(F.lit("slot"), "_draw"), F.lit(ranges)), "_piece": F.coalesce(F.pmod(F.xxhash64("_row"), "_pieces"), F.lit(0))}
    rows, keys = rows.withColumns(part), ["shard", "_range", "_piece"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("_range", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy(*keys).orderBy("_draw", "doc_id", "size", "text_crc32", "_row")
    numbered = rows.withColumn("nth", F.row_number().over(order))
    slot = (F.col("first") + F.col("nth") - 1).cast("long").alias("slot")
    return numbered.join(counts, keys).select("doc_id", "size", "text_crc32", "shard", slot, "grown_shard")


def _leaves(part: Part):
    if part.shard is not None:
        yield part
    for child in part.parts:
        yield from _leaves(child)
