"""Hard negatives by bounded inner products: length buckets with sorted coordinate lists that anchors probe.

Rows are dealt to length buckets, and large buckets to blocks; groups of anchors meet each block whose lengths can
reach what they look for. In a block, an anchor's largest coordinates (its focus) bound where a row of a given
product must lie in the sorted lists of these coordinates; rows in all of these ranges are verified by their exact
integer product. Bounds only ever leave out rows that cannot count, so results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Rows of a block and anchors of a group: what a task holds at most of either.
BLOCK, GROUP = 16_384, 16_384
#: Rows of a block that share a length bound, coordinates that an anchor looks at, anchors multiplied at once.
BUCKET, FOCUS, STRIPE = 2048, 3, 256
#: Squared lengths are told apart by so many steps for each doubling.
STEPS = 4
#: Lengths up to here have products that double precision holds exactly.
MAX_SQUARE = float(1 << 53)
_SLACK = 1e-9


def prepared(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(at, vec_id, label, x, square) of the rows that take part, written; ``at`` numbers them.

    Left out are rows with a null label or vector, or with a null or non-finite component. Components become
    floor(scale * component). A vector too long for exact products stops the query.
    """
    vector = F.col("embedding")
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    taken = rows.where(F.col("label").isNotNull() & vector.isNotNull() & finite)
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    square = F.aggregate("scaled", F.lit(0.0), lambda sum, c: sum + c.cast("double") * c.cast("double"))
    taken = taken.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), scaled.alias("scaled"))
    taken = taken.select("vec_id", "label", "scaled", square.alias("square"))
    fits = F.when(F.col("square") < MAX_SQUARE, F.col("scaled")).otherwise(
        F.raise_error(F.lit(f"a vector's squared length is {MAX_SQUARE:.0f} or more")).cast("array<long>")
    )
    x = F.transform(fits, lambda c: c.cast("int")).alias("x")
    # numbers are fixed by being written: from here on a lost task finds the same ones
    return written(taken.select(F.monotonically_increasing_id().alias("at"), "vec_id", "label", x, "square"))


def length_bucket(square: Column) -> Column:
    """The number of a row's length bucket, larger for longer rows; a vector of zeros is in bucket 0."""
    return F.when(square >= 1, 1 + F.floor(F.log2(square) * STEPS)).otherwise(0).cast("int")


@dataclass(frozen=True)
class Blocks:
    """Length buckets from the longest on: number, longest square, first block and count of blocks of each."""

    buckets: tuple[tuple[int, float, int, int], ...]

    @property
    def count(self) -> int:
        return self.buckets[-1][2] + self.buckets[-1][3] if self.buckets else 0

    def of_rows(self) -> Column:
        """The block of a row: any of its bucket's, by the row's number."""
        first, counts = F.lit(None).cast("long"), F.lit(None).cast("long")
        for number, _, start, n in self.buckets:
            here = F.col("bucket") == number
            first, counts = F.when(here, start).otherwise(first), F.when(here, n).otherwise(counts)
        return first + F.pmod(F.xxhash64("at"), counts)

    def reached(self, square: Column, least: Column) -> Column:
        """How many blocks, from the first on, may have a product of ``least`` or more with a row of this length."""
        reached = F.lit(0)
        for _, longest, start, n in self.buckets:
            may = (least <= 0) | (least * least <= square * longest * (1 + _SLACK))
            reached = F.when(may, start + n).otherwise(reached)
        return reached


def blocks_of(rows: DataFrame, block: int) -> Blocks:
    """The blocks of the rows, of ``block`` rows on average at most; there are a few hundred buckets at most."""
    found = rows.groupBy(length_bucket(F.col("square")).alias("bucket")).agg(F.max("square").alias("longest"), F.count("*").alias("n"))
    buckets, start = [], 0
    for row in sorted(found.collect(), key=lambda row: -row.bucket):
        n = -(-row.n // block)
        buckets.append((row.bucket, row.longest, start, n))
        start += n
    return Blocks(tuple(buckets))


# -- one block and one group of anchors ----------------------------------------------------------------


def matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    """The vectors of a column as rows of doubles; shorter ones end in zeros."""
    flat = column.combine_chunks()
    lengths = np.diff(np.asarray(flat.offsets))
    out = np.zeros((len(flat), d))
    out[np.arange(d) < lengths[:, None]] = np.asarray(flat.flatten())
    return out


def dimensions(*columns: pa.ChunkedArray) -> int:
    return max((int(np.diff(np.asarray(c.combine_chunks().offsets)).max(initial=0)) for c in columns), default=0)


@dataclass
class Bucket:
    """Rows of a block that share a length bound, and the sorted lists of the coordinates asked for."""

    rows: np.ndarray  # places in the block
    vectors: np.ndarray
    lengths: np.ndarray
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def sorted_list(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, rows) of the rows' coordinate i, as parts of their lengths, in order of value."""
        if i not in self.lists:
            values = self.vectors[:, i] / np.maximum(self.lengths, 1)
            order = np.argsort(values, kind="stable")
            self.lists[i] = (values[order], order)
        return self.lists[i]


def feasible(coordinate: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of a unit row's coordinate that leaves a product of ``cosine`` with a unit anchor possible.

    With coordinates cos(a) of the anchor and cos(b) of the row, the product is at most cos(a - b).
    """
    anchor, apart = np.arccos(np.clip(coordinate, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    low = np.cos(np.minimum(anchor + apart, np.pi)) - _SLACK
    high = np.cos(np.maximum(anchor - apart, 0)) + _SLACK
    return low, high


def candidates(bucket: Bucket, anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray, focus: np.ndarray):
    """For each anchor the rows that may have a product of ``least`` or more: None for all, an array else.

    The sorted list of each focus coordinate gives a range of rows; the smallest is checked against the others.
    """
    longest = bucket.lengths.max(initial=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(least <= 0, -1.0, least / np.maximum(lengths * longest, 1e-300))
    found: list = [None] * len(anchors)
    for a in np.flatnonzero(cosine > 1 + _SLACK):
        found[a] = np.zeros(0, np.int64)
    bounded = np.flatnonzero((cosine > 0) & (cosine <= 1 + _SLACK))
    if not len(bounded) or not focus.shape[1]:
        return found
    n = len(bucket.rows)
    spans = np.zeros((len(bounded), focus.shape[1], 2), np.int64)
    unit = anchors[bounded] / lengths[bounded, None]
    for i in np.unique(focus[bounded]):
        values, _ = bucket.sorted_list(int(i))
        which, place = np.nonzero(focus[bounded] == i)
        low, high = feasible(unit[which, i], cosine[bounded][which])
        spans[which, place, 0] = np.searchsorted(values, low, side="left")
        spans[which, place, 1] = np.searchsorted(values, high, side="right")
    sizes = spans[:, :, 1] - spans[:, :, 0]
    for k in np.flatnonzero(sizes.min(1) < n // 2):
        a, order = bounded[k], np.argsort(sizes[k], kind="stable")
        first, *others = order
        _, rows = bucket.sorted_list(int(focus[a, first]))
        kept = rows[spans[k, first, 0] : spans[k, first, 1]]
        for other in others:
            if sizes[k, other] < n:
                low, high = feasible(unit[k, focus[a, other]], cosine[a])
                part = bucket.vectors[kept, focus[a, other]] / np.maximum(bucket.lengths[kept], 1)
                kept = kept[(part >= low) & (part <= high)]
        found[a] = kept
    return found


def products(bucket: Bucket, anchors: np.ndarray, found: list):
    """(anchor, rows of the bucket, exact products) of all candidates; anchors that see all rows are multiplied together."""
    whole = [a for a, rows in enumerate(found) if rows is None]
    for start in range(0, len(whole), STRIPE):
        some = whole[start : start + STRIPE]
        every = np.arange(len(bucket.rows))
        for a, scores in zip(some, anchors[some] @ bucket.vectors.T):
            yield a, every, scores
    for a, rows in enumerate(found):
        if rows is not None and len(rows):
            yield a, rows, bucket.vectors[rows] @ anchors[a]


class Best:
    """The first k rows by score (descending), then id (null ids last), then number, within a range of scores."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids, self.at = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> float:
        """The least score that can still be among the first k."""
        return self.low if len(self.scores) < self.k else max(self.low, self.scores[-1])

    def add(self, scores: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        counts = (scores >= self.least()) & (scores <= self.high)
        if not counts.any():
            return
        scores = np.concatenate([self.scores, scores[counts]])
        ids, at = np.concatenate([self.ids, ids[counts]]), np.concatenate([self.at, at[counts]])
        order = np.lexsort((at, ids, -scores))[: self.k]
        self.scores, self.ids, self.at = scores[order], ids[order], at[order]


def _searched(buckets: list[Bucket], anchors: np.ndarray, found: list[list[Best]], ids: np.ndarray, at: np.ndarray, own: np.ndarray):
    """Give every ``found[a]`` the rows of the buckets, longest first; ``own`` are the anchors' numbers."""
    if not len(anchors):
        return
    lengths = np.sqrt((anchors * anchors).sum(1))
    width = min(FOCUS, anchors.shape[1])
    focus = np.argsort(-np.abs(anchors), axis=1, kind="stable")[:, :width]
    for bucket in buckets:
        least = np.array([min((b.least() for b in best), default=np.inf) for best in found])
        for a, rows, scores in products(bucket, anchors, candidates(bucket, anchors, lengths, least, focus)):
            near = np.flatnonzero(scores >= min(b.least() for b in found[a]))
            places = bucket.rows[rows[near]]
            other = at[places] != own[a]
            near, places = near[other], places[other]
            for best in found[a]:
                best.add(scores[near], ids[places], at[places])


def _buckets(places: np.ndarray, vectors: np.ndarray) -> list[Bucket]:
    """The rows at some places in buckets of like lengths, longest first."""
    squares = (vectors[places] ** 2).sum(1)
    places = places[np.argsort(-squares, kind="stable")]
    parts = [places[i : i + BUCKET] for i in range(0, len(places), BUCKET)]
    return [Bucket(part, vectors[part], np.sqrt((vectors[part] ** 2).sum(1))) for part in parts]


_LAST = np.iinfo(np.int64).max  # stands for a null id in the order
_FOUND = "anchor long, positive int, at long, vec_id long, score long"


def _ids(table: pa.Table) -> np.ndarray:
    return table["vec_id"].combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False)


def _emitted(anchors: np.ndarray, found: list[list[Best]]) -> pa.Table:
    rows = [(a, i, best) for a, bests in zip(anchors.tolist(), found) for i, best in enumerate(bests)]
    counts = [len(best.at) for _, _, best in rows]
    flat = lambda name, kind: np.concatenate([np.zeros(0, kind), *(getattr(b, name) for _, _, b in rows)]).astype(kind)
    ids = flat("ids", np.int64)
    return pa.table({
        "anchor": pa.array(np.repeat(np.array([a for a, _, _ in rows], np.int64), counts)),
        "positive": pa.array(np.repeat(np.array([i for _, i, _ in rows], np.int32), counts)),
        "at": pa.array(flat("at", np.int64)),
        "vec_id": pa.array(ids, mask=ids == _LAST),
        "score": pa.array(flat("scores", np.int64)),
    })


def _nearest_alike(k: int):
    """In a block, each anchor's first k other rows of its label."""

    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        d = dimensions(rows["x"], anchors["x"])
        vectors, queries = matrix(rows["x"], d), matrix(anchors["x"], d)
        labels, wanted = rows["label"].to_numpy(), anchors["label"].to_numpy()
        ids, at, own = _ids(rows), rows["at"].to_numpy(), anchors["at"].to_numpy()
        found = [[Best(k, -np.inf, np.inf)] for _ in own]
        for label in np.unique(wanted):
            mine = np.flatnonzero(wanted == label)
            buckets = _buckets(np.flatnonzero(labels == label), vectors)
            _searched(buckets, queries[mine], [found[a] for a in mine], ids, at, own[mine])
        return _emitted(own, found)

    return run


def _hard_others(k: int, low: int, high: int):
    """In a block, for each anchor and positive the first k rows of other labels within the scores' window."""

    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        d = dimensions(rows["x"], anchors["x"])
        vectors, queries = matrix(rows["x"], d), matrix(anchors["x"], d)
        labels, wanted = rows["label"].to_numpy(), anchors["label"].to_numpy()
        ids, at, own = _ids(rows), rows["at"].to_numpy(), anchors["at"].to_numpy()
        # products are whole: the bounds are rounded inwards
        found = [[Best(k, -(-low * s // 100), high * s // 100) for s in scores] for scores in anchors["scores"].to_pylist()]
        for label in np.unique(wanted):
            mine = np.flatnonzero(wanted == label)
            buckets = _buckets(np.flatnonzero(labels != label), vectors)
            _searched(buckets, queries[mine], [found[a] for a in mine], ids, at, own[mine])
        return _emitted(own, found)

    return run


def _met(rows: DataFrame, anchors: DataFrame, blocks: Blocks, run) -> DataFrame:
    """``run`` on every block and every group of the anchors that may reach it (their ``blocks``), written."""
    groups = -(-max(anchors.count(), 1) // GROUP)
    here = rows.withColumn("bucket", length_bucket(F.col("square"))).withColumn("block", blocks.of_rows())
    here = here.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    there = anchors.withColumn("group", F.pmod(F.xxhash64("at"), F.lit(groups)).cast("int"))
    there = there.where("blocks > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    met = here.select("block", "group", "at", "vec_id", "label", "x").groupBy("block", "group").cogroup(
        there.drop("blocks").groupBy("block", "group")
    )
    return written(met.applyInArrow(run, _FOUND))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k rows of each anchor and positive over all blocks, with their rank from 1."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "at"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def mined(
    rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding; other columns are not read. Anchors are the rows whose vec_id is
    divisible by ``every``. An anchor's positives are its first ``positives`` other rows of the same label by
    integer inner product, ties by vec_id (null ids last). For each, the first ``negatives`` rows of other labels
    with a score of ``low`` to ``high`` percent of the positive's follow, ranked from 1. Repeated rows count each
    as a row, and so does every repeated anchor. Shorter vectors count as ending in zeros. Anchors without
    another row of their label, and positives without such a negative, have no rows; nor has an empty table.
    """
    rows = prepared(rows, scale)
    spark = rows.sparkSession
    # enough blocks for all cores, none larger than a task can hold
    total = rows.count()
    blocks = blocks_of(rows, max(min(BLOCK, -(-total // spark.sparkContext.defaultParallelism)), 1))
    anchors = rows.where(F.col("vec_id") % every == 0).select("at", "vec_id", "label", "x", "square")
    everywhere = anchors.withColumn("blocks", F.lit(blocks.count))
    first = _first(_met(rows, everywhere, blocks, _nearest_alike(positives)), positives)
    alike = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("alike"))
    known = written(anchors.join(alike, anchors["at"] == alike["anchor"]).drop("anchor"))
    least = F.ceil(F.array_min(F.transform("alike", lambda p: p["score"])) * F.lit(low) / 100)
    wanting = known.select(
        "at", "vec_id", "label", "x", F.transform("alike", lambda p: p["score"]).alias("scores"),
        blocks.reached(F.col("square"), least.cast("double")).alias("blocks"),
    )
    hard = _first(_met(rows, wanting, blocks, _hard_others(negatives, low, high)), negatives)
    pairs = known.select(F.col("at").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("alike").alias("positive", "of"))
    pairs = pairs.select("anchor", "positive", "anchor_id", F.col("of.vec_id").alias("positive_id"), F.col("of.score").alias("positive_score"))
    return hard.join(pairs, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
