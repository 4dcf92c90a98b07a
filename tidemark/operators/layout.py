"""Physical layout of a target: how rows are distributed over files and ordered inside them."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import column, quoted
from tidemark.operators import skew
from tidemark.operators.conform import REJECTED
from tidemark.operators.partitions import Parts, spread

# Bounds on the number of files of a distributed table: its input by bucket, few for small input.
_BUCKET_BYTES = 128 << 20
_MAX_BUCKETS = 65_536
_SMALL_BUCKETS, _SMALL_BUCKET_BYTES = 8, 1 << 20
# The units in which Spark shows sizes.
_UNITS = {"B": 0, "KiB": 10, "MiB": 20, "GiB": 30, "TiB": 40, "PiB": 50, "EiB": 60}
_SIZE = re.compile(r"Statistics\(sizeInBytes=([0-9.E+]+) ([KMGTPE]?i?B)")


@dataclass(frozen=True)
class Layout:
    """Sort keys, distribution key and number of buckets for the latter (None: by size).

    ``by_size`` marks a number that follows from the rows, and is found anew when all of them are replaced.
    ``spread_hot`` deals the rows of very frequent distribution keys to several buckets; ``hot`` has these keys, as
    text, with the number of pieces of each. ``ranged`` gives each file a range of the sort key of its own.
    """

    sort_key: tuple[str, ...] = ()
    dist_key: str | None = None
    buckets: int | None = None
    by_size: bool = False
    spread_hot: bool = False
    hot: tuple[tuple[str, int], ...] = ()
    ranged: bool = False

    def sized_for(self, frame: DataFrame) -> Layout:
        if self.dist_key is None or self.buckets is not None and not self.by_size:
            return self
        return replace(self, buckets=bucket_count(frame), by_size=True)

    def heated_for(self, frame: DataFrame) -> Layout:
        """With the hot keys of ``frame``, from one pass over its key column, where none are known yet."""
        if not self.salted or self.hot:
            return self
        return replace(self, hot=skew.hot_keys(frame, self.dist_key, self.buckets))

    def hotter(self, hot: tuple[tuple[str, int], ...]) -> Layout:
        """With more hot keys; a key keeps its largest number of pieces, as written rows have them."""
        most = dict(self.hot)
        for key, pieces in hot:
            most[key] = max(pieces, most.get(key, 0))
        return replace(self, hot=tuple(sorted(most.items())))

    @property
    def salted(self) -> bool:
        return self.spread_hot and self.dist_key is not None

    def ddl(self) -> str:
        if self.dist_key is None:
            return ""
        by = f" SORTED BY ({', '.join(quoted(name) for name in self.sort_key)})" if self.sort_key else ""
        keys = quoted(self.dist_key) + (f", {skew.SALT}" if self.salted else "")
        return f" CLUSTERED BY ({keys}){by} INTO {self.buckets} BUCKETS"


def estimated_bytes(frame: DataFrame) -> int | None:
    """The size of what a frame reads, None where Spark has none (some database scans).

    Taken from the plan that EXPLAIN COST shows. Sources are added up; Spark's estimate for a join, the product of
    its sides, says nothing about rows.
    """
    spark, view = frame.sparkSession, f"sized_{uuid.uuid4().hex}"
    frame.createTempView(view)
    try:
        text = spark.sql(f"EXPLAIN COST SELECT * FROM {view}").first()[0]
    finally:
        spark.catalog.dropTempView(view)
    lines = text.split("== Physical Plan ==")[0].splitlines()
    sizes = [(re.match(r"[:\s|+-]*", line).end(), _SIZE.search(line)) for line in lines if _SIZE.search(line)]
    # a line is a source if the next one is not further in
    leaves = [found for (depth, found), (after, _) in zip(sizes, [*sizes[1:], (0, None)]) if after <= depth]
    size = sum(int(float(number) * (1 << _UNITS[unit])) for number, unit in (found.groups() for found in leaves))
    return size if leaves and size < 1 << 60 else None


def bucket_count(frame: DataFrame) -> int:
    """One bucket per 128 MiB of input, a few for smaller input so that cores share the work.

    Where the size is not known, the session's shuffle setting decides.
    """
    size = estimated_bytes(frame)
    if size is None:
        return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = min(size // _SMALL_BUCKET_BYTES, _SMALL_BUCKETS)
    return min(max(size // _BUCKET_BYTES, few, 1), _MAX_BUCKETS)


def spread_by_key(frame: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Rows distributed by key, all of a key together unless it is too large for one file.

    Without ``parts`` the number of files follows from the shuffled bytes at run time, so small input ends
    up in few files without a switch.
    """
    return frame.hint("rebalance", column(key)) if parts is None else spread(frame, Parts(key, parts))


def by_ranges(frame: DataFrame, keys: tuple[str, ...], files: int) -> DataFrame:
    """Rows dealt to files by ranges of ``keys`` that hold about equally many rows.

    Spark finds the ranges from a sample. Rows of one key are told apart by a hash, so that a frequent key is split
    over files of its own.
    """
    hashed = [column(f.name) for f in frame.schema.fields if skew.can_hash(f.dataType)]
    tie = F.xxhash64(*hashed) if hashed else F.lit(0)
    return frame.repartitionByRange(files, *[column(name) for name in keys], tie)


def lay_out(frame: DataFrame, layout: Layout, parts: Parts | None = None, order: str | None = None) -> DataFrame:
    """Distribute and order rows for a write, with one shuffle at most.

    With a distribution key the shuffle uses the buckets' own hash, so each task writes whole buckets
    and there are about as many files as buckets; a salt, which is added as a column, deals the rows of a hot key
    to several of them. A ranged layout deals rows by ranges of the sort key, or of ``order``. Without a layout,
    rows are ordered by ``order`` within each file, so that a bound on it skips data. Rejected rows, where
    they are flagged, come after all others.
    """
    if layout.dist_key is not None:
        if not layout.salted:
            return spread(frame, Parts(layout.dist_key, layout.buckets))
        frame = skew.with_salt(frame, layout.dist_key, dict(layout.hot), layout.buckets)
        return frame.hint("rebalance", layout.buckets, column(layout.dist_key), column(skew.SALT))
    by = layout.sort_key or ((order,) if order else ())
    if layout.ranged and by:
        frame = by_ranges(frame, by, bucket_count(frame))
    elif parts is not None and parts.count > 1:
        frame = spread_by_key(frame, parts.field, parts.count)
    flag = [column(REJECTED)] if REJECTED in frame.columns and by else []
    return frame.sortWithinPartitions(*flag, *[column(name) for name in by]) if by else frame
