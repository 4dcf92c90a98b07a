"""The published state of a target: its segments, the schemas they were written with, and what of them is live."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from tidemark.functions.types import parse_type
from tidemark.operators.conform import Columns
from tidemark.operators.layout import Layout
from tidemark.operators.sketches import share_kept

#: A segment is rewritten when no more than this share of its rows is live.
LEAST_LIVE = 0.25


@dataclass(frozen=True)
class Segment:
    """A written table; ``keep`` bounds the rows still valid.

    ``low`` is the lowest key if all rows have one, ``high`` the highest one. ``schema`` is the state's list of
    columns that the table was written with, ``rejects`` the number of rows that were left out (None: the table has no
    place for them). ``keys`` rows have a key, and ``depths`` has these keys at equal steps of depth.
    """

    table: str
    low: int | None = None
    keep: tuple[str, int] | None = None
    rows: int | None = None
    high: int | None = None
    schema: int = 0
    rejects: int | None = None
    keys: int | None = None
    depths: tuple[int, ...] = ()
    salted: bool = False

    def cut(self, keep: tuple[str, int]) -> Segment | None:
        """This segment below a bound, None if nothing of it is left."""
        op, bound = keep
        if self.low is not None and (self.low > bound if op == "<=" else self.low >= bound):
            return None
        if self.high is not None and (self.high <= bound if op == "<=" else self.high < bound):
            return self
        # At the same bound "<" leaves less than "<=", and it also sorts first.
        return replace(self, keep=min(keep, self.keep or keep, key=lambda k: (k[1], k[0])))

    @property
    def live(self) -> int | None:
        """About how many rows are valid, from the depths of the key; rows without a key are."""
        if self.keep is None or self.rows is None or self.keys is None:
            return self.rows
        if not self.depths:
            return self.rows - self.keys
        return self.rows - self.keys + round(self.keys * share_kept(self.depths, *self.keep))

    @property
    def is_mostly_dead(self) -> bool:
        return self.keep is not None and bool(self.rows) and self.live <= LEAST_LIVE * self.rows


Schema = tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class State:
    """What a view publishes. The last of ``schemas`` is the target's; ``files`` are tables of the loaded files."""

    segments: tuple[Segment, ...]
    key: str | None = None
    high: int | None = None
    layout: Layout = field(default_factory=Layout)
    schemas: tuple[Schema, ...] = ()
    files: tuple[str, ...] = ()

    def dump(self) -> str:
        return json.dumps(asdict(self), separators=(",", ":"))

    @staticmethod
    def load(text: str) -> State:
        raw = json.loads(text)
        segments = tuple(
            Segment(**{**s, "keep": s["keep"] and tuple(s["keep"]), "depths": tuple(s.get("depths", ()))}) for s in raw["segments"]
        )
        layout = raw["layout"]
        layout = Layout(**{**layout, "sort_key": tuple(layout["sort_key"]), "hot": tuple(map(tuple, layout.get("hot", ())))})
        schemas = tuple(tuple(map(tuple, schema)) for schema in raw.get("schemas", ()))
        return State(segments, raw["key"], raw["high"], layout, schemas, tuple(raw.get("files", ())))

    @property
    def columns(self) -> Columns:
        return [(name, parse_type(kind)) for name, kind in self.schemas[-1]]

    def with_columns(self, columns: Columns) -> State:
        """The state with these columns; what is written from now on has them."""
        schema = schema_of(columns)
        if self.schemas and self.schemas[-1] == schema:
            return self
        return replace(self, schemas=(*self.schemas, schema))

    def compacted(self) -> State:
        """Without the schemas that no segment has any more."""
        used = sorted({segment.schema for segment in self.segments} | {len(self.schemas) - 1})
        at = {old: new for new, old in enumerate(used)}
        segments = tuple(replace(segment, schema=at[segment.schema]) for segment in self.segments)
        return replace(self, segments=segments, schemas=tuple(self.schemas[i] for i in used))


def schema_of(columns: Columns) -> Schema:
    return tuple((name, kind.simpleString()) for name, kind in columns)


def to_merge(segments: tuple[Segment, ...], most: int) -> list[int]:
    """The segments to write anew: those that are mostly dead, and the newest once there are many."""
    dead = [i for i, segment in enumerate(segments) if segment.is_mostly_dead]
    if len(segments) < most:
        return dead
    start = merge_start([segment.live for segment in segments])
    return sorted({*dead, *range(start, len(segments))})


def merge_start(rows: list[int | None]) -> int:
    """Where the newest segments to merge begin: two at least, and older ones up to twice their size.

    So a row is rewritten about as often as the table doubles, and a large full load hardly ever.
    """
    start = len(rows) - 2
    merged = (rows[-1] or 0) + (rows[-2] or 0)
    while start > 0 and rows[start - 1] is not None and rows[start - 1] <= 2 * merged:
        start -= 1
        merged += rows[start]
    return start


def column_sql(name: str, kind: str, had: dict[str, tuple[str, str]], quote) -> str:
    """A column of the target as a segment's table gives it: as it is, cast to the wider type, or NULL."""
    found = had.get(name.lower())
    if found is None:
        kind = "string" if kind.startswith(("varchar", "char")) else kind
        return f"CAST(NULL AS {kind}) AS {quote(name)}"
    own, was = found
    if was == kind or kind.startswith(("varchar", "char", "string")):
        return quote(own) if own == name else f"{quote(own)} AS {quote(name)}"
    return f"CAST({quote(own)} AS {kind}) AS {quote(name)}"
