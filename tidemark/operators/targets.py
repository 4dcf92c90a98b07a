"""Published tables that are replaced, cut at a key and extended atomically.

A target is a view over segment tables that never change once written. A load writes one new segment, in one
pass, checks it, and then publishes with a single CREATE OR REPLACE VIEW: readers see the old or
the new content, and a load that fails leaves the old one. Deleting a tail costs no rewrite: the view
reads older segments only up to the bound, a filter that file statistics turn into skipped data. The
view's properties record the segments, the layout, the schemas and the highest key loaded, so content and bookmark
change together. Rows that a load leaves out are part of its segment, where the view does not read them.

A target has one writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import column, quoted, sql_string
from tidemark.functions.types import STRING_WIDTH, WIDE_WIDTH, parse_type, widens
from tidemark.operators import sketches, skew
from tidemark.operators.conform import CUT, REASON_TYPE, REASONS, RECORD, REJECTED, Columns, align, fallible_columns, target_schema
from tidemark.operators.layout import Layout, lay_out
from tidemark.operators.partitions import Parts
from tidemark.operators.scans import kept_op
from tidemark.operators.segments import Segment, State, column_sql, schema_of, to_merge
from tidemark.sources.catalog import table_columns
from tidemark.sources.manifest import FILES as _FILES

#: Properties of what a target is made of: its state (view), whose a table is, what a load saw in it, and that it was refused.
STATE, OWNER, OBSERVED, REFUSED = "tidemark.state", "tidemark.owner", "tidemark.observed", "tidemark.refused"
#: Segments a target may have before a load merges the newest.
MAX_SEGMENTS = 16
_REJECTS = f"segment string, {RECORD[1:]} string, {REASONS[1:]} {REASON_TYPE}"


class TooManyRejects(RuntimeError):
    """A load reached its reject limit; the target is as it was. ``by_column`` counts the misfits of each column."""

    def __init__(self, message: str, by_column: dict[str, int]):
        shown = ", ".join(f"{name}: {n}" for name, n in by_column.items())
        super().__init__(message + (f" ({shown})" if shown else ""))
        self.by_column = by_column


@dataclass(frozen=True)
class Loaded:
    """What one load did; ``by_column`` counts the misfits of each column, as (name, rows)."""

    n_rows: int
    n_rejects: int
    high_key: int | None
    n_cut: int = 0
    by_column: tuple[tuple[str, int], ...] = ()


@dataclass
class Pending:
    """A load that is written, but that no reader sees yet."""

    target: Target
    state: State
    loaded: Loaded
    tables: list[str] = field(default_factory=list)

    def publish(self) -> Loaded:
        self.target._publish(self.state)
        return self.loaded

    def discard(self) -> None:
        for table in self.tables:
            self.target._drop(table)


class Target:
    """One published table; a load merges its newest segments when there are ``max_segments`` (None: MAX_SEGMENTS)."""

    def __init__(self, spark: SparkSession, database: str, table: str, max_segments: int | None = None):
        self.max_segments = max_segments
        self.spark, self.database, self.table = spark, database, table
        self.name = self._qualified(table)
        self._base = f"{table}__base"

    def _qualified(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    # -- reading ---------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self._is_there(self.table) or self._is_own(self._base)

    def _is_there(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self._qualified(table))

    def _properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self._qualified(table)}").collect()
        return {row.key: row.value for row in rows}

    def _is_own(self, table: str) -> bool:
        """Whether a table was written, or taken over, for this target."""
        return self._is_there(table) and self._properties(table).get(OWNER) == self.table.lower()

    def _owner(self) -> str:
        return f"{sql_string(OWNER)} = {sql_string(self.table.lower())}"

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def read_salted(self) -> tuple[DataFrame, dict[str, int]]:
        """The rows with the salt that they are stored by, and the hot keys, for ``skew.join_salted``."""
        state = self._current()
        selected = [self._kept_sql(state, s, skew.SALT if s.salted else f"0 AS {skew.SALT}") for s in state.segments]
        return self.spark.sql(" UNION ALL ".join(selected)), dict(state.layout.hot)

    def join(self, other: DataFrame, key: str | None = None, how: str = "inner") -> DataFrame:
        """The rows joined to ``other`` by the distribution key; a hot key's rows are read by several tasks."""
        layout = self._current().layout
        if not layout.salted or key not in (None, layout.dist_key):
            return self.read().join(other, key or layout.dist_key, how)
        rows, hot = self.read_salted()
        return skew.join_salted(rows, other, layout.dist_key, hot, how)

    def state(self) -> State | None:
        """None if there is no table of that name, or one that was not published here."""
        if not self._is_there(self.table):
            return None
        text = self._properties(self.table).get(STATE)
        return State.load(text) if text is not None else None

    def columns(self) -> Columns:
        """Declared columns."""
        return self._current().columns

    def _declared(self, table: str) -> Columns:
        return [(name, parse_type(kind)) for name, kind in table_columns(self.spark, self._qualified(table))]

    def _adopt(self) -> State | None:
        """The published state. A plain table of that name becomes the first segment; other views do not.

        A run that is lost between renaming and publishing is taken up by the next one.
        """
        state = self.state()
        if state is not None:
            # a state of an earlier version: all its segments have the columns of the first
            return state if state.schemas else replace(state, schemas=(schema_of(self._declared(state.segments[0].table)),))
        if self._is_there(self.table):
            if self._is_view():
                return None
            if self._is_there(self._base):
                raise ValueError(f"{self.name} cannot be taken over: there is a table {self._base}")
            self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ({self._owner()})")
            self.spark.sql(f"ALTER TABLE {self.name} RENAME TO {self._qualified(self._base)}")
        elif not self._is_own(self._base):
            return None
        state = State((Segment(self._base),), schemas=(schema_of(self._declared(self._base)),))
        self._publish(state)
        return state

    def _current(self) -> State:
        state = self._adopt()
        if state is None:
            raise ValueError(f"target {self.name} {'is another view' if self.exists() else 'does not exist'}")
        return state

    def _is_view(self) -> bool:
        return self.spark.catalog.getTable(self.name).tableType == "VIEW"

    # -- loads -----------------------------------------------------------------------------------

    def recreate(self, columns: Columns, layout: Layout = Layout()) -> None:
        """An empty table with these columns in place of whatever had the name."""
        self.prepare_empty(columns, layout).publish()

    def replace_rows(self, frame: DataFrame, key: str | None = None, **options) -> Loaded:
        """All rows replaced; columns and layout of the table stay, but for a number of buckets that follows the size."""
        return self.prepare_rows(frame, key, **options).publish()

    def replace_table(self, frame: DataFrame, key: str | None = None, *args, **options) -> Loaded:
        """Rows, columns and layout replaced, whether or not the table exists; see ``prepare_table``."""
        return self.prepare_table(frame, key, *args, **options).publish()

    def replace_tail(self, frame: DataFrame, key: str, start: int, delete_op: str = ">", **options) -> Loaded:
        """Rows with ``key > start`` (or ``>=``) replaced by ``frame``; rows without a key stay."""
        return self.prepare_tail(frame, key, start, delete_op, **options).publish()

    def append(self, frame: DataFrame, key: str | None = None, *args, **options) -> Loaded:
        """``frame`` added to the table, which is created first if there is none; see ``prepare_append``."""
        return self.prepare_append(frame, key, *args, **options).publish()

    def prepare_empty(self, columns: Columns, layout: Layout = Layout()) -> Pending:
        if layout.dist_key is not None and layout.buckets is None:
            layout = replace(layout, buckets=int(self.spark.conf.get("spark.sql.shuffle.partitions")), by_size=True)
        self._adopt()
        segment = self._create(columns, layout)
        state = State((Segment(segment, rows=0, salted=layout.salted),), layout=layout, schemas=(schema_of(columns),))
        return Pending(self, state, Loaded(0, 0, None), [segment])

    def prepare_rows(self, frame: DataFrame, key: str | None = None, **options) -> Pending:
        state = self._current()
        layout = state.layout.sized_for(frame).heated_for(frame)
        return self._replacement(frame, state.columns, layout, key, **options)

    def prepare_table(
        self,
        frame: DataFrame,
        key: str | None = None,
        layout: Layout = Layout(),
        columns: Columns | None = None,
        string_width: int = STRING_WIDTH,
        other_width: int = WIDE_WIDTH,
        **options,
    ) -> Pending:
        """Without ``columns``, text of no declared width gets ``string_width`` bytes, other types without one of
        their own ``other_width``; the result counts the values that were cut.
        """
        self._adopt()
        broken = options.get("broken")
        plain = frame.drop(broken) if broken else frame
        columns = columns or target_schema(plain, string_width, other_width)
        return self._replacement(frame, columns, layout.sized_for(frame).heated_for(frame), key, **options)

    def _replacement(self, frame: DataFrame, columns: Columns, layout: Layout, key: str | None, **options) -> Pending:
        state = State((), key, layout=layout, schemas=(schema_of(columns),))
        segment, loaded, hot = self._write(frame, state, key, **options)
        state = replace(state, segments=(segment,), high=loaded.high_key, layout=layout.hotter(hot))
        return Pending(self, state, loaded, [segment.table])

    def prepare_tail(
        self, frame: DataFrame, key: str, start: int, delete_op: str = ">", evolve: Columns | None = None, **options
    ) -> Pending:
        """``evolve`` lists the columns as the source has them now: see ``widen``."""
        state = self._current()
        if state.key not in (None, key):
            raise ValueError(f"{self.name} is bounded by {state.key}, not by {key}")
        if key not in (name for name, _ in state.columns):
            raise ValueError(f"{self.name} has no column {key}")
        if key not in frame.columns:
            raise ValueError(f"the rows for {self.name} have no column {key}, so no later load could replace them")
        state = self._merged(state)
        state = state.with_columns(_widened(state.columns, evolve or [], strict=False))
        segment, loaded, hot = self._write(frame, state, key, **options)
        kept = [old.cut((kept_op(delete_op), start)) for old in state.segments]
        # what was read, never the bound itself: keys up to a bound above the data are still to come
        last = start if kept_op(delete_op) == "<=" else start - 1
        highs = [loaded.high_key] if loaded.high_key is not None else []
        if state.high is not None and any(old is not None and old.rows != 0 for old in kept):
            highs.append(min(state.high, last))
        high = max(highs, default=None)
        state = replace(state, segments=_joined(kept, segment), key=key, high=high, layout=state.layout.hotter(hot))
        return Pending(self, state, replace(loaded, high_key=high), [segment.table])

    def prepare_append(
        self,
        frame: DataFrame,
        key: str | None = None,
        layout: Layout = Layout(),
        columns: Columns | None = None,
        evolve: Columns | None = None,
        **options,
    ) -> Pending:
        """``evolve`` lists the columns as the source has them now: see ``widen``."""
        if not self.exists():
            return self.prepare_table(frame, key, layout, columns, **options)
        state = self._merged(self._current())
        state = state.with_columns(_widened(state.columns, evolve or [], strict=False))
        segment, loaded, hot = self._write(frame, state, state.key or key, **options)
        if state.key is None:
            segment = replace(segment, low=None, high=None, keys=None, depths=())
        highs = [h for h in (state.high, loaded.high_key) if h is not None]
        high = max(highs) if state.key and highs else state.high
        state = replace(state, segments=_joined(state.segments, segment), high=high, layout=state.layout.hotter(hot))
        return Pending(self, state, loaded, [segment.table])

    def widen(self, columns: Columns) -> None:
        """New columns, and wider types of old ones, without a rewrite: the view casts and fills what older segments have.

        A column that would become narrower, or of another kind, is refused. Loads with ``evolve`` leave such
        columns as they are, and rows that do not fit them are cut or rejected as ever.
        """
        state = self._current()
        self._publish(state.with_columns(_widened(state.columns, columns, strict=True)))

    def refresh_statistics(self, columns: list[str] | None = None) -> None:
        """Analyze every segment for the optimizer: all columns, or row counts and the listed ones."""
        for segment in self._current().segments:
            if columns is None:
                scope = " FOR ALL COLUMNS"
            else:
                scope = f" FOR COLUMNS {', '.join(quoted(name) for name in columns)}" if columns else ""
            self.spark.sql(f"ANALYZE TABLE {self._qualified(segment.table)} COMPUTE STATISTICS{scope}")

    def statistics(self, of: str) -> DataFrame:
        """Row count of each segment and the range of one column, as analyzed or else as seen while it was written."""
        rows = []
        for segment in self._current().segments:
            name = self._qualified(segment.table)
            table = {r.col_name: r.data_type for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
            info = {
                r.info_name: None if r.info_value == "NULL" else r.info_value
                for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name} {quoted(of)}").collect()
            }
            counted = re.search(r"(\d+) rows", table.get("Statistics", ""))
            n_rows, nulls = int(counted[1]) if counted else segment.rows, info["num_nulls"]
            low, high = info["min"], info["max"]
            seen = self._observed(segment).get(of)
            if nulls is None and seen is not None:
                n_rows, low, high, nulls = segment.rows, seen["low"], seen["high"], seen["nulls"]
            rows.append((segment.table, n_rows, low, high, int(nulls) if nulls is not None else None))
        return self.spark.createDataFrame(
            rows, "segment string, n_rows bigint, low string, high string, n_nulls bigint"
        )

    def _observed(self, segment: Segment) -> dict[str, dict]:
        found = json.loads(self._properties(segment.table).get(OBSERVED, "{}"))
        return {name: sketches.parsed(text, segment.rows) for name, text in found.items()}

    def merged_statistics(self) -> DataFrame:
        """Column, n_rows, n_nulls, low, high, n_distinct and whether they are exact, without reading any row.

        Loads observe their key, distribution and sort columns, or those named by ``analyze``, in the pass that
        writes them; this joins what they saw. Distinct values are estimated. Where a tail was cut from a segment, its
        rows are estimated from the depths of the key, and ranges of other columns may be too wide: not exact.
        """
        state = self._current()
        parts, exact = [], all(segment.keep is None for segment in state.segments)
        for segment in state.segments:
            seen = self._observed(segment)
            if segment.keep is not None and segment.rows:
                bound = segment.keep[1] - (segment.keep[0] == "<")
                share = segment.live / segment.rows
                for name, found in seen.items():
                    if name != state.key:
                        found["nulls"] = round(found["nulls"] * share)
                    elif found["high"] is not None:
                        found["high"] = str(min(int(found["high"]), bound))
            parts.append((segment.live, seen))
        kinds = {name: kind for name, kind in state.columns if sketches.can_sketch(kind)}
        return sketches.merged(self.spark, parts, kinds, exact)

    def live_rows(self) -> DataFrame:
        """Segment, its rows when written, and about how many of them are live; nothing is read."""
        rows = [(s.table, s.rows, s.live, s.keep is not None) for s in self._current().segments]
        return self.spark.createDataFrame(rows, "segment string, n_written bigint, n_live bigint, is_cut boolean")

    # -- rejects and files -----------------------------------------------------------------------

    def rejects(self) -> DataFrame:
        """The rows that the published loads left out under a raised limit: segment, record (as JSON), reasons.

        They go with the rows of their load: a full replacement has only its own.
        """
        state = self.state()
        return self._left_out([s.table for s in state.segments if s.rejects] if state else [])

    def refused(self) -> DataFrame:
        """What the last load that was refused under a raised limit would have left out, until the next publication."""
        return self._left_out([name for name in self._segment_tables() if REFUSED in self._properties(name)])

    def _left_out(self, tables: list[str]) -> DataFrame:
        found = [
            self.spark.table(self._qualified(table))
            .where(column(REJECTED))
            .select(F.lit(table).alias("segment"), column(RECORD).alias("record"), column(REASONS).alias("reasons"))
            for table in tables
        ]
        return reduce(DataFrame.unionByName, found, self.spark.createDataFrame([], _REJECTS))

    def files(self) -> DataFrame:
        """The files that loads of files have published here: path, length, modified."""
        state = self.state()
        found = [self.spark.table(self._qualified(table)) for table in (state.files if state else ())]
        return reduce(DataFrame.unionByName, found, self.spark.createDataFrame([], _FILES))

    def with_files(self, pending: Pending, files: list[tuple]) -> Pending:
        """The load, with the files that it read; they are published by the same view."""
        before = self.state()
        known = before.files if before else ()
        rows = self.spark.createDataFrame(files, _FILES)
        if len(known) >= (self.max_segments or MAX_SEGMENTS):
            rows, known = rows.unionByName(self.files()), ()
        table = f"{self._segment_name()}_files"
        self.spark.sql(f"CREATE TABLE {self._qualified(table)} ({_FILES}) USING parquet TBLPROPERTIES ({self._owner()})")
        rows.write.insertInto(self._qualified(table))
        state = replace(pending.state, files=(*known, table))
        return replace(pending, state=state, tables=[*pending.tables, table])

    def drop(self) -> None:
        """Remove the table and everything it was made of."""
        if self._is_there(self.table):
            self.spark.sql(f"DROP {'VIEW' if self._is_view() else 'TABLE'} {self.name}")
        for name in self._segment_tables():
            self._drop(name)

    def _drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._qualified(table)}")

    # -- writing segments ------------------------------------------------------------------------

    def _segment_name(self) -> str:
        return f"{self.table}__{uuid.uuid4().hex[:12]}"

    def _like_segments(self) -> list[str]:
        """Tables whose names look like parts of this target."""
        own = re.compile(re.escape(self.table.lower()) + r"__(base|[0-9a-f]{12}(_files)?)")
        tables = self.spark.sql(f"SHOW TABLES IN {quoted(self.database)} LIKE {sql_string(self.table + '__*')}")
        return [row.tableName for row in tables.collect() if own.fullmatch(row.tableName)]

    def _segment_tables(self) -> list[str]:
        # a name alone proves nothing: tables without the owner property are someone else's
        return [name for name in self._like_segments() if self._is_own(name)]

    def _create(self, columns: Columns, layout: Layout, keeps_rejects: bool = False) -> str:
        name = self._segment_name()
        fields = [f"{quoted(n)} {t.simpleString()}" for n, t in columns]
        fields += [f"{skew.SALT} int"] if layout.salted else []
        fields += [f"{REASONS} {REASON_TYPE}", f"{RECORD} string", f"{REJECTED} boolean"] if keeps_rejects else []
        parted = f" PARTITIONED BY ({REJECTED})" if keeps_rejects else ""
        self.spark.sql(
            f"CREATE TABLE {self._qualified(name)} ({', '.join(fields)}) USING parquet{parted}{layout.ddl()} TBLPROPERTIES ({self._owner()})"
        )
        return name

    def _write(
        self,
        frame: DataFrame,
        state: State,
        key: str | None,
        parts: Parts | None = None,
        max_errors: int = 1,
        analyze: list[str] | None = None,
        broken: str | None = None,
    ) -> tuple[Segment, Loaded, tuple[tuple[str, int], ...]]:
        """Conform ``frame`` to the state's columns and write it as a new, unpublished segment.

        The third result are the keys found to be hot. Under a raised limit the rows that are left out are
        written too, to a partition of their own. ``broken`` is a column with lines that are no records.
        """
        columns = state.columns
        aligned = align(frame, columns, count_cut=True, keep_rejects=max_errors > 1, reasons=True, broken=broken)
        fallible = fallible_columns(frame, columns, broken)
        return self._store(aligned, state, key, fallible, parts, max_errors, analyze)

    def _store(
        self,
        aligned: DataFrame,
        state: State,
        key: str | None,
        fallible: Iterable[str] = (),
        parts: Parts | None = None,
        max_errors: int | None = None,
        analyze: list[str] | None = None,
    ) -> tuple[Segment, Loaded, tuple[tuple[str, int], ...]]:
        """Write aligned rows in one pass.

        Everything that is to be known of them is observed in the writing stage itself, after any shuffle: there Spark
        counts each task once, however often lost tasks are run again.
        """
        columns, layout = state.columns, state.layout
        flagged, kept = REJECTED in aligned.columns, RECORD in aligned.columns
        good = ~column(REJECTED) if flagged else F.lit(True)

        def valid(name):
            return F.when(good, column(name)) if flagged else column(name)

        metrics = [F.count_if(good).alias("n_rows"), F.count_if(~good).alias("n_rejects")]
        if CUT in aligned.columns:
            metrics.append(F.coalesce(F.sum(valid(CUT)), F.lit(0)).alias("n_cut"))
        if fallible:
            counts = [F.count_if(_is_reason(name)) for name in fallible]
            metrics.append(F.map_from_arrays(F.lit(list(fallible)), F.array(*counts)).alias("by_column"))
        ranged = key is not None and is_whole(aligned, key)
        if ranged:
            value = valid(key)
            metrics += [F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("n_keys")]
            metrics.append(sketches.depths_of(value.try_cast("bigint")).alias("depths"))
        tracked = [key, layout.dist_key, *layout.sort_key] if analyze is None else analyze
        kinds = {name: kind for name, kind in columns if name in tracked and sketches.can_sketch(kind)}
        for name, kind in kinds.items():  # the key's count and range are observed anyway
            seen_of = sketches.distinct_of if ranged and name == key else sketches.column_of
            metrics.append(seen_of(valid(name), kind).alias(f"of {name}"))
        if layout.salted:
            metrics.append(skew.frequent(valid(layout.dist_key)).alias("frequent"))
        observation = Observation()
        order = key if key in aligned.columns else None
        segment = self._create(columns, layout, kept)
        refused = False
        try:
            observed = lay_out(aligned, layout, parts, order).observe(observation, *metrics).drop(CUT)
            if not kept:
                observed = observed.where(good) if flagged else observed
                observed = observed.drop(REJECTED, REASONS)
            salt = [skew.SALT] if layout.salted else []
            names = [quoted(name) for name, _ in columns] + salt + ([REASONS, RECORD, REJECTED] if kept else [])
            observed.select(*names).write.insertInto(self._qualified(segment))
            seen = observation.get
            by_column = {name: n for name, n in (seen.get("by_column") or {}).items() if n}
            if max_errors is not None and seen["n_rejects"] >= max_errors:
                refused = kept
                raise TooManyRejects(f"{seen['n_rejects']} rows do not fit {self.name}, limit {max_errors}", by_column)
            low, high = (_whole(seen["low"]), _whole(seen["high"])) if ranged else (None, None)
            if kinds:
                found = {name: seen[f"of {name}"] for name in kinds}
                if ranged and key in found:
                    found[key] = sketches.as_column(seen["n_keys"], low, high, found[key])
                texts = json.dumps(found)
                self.spark.sql(f"ALTER TABLE {self._qualified(segment)} SET TBLPROPERTIES ({sql_string(OBSERVED)} = {sql_string(texts)})")
        except Exception:
            if refused:
                self._keep_refused(segment)
            else:
                self._drop(segment)
            raise
        keyed = ranged and seen["n_keys"] == seen["n_rows"]
        written = Segment(
            segment,
            low if keyed else None,
            rows=seen["n_rows"],
            high=high if keyed else None,
            schema=len(state.schemas) - 1,
            rejects=seen["n_rejects"] if kept else None,
            keys=seen["n_keys"] if ranged else None,
            depths=tuple(seen["depths"] or ()) if ranged else (),
            salted=layout.salted,
        )
        hot = skew.pieces_of(seen["frequent"], seen["n_rows"], layout.buckets) if layout.salted and seen["n_rows"] else ()
        loaded = Loaded(seen["n_rows"], seen["n_rejects"], high, seen.get("n_cut") or 0, tuple(sorted(by_column.items())))
        return written, loaded, hot

    def _keep_refused(self, segment: str) -> None:
        """Leave nothing of a refused load but its rejects, and nothing of the refused load before it."""
        for name in self._segment_tables():
            if name != segment.lower() and REFUSED in self._properties(name):
                self._drop(name)
        name = self._qualified(segment)
        self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({REJECTED} = false)")
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({sql_string(REFUSED)} = 'true')")

    def _kept_sql(self, state: State, segment: Segment, also: str | None = None) -> str:
        """The live rows of a segment, in the columns that the target has now."""
        own = state.schemas[segment.schema]
        had = {name.lower(): (name, kind) for name, kind in own}
        bounds = []
        if segment.rejects is not None:
            bounds.append(f"NOT {REJECTED}")
        if segment.keep is not None and state.key.lower() in had:  # without that column no row has a key
            op, bound = segment.keep
            bounds.append(f"({quoted(state.key)} {op} {bound} OR {quoted(state.key)} IS NULL)")
        if own == state.schemas[-1] and segment.rejects is None and not segment.salted and not also:
            selected = "*"
        else:
            selected = ", ".join(column_sql(name, kind, had, quoted) for name, kind in state.schemas[-1])
        where = f" WHERE {' AND '.join(bounds)}" if bounds else ""
        return f"SELECT {selected}{', ' + also if also else ''} FROM {self._qualified(segment.table)}{where}"

    def _merged(self, state: State) -> State:
        """Segments that are mostly dead, and the newest once there are many, written anew, so that reads stay cheap."""
        chosen = to_merge(state.segments, self.max_segments or MAX_SEGMENTS)
        if not chosen:
            return state
        old = [state.segments[i] for i in chosen]
        aligned = reduce(DataFrame.unionByName, [self.spark.sql(self._kept_sql(state, segment)) for segment in old])
        if any(segment.rejects for segment in old):
            aligned = self._with_rejects(aligned, [segment.table for segment in old if segment.rejects])
        segment, _, hot = self._store(aligned, state, state.key)
        segments = list(state.segments)
        segments[chosen[0]] = segment
        left = [s for i, s in enumerate(segments) if i not in chosen[1:] and (s.rows != 0 or s.rejects)]
        state = replace(state, segments=tuple(left or [segment]), layout=state.layout.hotter(hot)).compacted()
        self._publish(state)
        return state

    def _with_rejects(self, rows: DataFrame, tables: list[str]) -> DataFrame:
        """Live rows and the rejects of some segments, flagged."""
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
        left_out = self._left_out(tables).select(*nothing, column("reasons").alias(REASONS), column("record").alias(RECORD), F.lit(True).alias(REJECTED))
        kept = rows.select("*", F.lit(None).cast(REASON_TYPE).alias(REASONS), F.lit(None).cast("string").alias(RECORD), F.lit(False).alias(REJECTED))
        return kept.unionByName(left_out)

    # -- publishing ------------------------------------------------------------------------------

    def _publish(self, state: State) -> None:
        """Switch readers to ``state``, then drop segments that neither it nor its predecessor uses.

        The predecessor's are kept until the next publication for queries that still read them.
        """
        before = self.state()
        state = state.compacted()
        body = " UNION ALL ".join(self._kept_sql(state, segment) for segment in state.segments)
        # the view has the types of its query: casts to its own would keep filters on text from the scan
        properties = f"{sql_string(STATE)} = {sql_string(state.dump())}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} WITH SCHEMA TYPE EVOLUTION TBLPROPERTIES ({properties}) AS {body}")
        states = [state] + ([before] if before else [])
        used = {name.lower() for s in states for name in (*(segment.table for segment in s.segments), *s.files)}
        for name in self._like_segments():
            if name not in used and self._is_own(name):
                self._drop(name)


def _is_reason(name: str) -> Column:
    return F.array_contains(column(REASONS)["column"], name)


def _widened(old: Columns, wanted: Columns, strict: bool) -> Columns:
    """``old`` with the wider types and the new columns of ``wanted``."""
    kinds = {name.lower(): kind for name, kind in wanted}
    out, refused = [], []
    for name, kind in old:
        new = kinds.pop(name.lower(), kind)
        if widens(kind, new):
            kind = new
        elif new != kind:
            refused.append(f"{name} from {kind.simpleString()} to {new.simpleString()}")
        out.append((name, kind))
    if refused and strict:
        raise ValueError(f"columns would become narrower, or of another kind: {', '.join(refused)}")
    return out + [(name, kind) for name, kind in wanted if name.lower() in kinds]


def _joined(kept: Iterable[Segment | None], new: Segment) -> tuple[Segment, ...]:
    """The segments with rows; an empty one only where there is no other to define the columns."""
    segments = [old for old in kept if old is not None and (old.rows != 0 or old.rejects)]
    return tuple(segments if segments and new.rows == 0 and not new.rejects else [*segments, new])


def is_whole(frame: DataFrame, key: str) -> bool:
    """Whether keys are whole numbers, which is what bounds and bookmarks are."""
    if key not in frame.columns:
        return False
    kind = frame.schema[key].dataType
    return isinstance(kind, T.IntegralType) or (isinstance(kind, T.DecimalType) and kind.scale == 0)


def _whole(value) -> int | None:
    return None if value is None else int(value)


def published(spark: SparkSession, database: str) -> list[Target]:
    """All targets of a database."""
    return [target for target, _ in _published(spark, database)]


def _published(spark: SparkSession, database: str) -> list[tuple[Target, State]]:
    names = spark.sql(f"SHOW VIEWS IN {quoted(database)}").where(~F.col("isTemporary")).collect()
    targets = [Target(spark, database, row.viewName) for row in names]
    found = [(target, target.state()) for target in targets]
    return [(target, state) for target, state in found if state is not None]


def bookmarks(spark: SparkSession, database: str) -> DataFrame:
    """The highest key loaded into each target."""
    rows = [(target.table, state.high) for target, state in _published(spark, database)]
    return spark.createDataFrame(rows, "table_name string, high_key bigint")
