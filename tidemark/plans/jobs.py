"""Jobs over lists of tables: recreate, update, copy, resume, load files, and the field-selection pair of loads.

Each job takes its tables as a delimited string, reads them from a source, and returns a report frame
with one row per table. Per table there is one distributed pass from scan to segment; the driver only
sees counts. Small tables leave a cluster idle, so several are loaded at a time.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import CancelledError, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import types
from tidemark.functions.casts import cast_or_fail
from tidemark.functions.text import column
from tidemark.operators import conform, scans, specs
from tidemark.operators.layout import Layout
from tidemark.operators.partitions import Parts
from tidemark.operators.targets import Loaded, Pending, Target, is_whole
from tidemark.plans.ledger import Ledger
from tidemark.sources import manifest
from tidemark.sources.catalog import CatalogSource, target_columns
from tidemark.sources.jdbc import JdbcSource

log = logging.getLogger(__name__)

REPORT = (
    "table_name string, status string, n_rows bigint, n_rejects bigint, high_key bigint, "
    "as_text array<string>, error string, n_cut bigint"
)
#: Tables that are loaded at a time.
CONCURRENT = 4

Source = CatalogSource | JdbcSource
Keys = str | dict[str, str]


class InvalidTables(ValueError):
    """The table list has invalid entries, or no entry at all."""


class CopyFailed(RuntimeError):
    """At least one table of a copy job failed; ``report`` says which."""

    def __init__(self, report: DataFrame, failed: list[str]):
        super().__init__(f"failed tables: {', '.join(failed)}")
        self.report = report


def _text_table(spark: SparkSession, text: str) -> DataFrame:
    return spark.createDataFrame([(text,)], "spec string")


def table_specs(spark: SparkSession, text: str, keys: list[str], kinds: list[str] | None = None) -> list[Row]:
    """The entries of a job's table list, one row per table, in order."""
    rows = specs.keyed_specs(_text_table(spark, text), "spec", keys, kinds).collect()
    return sorted(rows, key=lambda row: row.pos)


def bookmark_list(spark: SparkSession, text: str, given_only: bool = False) -> dict[str, int | None]:
    """The bookmark of each table of a copy job (the last one given counts), in order of first mention.

    With ``given_only``, a name without bookmark has None in place of 0. If any entry is invalid, the error
    names all that are. Names that the session takes for the same table are one, as first written.
    """
    entries = specs.bookmark_entries(_text_table(spark, text), "spec")
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    entries = sorted(entries.withColumn("key", F.col("name") if exact else F.lower("name")).collect(), key=lambda row: row.pos)
    invalid = [repr(row.entry) for row in entries if not row.valid]
    if invalid:
        raise InvalidTables(f"invalid tables: {', '.join(invalid)}")
    spelled: dict[str, str] = {}
    found: dict[str, int | None] = {}
    for row in entries:
        found[spelled.setdefault(row.key, row.name)] = row.bookmark if row.given or not given_only else None
    return found


def partition_configs(spark: SparkSession, text: str) -> dict[str, Parts]:
    """How each listed table is split for reading; the first entry for a table counts."""
    if not text.strip():
        return {}
    configs = specs.keyed_specs(_text_table(spark, text), "spec", ["table_name", "hashfield", "hashpartitions"])
    names = configs.select(F.col("table_name").alias("name")).distinct()
    try:
        rows = specs.with_partition_config(names, configs).where("should_partition").collect()
    except PySparkException as error:
        if error.getCondition() == "USER_RAISED_EXCEPTION":
            raise InvalidTables(f"invalid partitions: {text!r}") from error
        raise
    return {row.name: Parts(row.hashfield, int(row.hashpartitions)) for row in rows}


def _key_of(keys: Keys, name: str) -> str:
    return keys if isinstance(keys, str) else keys.get(name, specs.DEFAULT_FIELD)


def _ok(name: str, loaded: Loaded, as_text: list[str] | None = None) -> tuple:
    return (name, "ok", loaded.n_rows, loaded.n_rejects, loaded.high_key, as_text or [], None, loaded.n_cut)


def _not_ok(name: str, status: str, error: str | None = None) -> tuple:
    return (name, status, None, None, None, [], error, None)


def _side_by_side(
    spark: SparkSession, names: list[str], prepare: Callable[[int], Pending], at_a_time: int
) -> tuple[list[tuple], Exception | None]:
    """(report rows, the first error): loads prepared several at a time, and published one by one in the listed order.

    As if they ran one after the other: the first error in that order stops all later loads, whose Spark jobs are
    interrupted by their tags, and nothing of them is published. A table that is listed again waits for its
    earlier load.
    """
    run, stopped = uuid.uuid4().hex, threading.Event()
    done = [threading.Event() for _ in names]
    earlier = {i: max((j for j in range(i) if names[j].lower() == names[i].lower()), default=None) for i in range(len(names))}

    def attempt(i: int) -> Pending | None:
        if earlier[i] is not None:
            done[earlier[i]].wait()
        if stopped.is_set():
            return None
        tag, context = f"tidemark-{run}-{i}", spark.sparkContext
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        try:
            return prepare(i)
        finally:
            context.removeJobTag(tag)
            context.setInterruptOnCancel(False)

    report, error = [], None
    with ThreadPoolExecutor(max(1, min(at_a_time, len(names)))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(attempt), i) for i in range(len(names))]
        for i, (name, load) in enumerate(zip(names, started)):
            try:
                pending = load.result()
                if error is None:
                    report.append(_ok(name, _published(pending)))
                elif pending is not None:
                    pending.discard()
            except CancelledError:
                pass  # not begun when an earlier load failed
            except Exception as failure:
                if error is None:
                    error = failure
                    report.append(_not_ok(name, "failed", str(failure)))
                    stopped.set()
                    _interrupt(spark, {f"tidemark-{run}-{j}": started[j] for j in range(i + 1, len(names))})
                    done[i].set()
                    continue
            if error is not None:
                report.append(_not_ok(name, "not published"))
            done[i].set()
    return report, error


def _interrupt(spark: SparkSession, loads: dict[str, Future]) -> None:
    """Cancel the Spark jobs of some loads, by their tags, until all have ended; they may be between two jobs."""
    while left := [tag for tag, load in loads.items() if not load.done() and not load.cancel()]:
        for tag in left:
            spark.sparkContext.cancelJobsWithTag(tag)
        wait([loads[tag] for tag in left], timeout=0.2)


def _published(pending: Pending) -> Loaded:
    try:
        return pending.publish()
    except Exception:
        pending.discard()
        raise


def _reported(spark: SparkSession, report: list[tuple], error: Exception | None, raise_on_failure: bool) -> DataFrame:
    frame = spark.createDataFrame(report, REPORT)
    if error is not None and raise_on_failure:
        raise error
    return frame


def recreate_tables(
    source: CatalogSource,
    database: str,
    tables: str,
    string_width: int = types.STRING_WIDTH,
    other_width: int = types.WIDE_WIDTH,
    raise_on_failure: bool = True,
    max_concurrent: int = CONCURRENT,
) -> DataFrame:
    """Empty targets with the sources' columns in target types.

    Text of no declared width gets ``string_width`` bytes, types without one of their own ``other_width``. Entries
    are ``name:columns:sort_key:dist_key``. The first error stops the job; tables listed after it stay as they are.
    """
    spark = source.spark
    listed = table_specs(spark, tables, ["name", "columns", "sort_key", "dist_key"], ["str", "list", "list", "str"])

    def prepare(i: int) -> Pending:
        spec = listed[i]
        columns = target_columns(spark, source.identifier(spec.name), spec.columns, string_width, other_width)
        layout = Layout(tuple(spec.sort_key or ()), spec.dist_key).sized_for(source.read(spec.name))
        return Target(spark, database, spec.name).prepare_empty([(n, types.parse_type(t)) for n, t in columns], layout)

    report, error = _side_by_side(spark, [spec.name for spec in listed], prepare, max_concurrent)
    return _reported(spark, report, error, raise_on_failure)


def update_tables(
    source: Source,
    database: str,
    tables: str,
    partitions: str = "",
    keys: Keys = "id",
    delete_op: str = ">=",
    max_errors: int = 1,
    raise_on_failure: bool = True,
    max_concurrent: int = CONCURRENT,
) -> DataFrame:
    """Load existing targets: whole, or from a key on.

    Entries are ``name:columns:start``. With a positive start, rows at and above it are read and replace
    the target's rows there; ``delete_op=">"`` keeps the target's row at the start itself, which is then
    there twice. ``partitions`` has entries ``name:field:parts``. The first error stops the job: tables listed
    before it are loaded, those after it stay as they are. Without ``raise_on_failure`` the report says so.
    """
    spark = source.spark
    listed = table_specs(spark, tables, ["name", "columns", "start_id"], ["str", "list", "int"])
    parts = partition_configs(spark, partitions)

    def prepare(i: int) -> Pending:
        spec = listed[i]
        key, split = _key_of(keys, spec.name), parts.get(spec.name)
        frame = scans.scan(source.read(spec.name, split, key, spec.start_id), spec.columns, key, spec.start_id)
        frame = conform.unsigned_longs_to_long(frame)
        target = Target(spark, database, spec.name)
        # Parts are for reading from a database; files are split as they lie, and their rows need no shuffle.
        if spec.start_id and spec.start_id > 0:
            return target.prepare_tail(frame, key, spec.start_id, delete_op, max_errors=max_errors)
        return target.prepare_rows(frame, key, max_errors=max_errors)

    report, error = _side_by_side(spark, [spec.name for spec in listed], prepare, max_concurrent)
    return _reported(spark, report, error, raise_on_failure)


def copy_table(
    source: Source,
    database: str,
    name: str,
    bookmark: int | None,
    key: str,
    parts: Parts | None = None,
    positive_keys_only: bool = False,
    max_errors: int = 1,
    string_width: int = types.STRING_WIDTH,
    other_width: int = types.WIDE_WIDTH,
    decimals: str = "double",
) -> tuple[Loaded, list[str]]:
    """Copy one table whole (no bookmark), or replace its target above the bookmark.

    Decimals become doubles, or stay exact within the target's precision with ``decimals="clamp"``; an unsigned
    long as key becomes a bigint. Text wider than ``string_width`` bytes is cut and counted, a nested
    value whose JSON is wider than ``other_width`` is rejected. Columns of unmapped types become text, which the second result lists.
    The target is distributed and sorted by the key. ``positive_keys_only`` makes a whole copy leave
    out keys below 1 and rows without a key, as a bookmark of 0 would. Columns that the source has got since, and
    wider types, are taken over into an existing target.
    """
    if not source.exists(name):
        raise ValueError(f"the source has no table {name}")
    frame = source.read(name, parts, key, bookmark)
    if key not in frame.columns:
        raise ValueError(f"Table {name} has no column {key}")
    if bookmark is not None or positive_keys_only:
        frame = scans.after_key(frame, key, bookmark or 0)
    if decimals not in ("double", "clamp"):
        raise ValueError("decimals is 'double' or 'clamp'")
    if not is_whole(frame, key):
        raise ValueError(f"the key {key} of table {name} is not a whole number")
    if isinstance(frame.schema[key].dataType, T.DecimalType):
        frame = frame.withColumn(key, cast_or_fail(column(key), T.LongType(), key))
    frame = conform.decimals_to_double(frame) if decimals == "double" else conform.clamp_decimals(frame)
    columns = conform.target_schema(frame, string_width, other_width)
    target, layout = Target(source.spark, database, name), Layout((key,), key)
    if bookmark is None or not target.exists():
        loaded = target.replace_table(frame, key, layout, columns, max_errors=max_errors)
    else:
        loaded = target.replace_tail(frame, key, bookmark, evolve=columns, max_errors=max_errors)
    return loaded, conform.unmapped_columns(frame)


def copy_tables(
    source: Source,
    database: str,
    tables: str,
    keys: Keys = "id",
    partitions: str = "",
    resume: bool = False,
    raise_on_failure: bool = True,
    max_concurrent: int = CONCURRENT,
    run: str | None = None,
    **options,
) -> DataFrame:
    """Copy tables independently of each other: one that fails is reported and the others go on.

    Entries are ``name:bookmark`` or ``name``; a bookmark of 0 copies the whole table. With ``resume``, a
    table listed without a bookmark goes on above the highest key its target has; ``options`` are those of
    ``copy_table``. With the name of a ``run``, each table's report row is also added to the ledger of the target
    database as the table ends; the same run started again, after whatever loss, copies only the tables that
    have not ended well in it, and reports the others as they were.
    """
    spark = source.spark
    listed = bookmark_list(spark, tables, given_only=True)
    parts = partition_configs(spark, partitions)
    ledger = Ledger(spark, database) if run is not None else None
    ended = ledger.ended_well(run) if ledger else {}

    def attempt(name: str) -> tuple:
        if name.lower() in ended:
            return ended[name.lower()]
        row = copied(name)
        if ledger:
            ledger.add(run, row)
        return row

    def copied(name: str) -> tuple:
        bookmark = listed[name] or None
        try:
            key = _key_of(keys, name)
            if resume and listed[name] is None:
                state = Target(spark, database, name).state()
                bookmark = state.high if state is not None and state.key == key else None
            loaded, as_text = copy_table(source, database, name, bookmark, key, parts.get(name), **options)
            return _ok(name, loaded, as_text)
        except Exception as error:
            log.error("copying %s failed: %s", name, error)
            return _not_ok(name, "failed", str(error))

    with ThreadPoolExecutor(max(1, min(max_concurrent, len(listed)))) as pool:
        report = list(pool.map(inheritable_thread_target(spark)(attempt), listed))
    frame = spark.createDataFrame(report, REPORT)
    failed = [row[0] for row in report if row[1] == "failed"]
    if failed and raise_on_failure:
        raise CopyFailed(frame, failed)
    return frame


def load_files(
    target: Target,
    paths: str | list[str],
    schema: str,
    key: str | None = None,
    columns: conform.Columns | None = None,
    max_errors: int = 1,
    file_format: str = "json",
    recursive: bool = True,
    pattern: str | None = None,
    files_at_a_time: int = 100_000,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Add the rows of the files that the target has not loaded yet; a report row for each publication.

    ``schema`` is that of the files, ``columns`` are the target's if it is made here. Files, with length and time of
    modification, are published together with their rows, so that a run that is lost in between is repeated
    without a trace. A file that changed after it was loaded, or while it is, is an error that names it, and
    nothing is loaded. Lines that are no records count as rejects, with the rows that do not fit. Very many new files
    are published in several steps; their names go through the driver, as they do in any listing of files.
    """
    spark, report, most = target.spark, [], max(files_at_a_time, 1)
    listed = manifest.listing(spark, paths, recursive, pattern)
    while files := manifest.new_files(listed, target.files(), most):
        frame, broken = manifest.read_files(spark, [path for path, _, _ in files], schema, file_format, options)
        pending = target.prepare_append(frame, key, columns=columns, max_errors=max_errors, broken=broken)
        try:
            pending = target.with_files(pending, files)
            manifest.check_unchanged(manifest.listing(spark, paths, recursive, pattern), files)
        except Exception:
            pending.discard()
            raise
        report.append((*_ok(target.table, pending.publish()), len(files)))
        if len(files) < most:
            break  # those were all that the listing has
    return spark.createDataFrame(report or [(*_ok(target.table, Loaded(0, 0, None)), 0)], f"{REPORT}, n_files bigint")


def append_then_select(
    whole: DataFrame,
    selected_from: DataFrame,
    fields: list[str],
    target: Target,
    columns: conform.Columns | None = None,
    selected_columns: conform.Columns | None = None,
) -> tuple[Loaded, Loaded]:
    """Append a whole frame to a target, then replace the target by selected fields of another frame.

    The second load drops what the first one wrote; both results are returned.
    """
    first = target.append(whole, columns=columns)
    selected = scans.select_fields(selected_from, fields)
    second = target.replace_table(selected, columns=selected_columns)
    return first, second
