"""

Every query runs its operator on whole tables; the ones about targets write them and read them back.
Decimals and dates are shown as doubles and text, and columns with NULLs as text that says so, because the
two engines hand these to pandas in different forms.
``START`` is a key bound as a job would be given; it stays the same at every scale.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
import zlib
from collections.abc import Callable
from urllib.parse import unquote, urlparse

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import quoted, sql_string, truncate_utf8
from tidemark.operators import conform, samples, scans, specs
from tidemark.operators.layout import Layout
from tidemark.operators.partitions import Parts, equal_depth, part_of, spread
from tidemark.operators.targets import Target, TooManyRejects, bookmarks
from tidemark.plans import jobs
from tidemark.plans.ledger import Ledger
from tidemark.sources.catalog import CatalogSource, target_columns
from tidemark.sources.drift import json_drift as drift_report
from tidemark.sources.files import preview, read_json, read_json_or_reject, schema_report
from tidemark.sources.manifest import ChangedFiles
from tidemark.workspace import new_database, shared_folder, ship_package

START = 500
KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "lineitem": "l_orderkey", "part": "p_partkey"}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(run):
        _QUERIES[run.__name__] = run
        if sql is not None:
            _ORACLES[run.__name__] = sql
        return run

    return register


def source(spark: SparkSession, sf_dir: str, *names: str) -> CatalogSource:
    """The test tables as a catalog database."""
    database = f"tidemark_source_{zlib.crc32(sf_dir.encode()):08x}"
    if not spark.catalog.databaseExists(database):
        location = sql_string(f"{shared_folder(spark)}/{database}")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {location}")
    tables = CatalogSource(spark, database)
    for name in names:
        if not tables.exists(name):
            location = sql_string(os.path.join(sf_dir, f"{name}.parquet"))
            spark.sql(f"CREATE TABLE {tables.identifier(name)} USING parquet LOCATION {location}")
    return tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return source(spark, sf_dir, name).read(name)


def derived(spark: SparkSession, sf_dir: str, **views: str) -> CatalogSource:
    """A source database of views over the test tables; ``{name}`` in a definition is a test table."""
    database = new_database(spark)
    names = ["orders", "customer", "lineitem", "part"]
    tables = source(spark, sf_dir, *names)
    for name, sql in views.items():
        body = sql.format(**{n: tables.identifier(n) for n in names})
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(database)}.{quoted(name)} AS {body}")
    return CatalogSource(spark, database)


def shown(column: str) -> Column:
    """A column with NULLs as text; in SQL ``coalesce(CAST(column AS VARCHAR), 'none')``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("none")).alias(column)


def new_target(spark: SparkSession, name: str) -> Target:
    return Target(spark, new_database(spark), name)


# -- scans ---------------------------------------------------------------------------------------------


@query("SELECT * FROM lineitem")
def scan_catalog_table(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= {START}")
def scan_projected_from_key(spark, sf_dir):
    return scans.scan(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"], "o_orderkey", START)


@query(f"SELECT * FROM orders WHERE o_orderkey > {START}")
def scan_after_bookmark(spark, sf_dir):
    return scans.after_key(table(spark, sf_dir, "orders"), "o_orderkey", START)


@query(
    f"SELECT l_orderkey, l_partkey, l_quantity, CAST(l_partkey % 11 AS INTEGER) AS part "
    f"FROM lineitem WHERE l_orderkey >= {START}"
)
def hash_partitioned_scan(spark, sf_dir):
    parts = Parts("l_partkey", 11)
    columns = ["l_orderkey", "l_partkey", "l_quantity"]
    rows = scans.scan(table(spark, sf_dir, "lineitem"), columns, "l_orderkey", START)
    return spread(rows.select("*", part_of(rows, parts).alias("part")), parts)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def select_fields(spark, sf_dir):
    return scans.select_fields(
        table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "no_such_field", "c_mktsegment"]
    )


@query("SELECT o_orderkey, o_custkey FROM orders")
def include_columns(spark, sf_dir):
    return scans.include_columns(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey", "o_orderkey_x", "o_order"])


_EVENTS = "event_id bigint, user_id bigint, event_type string, ts timestamp, value double, props string"
_EVENTS_SQL = "SELECT event_id, user_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS ts, value, props FROM events"


@query(f"{_EVENTS_SQL} WHERE event_id % 10 <> 3")
def json_scan(spark, sf_dir):
    """One line in ten is broken; none of them becomes a row of NULLs."""
    good, bad = read_json_or_reject(spark, _events_as_json(spark, sf_dir, broken=True), T.StructType.fromDDL(_EVENTS))
    if bad.count() != table(spark, sf_dir, "events").where("event_id % 10 = 3").count():
        raise AssertionError("a broken line is no reject")
    return _with_micros(good)


@query("SELECT CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_in_source")
def json_sample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.lit(1).alias("there"))
    sample = preview(read_json(spark, _events_as_json(spark, sf_dir))).select("event_id", "user_id")
    found = sample.join(events, ["event_id", "user_id"], "left")
    return found.agg(F.count("*").alias("n_rows"), F.count("there").alias("n_in_source"))


@query(
    "SELECT * FROM (VALUES ('event_id', 'bigint'), ('event_type', 'string'), ('props', 'string'), "
    "('ts', 'string'), ('user_id', 'bigint'), ('value', 'double')) AS t(\"column\", type)"
)
def json_schema(spark, sf_dir):
    return schema_report(read_json(spark, _events_as_json(spark, sf_dir))).select("column", "type")


_STATES_SQL = "SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'rejected' ELSE 'ok' END AS state FROM events"


@query(_STATES_SQL)
def json_rejects(spark, sf_dir):
    good, bad = read_json_or_reject(spark, _events_as_json(spark, sf_dir, broken=True), T.StructType.fromDDL(_EVENTS))
    return _states(good, bad)


def _states(good: DataFrame, bad: DataFrame) -> DataFrame:
    rejected = F.regexp_extract("record", '"event_id":([0-9]+)', 1).cast("bigint").alias("event_id")
    return good.select("event_id", F.lit("ok").alias("state")).unionByName(bad.select(rejected, F.lit("rejected").alias("state")))


@query(
    """
    WITH typed AS (
        SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'STRING' ELSE 'BIGINT' END AS user_id,
               CASE WHEN event_id % 7 = 0 THEN 'ARRAY' WHEN event_id % 7 = 1 THEN 'STRING' ELSE 'OBJECT' END AS props,
               event_id % 11 = 5 AS broken
        FROM events
    ), whole AS (SELECT * FROM typed WHERE NOT broken)
    SELECT '$' AS path, 'OBJECT' AS type, count(*) AS n_records FROM whole
    UNION ALL SELECT '$', 'BROKEN', count(*) FROM typed WHERE broken
    UNION ALL SELECT '$.event_id', 'BIGINT', count(*) FROM whole
    UNION ALL SELECT '$.user_id', user_id, count(*) FROM whole GROUP BY user_id
    UNION ALL SELECT '$.props', props, count(*) FROM whole GROUP BY props
    UNION ALL SELECT '$.props.k', 'BIGINT', count(*) FROM whole WHERE props = 'OBJECT'
    """
)
def json_drift(spark, sf_dir):
    """A number that is text now and then, a nested value of three kinds, and lines that are no JSON."""
    n, k = F.col("event_id"), F.get_json_object("props", "$.k")
    user = F.when(n % 10 == 3, F.concat(F.lit('"u'), "user_id", F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    props = F.when(n % 7 == 0, F.concat(F.lit("["), k, F.lit("]"))).when(n % 7 == 1, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(F.col("props"))
    line = F.format_string('{"event_id":%s,"user_id":%s,"props":%s}', "event_id", user, props)
    line = F.when(n % 11 == 5, F.left(line, F.length(line) - 1)).otherwise(line)
    folder = f"{shared_folder(spark)}/tidemark_json_{uuid.uuid4().hex[:12]}"
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(folder)
    return drift_report(spark, folder)


_SAMPLED = "md5(concat_ws('|', 'spring', CAST(event_id AS VARCHAR)))"


@query(
    f"SELECT 'all' AS of, event_id, event_type, value FROM (SELECT * FROM events ORDER BY {_SAMPLED} LIMIT 100) "
    f"UNION ALL SELECT 'type', event_id, event_type, value FROM events "
    f"QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY {_SAMPLED}) <= 25"
)
def stable_sample(spark, sf_dir):
    """The same rows on every run: of all events, where two halves are sampled and merged, and of each type."""
    events = table(spark, sf_dir, "events")
    halves = [samples.stable_sample(events.where(f"event_id % 2 = {i}"), 100, ["event_id"], seed="spring") for i in (0, 1)]
    whole = samples.stable_sample(halves[0].unionByName(halves[1]), 100, ["event_id"], seed="spring")
    by_type = samples.stable_sample(events, 25, ["event_id"], by=["event_type"], seed="spring")
    shown_columns = ["event_id", "event_type", "value"]
    return whole.select(F.lit("all").alias("of"), *shown_columns).unionByName(by_type.select(F.lit("type").alias("of"), *shown_columns))


def _with_micros(events: DataFrame) -> DataFrame:
    """Times as whole microseconds, which both engines hand on alike."""
    return events.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


def _events_as_json(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    folder = f"{shared_folder(spark)}/tidemark_json_{uuid.uuid4().hex[:12]}"
    _write_events(table(spark, sf_dir, "events"), folder, broken)
    return folder


def _write_events(events: DataFrame, folder: str, broken: bool = False) -> None:
    """Events as JSON lines in a folder for each type; if asked, one line in ten lacks its end."""
    # times with all their digits; JSON files have milliseconds otherwise
    timed = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    line = F.to_json(F.struct(*events.columns))
    if broken:
        line = F.when(F.col("event_id") % 10 == 3, F.left(line, F.length(line) - 1)).otherwise(line)
    lines = timed.select(F.col("event_type").alias("folder"), line.alias("value"))
    lines.write.mode("append").partitionBy("folder").text(folder)


# -- type conversion -----------------------------------------------------------------------------------


@query("SELECT l_orderkey AS key_long, l_partkey, l_quantity AS quantity FROM lineitem")
def unsigned_longs_to_long(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("decimal(20,0)").alias("key_long"),
        "l_partkey",
        F.col("l_quantity").cast("decimal(20,1)").alias("quantity"),
    )
    return conform.unsigned_longs_to_long(lines).withColumn("quantity", F.col("quantity").cast("double"))


@query(
    "SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS price, "
    "CAST(l_partkey AS DOUBLE) AS part FROM lineitem"
)
def decimals_to_double(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
        F.col("l_partkey").cast("decimal(20,0)").alias("part"),
    )
    return conform.decimals_to_double(lines)


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS price, true AS clamped FROM orders")
def clamp_decimals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price")
    )
    clamped = conform.clamp_decimals(orders, max_precision=10)
    is_clamped = F.lit(clamped.schema["price"].dataType == T.DecimalType(10, 2))
    return clamped.select("o_orderkey", F.col("price").cast("double").alias("price"), is_clamped.alias("clamped"))


@query(
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, "
    "CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders"
)
def cast_by_type_names(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate", "o_custkey")
    names = {"o_orderkey": "INT", "o_totalprice": "decimal(12, 2)", "o_orderdate": "date", "o_custkey": "no_such_type"}
    cast = conform.cast_by_names(orders, names)
    return cast.withColumns({name: F.col(name).cast("string") for name in ("o_totalprice", "o_orderdate")})


@query(
    """
    SELECT doc_id, source,
           CASE WHEN strlen(text) <= 255 THEN text
                ELSE left(text, list_max(list_filter(range(0, 256), lambda k: strlen(left(text, k)) <= 255)))
           END AS text
    FROM documents
    """
)
def truncate_to_bytes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", truncate_utf8(F.col("text"), 255).alias("text"))


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15,2)) :: DOUBLE AS price, l_shipdate,
           l_returnflag, '[' || l_partkey || ',' || l_suppkey || ']' AS keys,
           '{"line":' || l_linenumber || ',"flag":"' || l_returnflag || '"}' AS line,
           CAST(l_linenumber AS VARCHAR) AS small
    FROM lineitem
    """
)
def conform_to_target(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(15,2)").alias("price"),
        "l_shipdate",
        "l_returnflag",
        F.array("l_partkey", "l_suppkey").alias("keys"),
        F.struct(F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag")).alias("line"),
        F.col("l_linenumber").cast("smallint").alias("small"),
    )
    return conform.to_target(lines).withColumn("price", F.col("price").cast("double"))


_DIRTY_EVENTS = """
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS value FROM events
"""


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 10 == 0, "bad").otherwise(F.col("value").cast("string"))
    return events.select("event_id", text.alias("value"))


_EVENT_COLUMNS = [("event_id", T.LongType()), ("value", T.DoubleType())]


@query(f"SELECT * FROM ({_DIRTY_EVENTS}) WHERE TRY_CAST(value AS DOUBLE) IS NULL AND value IS NOT NULL")
def rejected_rows(spark, sf_dir):
    return conform.split_rejects(_dirty_events(spark, sf_dir), _EVENT_COLUMNS)[1]


@query("SELECT event_id, value FROM events WHERE event_id % 10 <> 0")
def load_within_reject_limit(spark, sf_dir):
    target = new_target(spark, "events")
    target.recreate(_EVENT_COLUMNS)
    target.replace_rows(_dirty_events(spark, sf_dir), "event_id", max_errors=1 << 62)
    return target.read()


@query(f"SELECT * FROM ({_DIRTY_EVENTS}) WHERE TRY_CAST(value AS DOUBLE) IS NULL AND value IS NOT NULL")
def kept_rejects(spark, sf_dir):
    """The rows that a load left out, from its side table."""
    target = new_target(spark, "events")
    target.recreate(_EVENT_COLUMNS)
    target.replace_rows(_dirty_events(spark, sf_dir), "event_id", max_errors=1 << 62)
    return target.rejects().select(F.from_json("record", "event_id bigint, value string").alias("r")).select("r.*")


_DIRTY_LINES = """
    SELECT l_orderkey, CASE WHEN l_linenumber = 3 THEN 'third' ELSE CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
           CASE WHEN l_partkey % 9 = 4 THEN l_quantity || ' pcs' ELSE CAST(l_quantity AS VARCHAR) END AS l_quantity,
           CASE WHEN l_suppkey % 50 = 1 THEN '1.1.95' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS l_shipdate
    FROM lineitem
"""
_LINE_TYPES = {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_shipdate": "date"}


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, quantity = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") == 3, "third").otherwise(number).alias("l_linenumber"),
        F.when(F.col("l_partkey") % 9 == 4, F.concat(quantity, F.lit(" pcs"))).otherwise(quantity).alias("l_quantity"),
        F.when(F.col("l_suppkey") % 50 == 1, "1.1.95").otherwise(F.to_date("l_shipdate").cast("string")).alias("l_shipdate"),
    )


def _line_target(spark: SparkSession) -> Target:
    target = new_target(spark, "lineitem")
    target.recreate([(name, T.DataType.fromDDL(kind)) for name, kind in _LINE_TYPES.items()])
    return target


_REASONS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", '{kind}' AS wanted, {name} AS value, count(*) AS n_rows FROM ({_DIRTY_LINES}) "
    f"WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL GROUP BY {name}"
    for name, kind in list(_LINE_TYPES.items())[1:]
)


@query(_REASONS_SQL)
def reject_reasons(spark, sf_dir):
    """Which values of which columns kept rows out, from the rejects; counted by column in the load itself as well."""
    target = _line_target(spark)
    loaded = target.replace_rows(_dirty_lines(spark, sf_dir), "l_orderkey", max_errors=1 << 62)
    reasons = target.rejects().select(F.explode("reasons").alias("r")).groupBy("r.column", "r.wanted", "r.value")
    found = reasons.agg(F.count("*").alias("n_rows"))
    by_column = {r.column: r.n for r in found.groupBy("column").agg(F.sum("n_rows").alias("n")).collect()}
    if dict(loaded.by_column) != by_column:
        raise AssertionError(f"counted {loaded.by_column} while loading, {by_column} in the rejects")
    return found


@query(
    f"SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM ({_DIRTY_LINES}) WHERE TRY_CAST(l_linenumber AS INT) IS NULL "
    "OR TRY_CAST(l_quantity AS DOUBLE) IS NULL OR TRY_CAST(l_shipdate AS DATE) IS NULL"
)
def refused_load_rejects(spark, sf_dir):
    """What a refused load would have left out; the target has neither rows nor rejects of it."""
    target = _line_target(spark)
    try:
        target.replace_rows(_dirty_lines(spark, sf_dir), "l_orderkey", max_errors=2)
    except TooManyRejects:
        if not (target.read().isEmpty() and target.rejects().isEmpty()):
            raise AssertionError("a refused load left something")
        kinds = "l_orderkey bigint, l_linenumber string, l_quantity string, l_shipdate string"
        return target.refused().select(F.from_json("record", kinds).alias("r")).select("r.*")
    raise AssertionError("the load was not refused")


@query("SELECT event_id, value FROM events WHERE event_id % 10 <> 0")
def refused_load_keeps_rows(spark, sf_dir):
    """A load with too many rejects leaves what the one before it published."""
    target = new_target(spark, "events")
    clean = table(spark, sf_dir, "events").where("event_id % 10 <> 0").select("event_id", "value")
    target.replace_table(clean, "event_id")
    try:
        target.replace_rows(_dirty_events(spark, sf_dir), "event_id", max_errors=2)
    except TooManyRejects:
        return target.read()
    raise AssertionError("the load was not refused")


# -- specification strings -----------------------------------------------------------------------------


@query(
    """
    SELECT p_partkey, 0 AS pos, p_name AS name, p_brand || '|' || p_type AS cols, CAST(p_size AS VARCHAR) AS start_id
    FROM part
    UNION ALL SELECT p_partkey, 1, 'x', 'none', CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 2, 'y', '', 'none' FROM part
    """
)
def keyed_specs(spark, sf_dir):
    rows = specs.keyed_specs(_part_specs(spark, sf_dir), "spec", ["name", "cols", "start_id"], ["str", "list", "int"])
    rows = rows.withColumn("cols", F.array_join("cols", "|"))
    return rows.select("p_partkey", "pos", "name", shown("cols"), shown("start_id"))


@query(
    """
    SELECT p_partkey, p_name AS name, p_brand || '|' || p_type AS columns, CAST(p_size AS VARCHAR) AS end_id FROM part
    UNION ALL SELECT p_partkey, 'x', 'none', CAST(p_partkey AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'y', '', 'none' FROM part
    """
)
def named_specs(spark, sf_dir):
    rows = specs.named_specs(_part_specs(spark, sf_dir), "spec", ["name", "columns", "end_id"])
    rows = rows.withColumn("columns", F.array_join("columns", "|"))
    return rows.select("p_partkey", "name", shown("columns"), shown("end_id"))


@query(
    """
    SELECT p_partkey, 0 AS pos, p_name || '|' || p_brand || ',' || p_type || '|' || p_size AS "values" FROM part
    UNION ALL SELECT p_partkey, 1, 'x|-|' || p_partkey FROM part
    UNION ALL SELECT p_partkey, 2, 'y|,|-|extra' FROM part
    """
)
def spec_values(spark, sf_dir):
    rows = specs.spec_values(_part_specs(spark, sf_dir), "spec")
    return rows.select("p_partkey", "pos", F.array_join("values", "|", "-").alias("values"))


def _part_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    spec = F.format_string(
        " %s :%s,%s: %s ;; x::%s;\ty:,: :extra", "p_name", "p_brand", "p_type", "p_size", "p_partkey"
    )
    return part.select("p_partkey", spec.alias("spec"))


@query(
    """
    SELECT 'nation_' || c_nationkey AS name, CAST(max(c_custkey) AS VARCHAR) AS bookmark, true AS valid
    FROM customer GROUP BY c_nationkey
    UNION ALL SELECT c_name, 'none', false FROM customer
    UNION ALL SELECT n_name, '0', true FROM nation
    """
)
def bookmark_lists(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row"),
        F.format_string("nation_%s: %s ,%s:7", "c_nationkey", "c_custkey", "c_name").alias("spec"),
    )
    nations = table(spark, sf_dir, "nation").select(
        (-1 - F.col("n_nationkey").cast("bigint")).alias("row"), F.col("n_name").alias("spec")
    )
    entries = specs.bookmark_entries(customers.unionByName(nations), "spec")
    last = specs.last_bookmarks(entries, ["row", "pos"]).select("name", "bookmark", F.lit(True).alias("valid"))
    invalid = entries.where(~F.col("valid")).select("name", "bookmark", "valid")
    return last.unionByName(invalid).select("name", shown("bookmark"), "valid")


@query(
    """
    SELECT c_custkey, 'customer_' || c_custkey AS name, coalesce(hashfield, 'id') AS hashfield,
           coalesce(nullif(hashpartitions, ''), '1') AS hashpartitions,
           CAST(coalesce(nullif(hashpartitions, ''), '1') AS INTEGER) > 1 AS should_partition
    FROM customer LEFT JOIN (
        SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS hashfield,
               arg_min(CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(o_orderkey % 4 AS VARCHAR) END, o_orderkey) AS hashpartitions
        FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
    """
)
def partition_configs(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("customer_"), "c_custkey").alias("name")
    )
    parts = F.col("o_orderkey") % 4
    configs = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer_"), "o_custkey").alias("table_name"),
        F.col("o_orderpriority").alias("hashfield"),
        F.when(parts == 0, "").otherwise(parts.cast("string")).alias("hashpartitions"),
        "o_orderkey",
    )
    return specs.with_partition_config(customers, configs, order=["o_orderkey"])


# -- targets -------------------------------------------------------------------------------------------

# An older state of orders: other keys, other prices, the same number of rows.
_OLD_ORDERS = "SELECT * REPLACE (o_orderkey // 2 AS o_orderkey, o_totalprice + 1 AS o_totalprice) FROM orders"
_NEW_ORDERS = "SELECT * FROM orders"


def _old_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = {"o_orderkey": F.expr("o_orderkey div 2"), "o_totalprice": F.col("o_totalprice") + 1}
    return table(spark, sf_dir, "orders").withColumns(changed)


def _new_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query("SELECT * FROM lineitem")
def replace_rows(spark, sf_dir):
    tables = source(spark, sf_dir, "lineitem")
    lines = tables.read("lineitem")
    target = new_target(spark, "lineitem")
    columns = [(name, T.DataType.fromDDL(kind)) for name, kind in target_columns(spark, tables.identifier("lineitem"))]
    target.recreate(columns, Layout(("l_shipdate",), "l_partkey").sized_for(lines))
    target.replace_rows(lines, "l_orderkey")
    return target.read()


@query("SELECT *, CAST(1 AS BIGINT) AS n_files FROM lineitem")
def replace_rows_in_parts(spark, sf_dir):
    """All rows, and in how many files the rows with their flag lie."""
    lines = table(spark, sf_dir, "lineitem")
    target = new_target(spark, "lineitem")
    target.replace_table(lines, "l_orderkey", Layout(("l_orderkey",)), parts=Parts("l_returnflag", 8))
    files = target.read().select("l_returnflag", F.input_file_name().alias("file"))
    files = files.groupBy("l_returnflag").agg(F.countDistinct("file").alias("n_files"))
    return target.read().join(files, "l_returnflag")


@query("SELECT l_orderkey, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM lineitem GROUP BY l_orderkey")
def spread_large_input(spark, sf_dir):
    """A load in parts writes all rows of a key to one file."""
    target = new_target(spark, "lineitem")
    target.replace_table(table(spark, sf_dir, "lineitem"), "l_linenumber", parts=Parts("l_orderkey", 4))
    files = target.read().select("l_orderkey", F.input_file_name().alias("file"))
    return files.groupBy("l_orderkey").agg(F.count("*").alias("n_rows"), F.countDistinct("file").alias("n_files"))


@query("SELECT CAST(8 AS BIGINT) AS n_parts, count(*) AS n_rows, true AS is_even FROM lineitem")
def equal_depth_parts(spark, sf_dir):
    """Parts of a key of which one value has a third of all rows, and the others crowd at the low end."""
    crowded = F.when(F.col("l_linenumber") <= 2, F.lit(50)).otherwise(F.expr("l_partkey * l_partkey"))
    lines = table(spark, sf_dir, "lineitem").withColumn("k", crowded.cast("bigint"))
    parts = lines.groupBy(equal_depth(lines, "k", 8).part_of(lines).alias("part")).agg(F.count("*").alias("n"))
    even = F.max("n") <= 1.2 * F.avg("n")
    return parts.agg(F.countDistinct("part").alias("n_parts"), F.sum("n").alias("n_rows"), even.alias("is_even"))


_USER = "CASE WHEN event_id % 10 <> 0 THEN 7 ELSE user_id END"


@query(
    f"SELECT event_id, {_USER} AS user_id, event_type, value, n_events FROM events "
    f"JOIN (SELECT {_USER} AS u, count(*) AS n_events FROM events GROUP BY ALL) ON u = {_USER}"
)
def skewed_join(spark, sf_dir):
    """Events of which one user has nine in ten, stored by user and joined to a row for each user."""
    user = F.when(F.col("event_id") % 10 != 0, 7).otherwise(F.col("user_id")).cast("bigint")
    events = table(spark, sf_dir, "events").select("event_id", user.alias("user_id"), "event_type", "value")
    target = new_target(spark, "events")
    target.replace_table(events, "event_id", Layout(dist_key="user_id", buckets=8, spread_hot=True))
    return target.join(events.groupBy("user_id").agg(F.count("*").alias("n_events")))


@query(
    f"SELECT * FROM ({_OLD_ORDERS}) WHERE NOT coalesce(o_orderkey >= {START}, false) "
    f"UNION ALL SELECT * FROM ({_NEW_ORDERS}) WHERE o_orderkey >= {START}"
)
def replace_tail(spark, sf_dir):
    target = new_target(spark, "orders")
    target.replace_table(_old_orders(spark, sf_dir), "o_orderkey")
    tail = scans.from_key(_new_orders(spark, sf_dir), "o_orderkey", START)
    target.replace_tail(tail, "o_orderkey", START, ">=")
    return target.read()


@query(
    f"SELECT * FROM ({_OLD_ORDERS}) WHERE NOT coalesce(o_orderkey > {START}, false) "
    f"UNION ALL SELECT * FROM ({_NEW_ORDERS}) WHERE o_orderkey >= {START}"
)
def replace_tail_with_unequal_bounds(spark, sf_dir):
    target = new_target(spark, "orders")
    target.replace_table(_old_orders(spark, sf_dir), "o_orderkey")
    tail = scans.from_key(_new_orders(spark, sf_dir), "o_orderkey", START)
    target.replace_tail(tail, "o_orderkey", START, ">")
    return target.read()


@query(
    "SELECT o_orderkey, coalesce(CAST(nullif(o_orderkey % 10, 0) AS VARCHAR), 'none') AS k FROM orders "
    "WHERE NOT coalesce(nullif(o_orderkey % 10, 0) > 5, false) "
    "UNION ALL SELECT o_orderkey + 1000000000, CAST(o_orderkey % 10 AS VARCHAR) FROM orders WHERE o_orderkey % 10 > 5"
)
def replace_tail_keeps_null_keys(spark, sf_dir):
    target = new_target(spark, "orders")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(o_orderkey % 10, 0)").alias("k"))
    target.replace_table(rows, "k", Layout(("k",), "k"))
    newer = rows.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    target.replace_tail(scans.after_key(newer, "k", 5), "k", 5)
    return target.read().select("o_orderkey", shown("k"))


@query(
    "SELECT l_orderkey, coalesce(CAST(nullif(l_linenumber, 1) AS VARCHAR), 'none') AS k FROM lineitem "
    "WHERE NOT coalesce(nullif(l_linenumber, 1) > 4, false)"
)
def surviving_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.expr("nullif(l_linenumber, 1)").alias("k"))
    return lines.where(scans.survives("k", 4)).select("l_orderkey", shown("k"))


@query(
    f"SELECT * FROM ({_OLD_ORDERS}) WHERE o_orderkey <= {START} "
    f"UNION ALL SELECT * FROM ({_NEW_ORDERS}) WHERE o_orderkey > {START}"
)
def replaced_tail(spark, sf_dir):
    tail = scans.after_key(_new_orders(spark, sf_dir), "o_orderkey", START)
    return scans.replaced_tail(_old_orders(spark, sf_dir), tail, "o_orderkey", START)


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'none' FROM supplier"
)
def append_aligned(spark, sf_dir):
    target = new_target(spark, "parties")
    customers = table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("C_NAME"), F.col("s_suppkey").cast("string").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("C_AcctBal"),
    )
    kinds = {"c_custkey": "bigint", "c_name": "varchar(255)", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "varchar(255)"}
    target.append(customers, columns=[(name, T.DataType.fromDDL(kind)) for name, kind in kinds.items()])
    target.append(suppliers)
    return target.read().select("c_custkey", "c_name", "c_nationkey", "c_acctbal", shown("c_mktsegment"))


@query(
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'none' AS o_orderpriority, 'none' AS o_year "
    f"FROM orders WHERE o_orderkey < {START} "
    f"UNION ALL SELECT o_orderkey, o_custkey + 1000000000000, o_orderstatus, o_totalprice, o_orderpriority, "
    f"CAST(year(o_orderdate) AS VARCHAR) FROM orders WHERE o_orderkey >= {START}"
)
def append_new_column(spark, sf_dir):
    """A second load has two columns more, and keys that need a wider type; what was loaded before is not rewritten."""
    orders, target = table(spark, sf_dir, "orders"), new_target(spark, "orders")
    first = orders.where(f"o_orderkey < {START}").select("o_orderkey", F.col("o_custkey").cast("int"), "o_orderstatus", "o_totalprice")
    target.replace_table(first, "o_orderkey")
    before = target.state().segments
    more = orders.where(f"o_orderkey >= {START}").withColumn("o_custkey", F.col("o_custkey") + 1_000_000_000_000)
    more = more.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.year("o_orderdate").alias("o_year"))
    target.append(more, evolve=conform.target_schema(more))
    if target.state().segments[: len(before)] != before:
        raise AssertionError("old rows were written anew")
    return target.read().withColumns({name: shown(name) for name in ("o_orderpriority", "o_year")})


@query(
    f"SELECT c_custkey, left(repeat(c_name, 20), 100) AS name, c_mktsegment FROM customer WHERE c_custkey <= {START} "
    f"UNION ALL SELECT c_custkey, left(repeat(c_name, 20), 300), c_mktsegment FROM customer WHERE c_custkey > {START}"
)
def tail_with_wider_text(spark, sf_dir):
    """The text of a tail is cut at a width that the source declares by then."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.expr("repeat(c_name, 20)").alias("name"), "c_mktsegment")
    columns = conform.target_schema(customers, string_width=100)
    target = new_target(spark, "customer")
    target.replace_table(customers, "c_custkey", columns=columns)
    target.replace_tail(customers.where(f"c_custkey > {START}"), "c_custkey", START, evolve=conform.target_schema(customers, string_width=300))
    return target.read()


_CUTS = (90, 60, 40)


@query(
    " UNION ALL ".join(
        f"SELECT {share} AS share, count(*) AS n_live, true AS is_close FROM lineitem "
        f"WHERE l_orderkey <= (SELECT max(l_orderkey) * {share} // 100 FROM lineitem)"
        for share in _CUTS
    )
)
def live_rows(spark, sf_dir):
    """What is left of a segment as its tail is cut: exact, and whether the estimate is within 2 % of it."""
    lines, target = table(spark, sf_dir, "lineitem"), new_target(spark, "lineitem")
    high = target.replace_table(lines, "l_orderkey").high_key
    found = []
    for share in _CUTS:
        target.replace_tail(lines.limit(0), "l_orderkey", high * share // 100)
        exact, estimate = target.read().count(), target.live_rows().first()
        found.append((share, exact, estimate.is_cut and abs(estimate.n_live - exact) <= 0.02 * exact))
    return spark.createDataFrame(found, "share int, n_live bigint, is_close boolean")


_SEEN = ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) AS n_rows, count(*) - count(k) AS n_nulls, CAST(min(k) AS VARCHAR) AS low, "
        f"CAST(max(k) AS VARCHAR) AS high, true AS is_close, true AS exact FROM (SELECT nullif({name}, {unless}) AS k FROM lineitem)"
        for name, unless in zip(_SEEN, ("-1", "5", "2", "'R'"))
    )
)
def merged_statistics(spark, sf_dir):
    """Counts and ranges over three loads as each saw its rows while writing them; distinct values within 3 %."""
    missing = {"l_partkey": 5, "l_linenumber": 2, "l_returnflag": "R"}
    lines = table(spark, sf_dir, "lineitem").withColumns({n: F.nullif(F.col(n), F.lit(v)) for n, v in missing.items()})
    target = new_target(spark, "lineitem")
    for i in range(3):
        target.append(lines.where(f"l_orderkey % 3 = {i}"), "l_orderkey", analyze=list(_SEEN))
    exact = lines.agg(*(F.countDistinct(name).alias(name) for name in _SEEN)).first().asDict()
    known = F.element_at(F.create_map(*(F.lit(x) for item in exact.items() for x in item)), F.col("column"))
    close = F.abs(F.col("n_distinct") - known) <= 0.03 * known
    return target.merged_statistics().select("column", "n_rows", "n_nulls", "low", "high", close.alias("is_close"), "exact")


@query(
    "SELECT count(*) AS n_rows, CAST(min(l_orderkey) AS VARCHAR) AS low, CAST(max(l_orderkey) AS VARCHAR) AS high, "
    "CAST(sum(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_nulls FROM lineitem"
)
def table_statistics(spark, sf_dir):
    target = new_target(spark, "lineitem")
    target.replace_table(table(spark, sf_dir, "lineitem"), "l_orderkey", Layout(("l_orderkey",)))
    target.refresh_statistics()
    return target.statistics("l_orderkey").drop("segment")


# -- jobs ----------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def recreate_and_load(spark, sf_dir):
    tables, database = source(spark, sf_dir, "customer"), new_database(spark)
    jobs.recreate_tables(tables, database, "customer:c_acctbal,c_name,c_custkey:c_custkey:c_custkey")
    jobs.update_tables(tables, database, "customer:c_custkey,c_name,c_acctbal", keys=KEYS)
    return Target(spark, database, "customer").read()


@query(
    f"SELECT * REPLACE (o_custkey // 2 AS o_custkey) FROM orders WHERE o_orderkey < {START} "
    f"UNION ALL SELECT * FROM orders WHERE o_orderkey >= {START}"
)
def update_job(spark, sf_dir):
    columns = "SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, {}, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {{orders}}"
    before = derived(spark, sf_dir, orders=columns.format("o_custkey div 2 AS o_custkey"))
    after = derived(spark, sf_dir, orders=columns.format("o_custkey"))
    target = new_target(spark, "orders")
    target.recreate(conform.target_schema(table(spark, sf_dir, "orders")))
    jobs.update_tables(before, target.database, "orders", "orders:o_custkey:8", KEYS)
    jobs.update_tables(after, target.database, f"orders:*:{START}", "orders:o_custkey:8", KEYS)
    return target.read()


@query(
    "SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS price, "
    "'[' || l_partkey || ',' || l_suppkey || ']' AS keys FROM lineitem"
)
def copy_job(spark, sf_dir):
    tables = derived(
        spark,
        sf_dir,
        lineitem="SELECT *, CAST(l_extendedprice AS DECIMAL(15,2)) AS price, array(l_partkey, l_suppkey) AS keys FROM {lineitem}",
    )
    database = new_database(spark)
    jobs.copy_tables(tables, database, "lineitem", KEYS)
    return Target(spark, database, "lineitem").read()


@query(
    f"SELECT * REPLACE (o_custkey // 2 AS o_custkey) FROM orders WHERE o_orderkey <= {START} "
    f"UNION ALL SELECT * FROM orders WHERE o_orderkey > {START}"
)
def copy_job_above_bookmark(spark, sf_dir):
    halved = "SELECT o_orderkey, o_custkey div 2 AS o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM {orders}"
    before, after = derived(spark, sf_dir, orders=halved), source(spark, sf_dir, "orders")
    database = new_database(spark)
    jobs.copy_tables(before, database, "orders", KEYS)
    jobs.copy_tables(after, database, f"orders:{START}", KEYS)
    return Target(spark, database, "orders").read()


@query("SELECT * FROM orders WHERE o_orderkey > 0")
def copy_positive_keys(spark, sf_dir):
    database = new_database(spark)
    jobs.copy_tables(source(spark, sf_dir, "orders"), database, "orders:0", KEYS, positive_keys_only=True)
    return Target(spark, database, "orders").read()


@query(
    f"""
    SELECT 'orders' AS table_name, 'ok' AS status, count(*) AS n_rows, max(o_orderkey) AS high_key
    FROM orders WHERE o_orderkey > {START}
    UNION ALL SELECT 'customer', 'ok', count(*), max(c_custkey) FROM customer WHERE c_custkey > 10
    UNION ALL SELECT 'lineitem', 'ok', count(*), max(l_orderkey) FROM lineitem
    """
)
def load_report(spark, sf_dir):
    tables = source(spark, sf_dir, "orders", "customer", "lineitem")
    report = jobs.copy_tables(tables, new_database(spark), f"orders:{START},customer:10,lineitem", KEYS)
    return report.select("table_name", "status", "n_rows", "high_key")


@query(
    """
    SELECT 'orders' AS table_name, 'ok' AS status, CAST(count(*) AS VARCHAR) AS n_rows FROM orders
    UNION ALL SELECT 'missing_table', 'failed', 'none'
    UNION ALL SELECT 'lineitem', 'failed', 'none'
    UNION ALL SELECT 'customer', 'ok', CAST(count(*) AS VARCHAR) FROM customer
    """
)
def isolated_failures(spark, sf_dir):
    tables = source(spark, sf_dir, "orders", "customer", "lineitem")
    keys = {**KEYS, "lineitem": "no_such_key"}
    listed = "orders,missing_table,lineitem:5,customer"
    report = jobs.copy_tables(tables, new_database(spark), listed, keys, raise_on_failure=False)
    return report.select("table_name", "status", shown("n_rows"))


@query(
    "SELECT c_custkey, c_name, c_mktsegment, c_acctbal > 0 AS in_credit FROM customer"
)
def field_selection_job(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("in_credit", F.col("c_acctbal") > 0)
    target = new_target(spark, "customers")
    fields = ["c_custkey", "c_name", "c_mktsegment", "in_credit", "deleted_at"]
    kinds = [T.DecimalType(18, 0), T.VarcharType(256), T.VarcharType(256), T.BooleanType()]
    jobs.append_then_select(customers, customers, fields, target, selected_columns=list(zip(fields, kinds)))
    return target.read().withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("SELECT * FROM orders")
def resume_from_bookmark(spark, sf_dir):
    before = derived(spark, sf_dir, orders=f"SELECT * FROM {{orders}} WHERE o_orderkey <= {START}")
    now = source(spark, sf_dir, "orders")
    database = new_database(spark)
    jobs.copy_tables(before, database, "orders", KEYS)
    jobs.copy_tables(now, database, "orders", KEYS, resume=True)
    jobs.copy_tables(now, database, "orders", KEYS, resume=True)
    return Target(spark, database, "orders").read()


@query(
    f"SELECT 'customer' AS table_name, 'ok' AS status, CAST(count(*) AS VARCHAR) AS n_rows, count(*) AS n_there FROM customer "
    f"UNION ALL SELECT 'orders', 'failed', 'none', 0 "
    f"UNION ALL SELECT 'lineitem', 'not published', 'none', 0 "
    f"UNION ALL SELECT 'part', 'not published', 'none', 0"
)
def update_job_stops(spark, sf_dir):
    """Tables that are loaded side by side; the second in the list fails, so those after it are not published."""
    broken = "SELECT *, CASE WHEN o_orderkey = 77 THEN CAST(raise_error('broken') AS INT) ELSE 0 END AS flaw FROM {orders}"
    names = ("customer", "orders", "lineitem", "part")
    whole = {name: f"SELECT * FROM {{{name}}}" for name in names}
    tables, database = derived(spark, sf_dir, **{**whole, "orders": broken}), new_database(spark)
    jobs.recreate_tables(tables, database, ";".join(names))
    report = jobs.update_tables(tables, database, ";".join(names), keys=KEYS, raise_on_failure=False)
    there = [(name, Target(spark, database, name).read().count()) for name in names]
    counts = spark.createDataFrame(there, "table_name string, n_there bigint")
    return report.join(counts, "table_name").select("table_name", "status", shown("n_rows"), "n_there")


@query(
    """
    SELECT 'orders' AS table_name, 'ok' AS status, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_ok, CAST(0 AS BIGINT) AS n_failed FROM orders
    UNION ALL SELECT 'customer', 'ok', count(*), 1, 1 FROM customer
    UNION ALL SELECT 'lineitem', 'ok', count(*), 1, 0 FROM lineitem
    """
)
def restarted_copy(spark, sf_dir):
    """A run that failed for one table and was started again: only that table is copied twice, and the ledger says so."""
    names, database = ("orders", "customer", "lineitem"), new_database(spark)
    flaw = "SELECT *, CASE WHEN c_custkey = 77 THEN CAST(raise_error('broken') AS INT) ELSE 0 END AS flaw FROM {customer}"
    whole = {name: f"SELECT * FROM {{{name}}}" for name in names}
    for definitions in ({**whole, "customer": flaw}, whole):
        tables = derived(spark, sf_dir, **definitions)
        report = jobs.copy_tables(tables, database, ",".join(names), KEYS, raise_on_failure=False, run="nightly")
    times = [F.count_if(F.col("status") == status).alias(f"n_{status}") for status in ("ok", "failed")]
    ended = Ledger(spark, database).rows("nightly").groupBy("table_name").agg(*times)
    return report.join(ended, "table_name").select("table_name", "status", "n_rows", "n_ok", "n_failed")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def copy_wide_text(spark, sf_dir):
    database = new_database(spark)
    jobs.copy_tables(source(spark, sf_dir, "documents"), database, "documents", "doc_id", string_width=1 << 20)
    return Target(spark, database, "documents").read()


@query("SELECT 'ok' AS status, count(*) AS n_rows, count(*) FILTER (WHERE strlen(text) > 255) AS n_cut FROM documents")
def copy_counts_cut_text(spark, sf_dir):
    report = jobs.copy_tables(source(spark, sf_dir, "documents"), new_database(spark), "documents", "doc_id")
    return report.select("status", "n_rows", "n_cut")


_WIDE = "repeat(text || 'é', CAST(140000 // (strlen(text) + 2) + 1 AS BIGINT))"


@query(
    f"""
    WITH wide AS (SELECT doc_id, hex(encode({_WIDE})) AS h FROM documents),
    bounded AS (
        SELECT doc_id, h, list_max(list_filter([65532, 65533, 65534, 65535],
            lambda n: substr(h, 2 * n + 1, 1) NOT IN ('8', '9', 'A', 'B'))) AS n_bytes FROM wide
    ), cut AS (SELECT doc_id, n_bytes, decode(from_hex(substr(h, 1, 2 * n_bytes))) AS w FROM bounded)
    SELECT doc_id, length(w) AS n_chars, CAST(n_bytes AS BIGINT) AS n_bytes, md5(w) AS digest FROM cut
    """
)
def truncate_to_widest(spark, sf_dir):
    """Each text, repeated with a two-byte character until it is twice too long, cut to 65,535 bytes."""
    docs = table(spark, sf_dir, "documents")
    wide = F.expr("repeat(concat(text, 'é'), CAST(140000 div (octet_length(text) + 2) + 1 AS INT))")
    cut = docs.select("doc_id", truncate_utf8(wide, 65535).alias("w"))
    sizes = [F.char_length("w").cast("bigint").alias("n_chars"), F.octet_length("w").cast("bigint").alias("n_bytes")]
    return cut.select("doc_id", *sizes, F.md5(F.col("w").cast("binary")).alias("digest"))


@query("SELECT * FROM orders")
def resume_after_high_bound(spark, sf_dir):
    """A bookmark above all keys reads nothing, and the next resumed copy starts from the beginning."""
    database, tables = new_database(spark), source(spark, sf_dir, "orders")
    jobs.copy_tables(tables, database, f"orders:{10**12}", KEYS)
    jobs.copy_tables(tables, database, "orders", KEYS, resume=True)
    return Target(spark, database, "orders").read()


@query(
    "SELECT count(*) AS first_rows, CAST(0 AS BIGINT) AS second_rows, max(o_orderkey) AS high_key FROM orders"
)
def resume_unsigned_keys(spark, sf_dir):
    unsigned = "SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, o_totalprice FROM {orders}"
    tables, database = derived(spark, sf_dir, orders=unsigned), new_database(spark)
    first = jobs.copy_tables(tables, database, "orders", KEYS).first()
    second = jobs.copy_tables(tables, database, "orders", KEYS, resume=True)
    return second.select(F.lit(first.n_rows).alias("first_rows"), F.col("n_rows").alias("second_rows"), "high_key")


@query("SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders")
def explicit_zero_copies_whole(spark, sf_dir):
    tables, database = source(spark, sf_dir, "orders"), new_database(spark)
    jobs.copy_tables(tables, database, "orders", KEYS)
    return jobs.copy_tables(tables, database, "orders:0", KEYS, resume=True).select("table_name", "n_rows")


@query("SELECT *, CAST(CAST(o_totalprice AS DECIMAL(38,2)) AS VARCHAR) AS price FROM orders")
def copy_clamped_decimals(spark, sf_dir):
    exact = "SELECT *, CAST(o_totalprice AS DECIMAL(38,2)) AS price FROM {orders}"
    tables, database = derived(spark, sf_dir, orders=exact), new_database(spark)
    jobs.copy_tables(tables, database, "orders", KEYS, decimals="clamp")
    return Target(spark, database, "orders").read().withColumn("price", F.col("price").cast("string"))


@query(
    "SELECT * FROM (VALUES (0, 'c_custkey', 'bigint', 0), (1, 'c_name', 'varchar(255)', 0)) AS t(position, \"column\", type, n_rows)"
)
def recreated_columns(spark, sf_dir):
    tables, database = source(spark, sf_dir, "customer"), new_database(spark)
    jobs.recreate_tables(tables, database, "customer:c_custkey,c_name")
    target = Target(spark, database, "customer")
    rows = [(i, name, kind.simpleString(), target.read().count()) for i, (name, kind) in enumerate(target.columns())]
    return spark.createDataFrame(rows, "position int, column string, type string, n_rows int")


@query(
    "SELECT 'orders' AS table_name, max(o_orderkey) AS high_key FROM orders "
    "UNION ALL SELECT 'part', max(p_partkey) FROM part"
)
def stored_bookmarks(spark, sf_dir):
    database = new_database(spark)
    jobs.copy_tables(source(spark, sf_dir, "orders", "part"), database, "orders,part", KEYS)
    return bookmarks(spark, database)


@query(f"{_EVENTS_SQL} WHERE event_id % 10 <> 3")
def resume_from_files(spark, sf_dir):
    """Two arrivals of files with one broken line in ten, and a run that finds nothing new."""
    target, events = new_target(spark, "events"), table(spark, sf_dir, "events")
    folder = f"{shared_folder(spark)}/{target.database}_files"
    for arrived in (F.col("event_id") < START, F.col("event_id") >= START, F.lit(False)):
        _write_events(events.where(arrived), folder, broken=True)
        jobs.load_files(target, folder, _EVENTS, "event_id", max_errors=1 << 62)
    if target.rejects().count() != events.where("event_id % 10 = 3").count():
        raise AssertionError("a broken line is no reject")
    return _with_micros(target.read())


@query(_EVENTS_SQL)
def manifest_load(spark, sf_dir):
    """Three arrivals, each load repeated, then a loaded file that has grown: refused by its name, and nothing loaded."""
    target, events = new_target(spark, "events"), table(spark, sf_dir, "events")
    folder = f"{shared_folder(spark)}/{target.database}_files"
    for i in range(3):
        _write_events(events.where(f"event_id % 3 = {i}"), folder)
        new, none = (jobs.load_files(target, folder, _EVENTS, "event_id").first() for _ in range(2))
        if (new.n_rows, none.n_rows, none.n_files) != (events.where(f"event_id % 3 = {i}").count(), 0, 0):
            raise AssertionError(f"loaded {new}, then {none}")
    grown = target.files().orderBy("path").first().path
    _grow(spark, grown)
    try:
        jobs.load_files(target, folder, _EVENTS, "event_id")
    except ChangedFiles as error:
        if error.paths != [grown]:
            raise
        return _with_micros(target.read())
    raise AssertionError("a file that has grown was not refused")


def _grow(spark: SparkSession, path: str) -> None:
    """Add a line to a file, through the file system that holds the shared folder."""
    from pyarrow import fs

    uri = urlparse(path)
    system, inside = (fs.LocalFileSystem(), unquote(uri.path)) if uri.scheme in ("", "file") else fs.FileSystem.from_uri(path)
    with system.open_input_file(inside) as file:
        data = file.read()
    with system.open_output_stream(inside) as file:
        file.write(data + b'{"event_id": -1}\n')


@query(_STATES_SQL)
def manifest_rejects(spark, sf_dir):
    """Files with one broken line in ten: the others are loaded, these are rejects with a reason."""
    target = new_target(spark, "events")
    report = jobs.load_files(target, _events_as_json(spark, sf_dir, broken=True), _EVENTS, "event_id", max_errors=1 << 62)
    rejects = target.rejects().where("exists(reasons, r -> r.wanted = 'record')")
    if report.first().n_rejects != rejects.count():
        raise AssertionError("counted other rejects than there are")
    return _states(target.read(), rejects)


# -- contract ------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Bounded scan, unsigned-long conversion, staged replace, read back."""
    tables = derived(
        spark,
        "/root/testdata/sf0.001",
        orders="SELECT CAST(o_orderkey AS DECIMAL(20,0)) AS o_orderkey, o_totalprice FROM {orders}",
    )
    frame = scans.scan(tables.read("orders"), ["o_orderkey", "o_totalprice"], "o_orderkey", START)
    target = new_target(spark, "orders")
    target.replace_table(conform.unsigned_longs_to_long(frame), "o_orderkey", Layout(("o_orderkey",)))
    return target.read()


# The text operators are optional: without their files, or what they import, the other queries stay.
try:
    import corpus_pipeline  # noqa: F401
    from tidemark.llm import queries as text_queries
except ImportError as error:
    if not isinstance(error, ModuleNotFoundError) or error.name not in ("corpus_pipeline", "tidemark.llm"):
        warnings.warn(f"the text operators cannot be loaded: {error}", stacklevel=1)
    text_queries = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | {name: _shipped(run) for name, run in (text_queries.queries() if text_queries else {}).items()}


def _shipped(run):
    """A query whose functions run in Python workers."""

    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    return call


def oracle_sql() -> dict[str, str]:
    return _ORACLES | (text_queries.oracle_sql() if text_queries else {})
