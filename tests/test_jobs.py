"""Jobs over several tables."""

import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.targets import Loaded, Target, TooManyRejects
from tidemark.plans import jobs
from tidemark.plans.ledger import Ledger
from tidemark.sources.catalog import CatalogSource
from tidemark.workspace import new_database, shared_folder


@pytest.fixture
def tables(spark):
    """``raw_orders`` and ``raw_parts`` with keys 0..n, an unsigned long, text and a nested column."""
    name = new_database(spark, "source")
    for table, count in (("orders", 100), ("parts", 10)):
        frame = spark.range(count).selectExpr(
            "id", "cast(id as decimal(20,0)) as u", "cast(id / 4 as decimal(9,2)) as price", "repeat('é', 200) as note",
            "array(id) as list", "id % 3 as g",
        )
        frame.write.saveAsTable(f"{name}.raw_{table}")
    return CatalogSource(spark, name, "raw_")


def types_of(target):
    return [(name, kind.simpleString()) for name, kind in target.columns()]


def test_recreate_tables(spark, tables, database):
    report = jobs.recreate_tables(tables, database, "orders:note,id,user_id,i:id:id;parts")
    assert [(r.table_name, r.status, r.n_rows) for r in report.collect()] == [("orders", "ok", 0), ("parts", "ok", 0)]
    assert types_of(Target(spark, database, "orders")) == [("id", "bigint"), ("note", "varchar(255)")]
    assert types_of(Target(spark, database, "parts")) == [
        ("id", "bigint"), ("u", "decimal(20,0)"), ("price", "decimal(9,2)"), ("note", "varchar(255)"),
        ("list", "varchar(65535)"), ("g", "bigint"),
    ]
    assert Target(spark, database, "orders").read().count() == 0
    spark.sql(f"CREATE TABLE {tables.identifier('declared')} (a varchar(40), b string, c smallint, `d.e` date) USING parquet")
    jobs.recreate_tables(tables, database, "declared:d.e,c,a,b")
    assert types_of(Target(spark, database, "declared")) == [
        ("a", "varchar(65535)"), ("b", "varchar(255)"), ("c", "varchar(65535)"), ("d.e", "date"),
    ]
    with pytest.raises(PySparkException):
        jobs.recreate_tables(tables, database, "missing;orders")


def test_update_tables_whole_and_from_key(spark, tables, database):
    jobs.recreate_tables(tables, database, "orders;parts")
    whole = jobs.update_tables(tables, database, "orders:*;parts:id,note")
    assert [(r.n_rows, r.high_key) for r in whole.collect()] == [(100, 99), (10, 9)]
    parts = Target(spark, database, "parts").read()
    assert {len(r.note.encode()) for r in parts.collect()} == {254}
    assert parts.where("u is null and note is not null").count() == 10
    orders = Target(spark, database, "orders")
    for start, op, rows in ((40, ">=", 100), (0, ">=", 100), (-4, ">=", 100), (40, ">", 101), (40, ">", 102), (40, ">=", 100)):
        report = jobs.update_tables(tables, database, f"orders::{start}", "orders:g:4;orders:id:1", delete_op=op)
        assert report.first().n_rows == (60 if start > 0 else 100)
        assert orders.read().count() == rows, (start, op)


def test_update_stops_at_the_first_error(spark, tables, database):
    jobs.recreate_tables(tables, database, "orders;parts")
    target = Target(spark, database, "orders")
    target.recreate([("id", T.ShortType()), ("note", T.IntegerType())])
    with pytest.raises(TooManyRejects):
        jobs.update_tables(tables, database, "orders:id,note;parts")
    assert Target(spark, database, "parts").read().count() == 0


def test_copy_tables_reports_and_isolates(spark, tables, database):
    with pytest.raises(jobs.CopyFailed, match="missing") as failed:
        jobs.copy_tables(tables, database, "orders:20,missing,parts")
    report = {row.table_name: row for row in failed.value.report.collect()}
    assert report["missing"].error == "the source has no table missing"
    assert (report["orders"].n_rows, report["orders"].high_key) == (79, 99)
    assert (report["parts"].n_rows, report["parts"].as_text) == (10, ["list"])
    assert types_of(Target(spark, database, "parts")) == [
        ("id", "bigint"), ("u", "double"), ("price", "double"), ("note", "varchar(255)"), ("list", "varchar(65535)"),
        ("g", "bigint"),
    ]


def test_copy_with_bookmark_replaces_above_it(spark, tables, database):
    jobs.copy_tables(tables, database, "orders")
    orders = Target(spark, database, "orders")
    assert orders.read().count() == 100
    for _ in range(2):
        jobs.copy_tables(tables, database, "orders:90")
        assert orders.read().count() == 100
        assert orders.read().select("id").distinct().count() == 100


def test_positive_keys_only(spark, tables, database):
    jobs.copy_tables(tables, database, "parts", positive_keys_only=True)
    assert Target(spark, database, "parts").read().agg(F.min("id")).first()[0] == 1


def test_resume(spark, tables, database):
    jobs.copy_tables(tables, database, "parts")
    first = Target(spark, database, "parts").state().segments
    report = jobs.copy_tables(tables, database, "parts", resume=True)
    assert (report.first().n_rows, report.first().high_key) == (0, 9)
    assert Target(spark, database, "parts").state().segments == first
    spark.table(tables.identifier("parts")).withColumn("id", F.col("id") + 5).write.insertInto(tables.identifier("parts"))
    assert jobs.copy_tables(tables, database, "parts", resume=True).first().n_rows == 5
    assert Target(spark, database, "parts").read().count() == 15


def test_names_that_differ_in_case_are_one_table(spark, tables, database):
    report = jobs.copy_tables(tables, database, "orders,parts,ORDERS:50")
    assert [(r.table_name, r.n_rows) for r in report.collect()] == [("orders", 49), ("parts", 10)]


def test_resume_starts_at_what_was_read(spark, tables, database):
    jobs.copy_tables(tables, database, "orders:5000", raise_on_failure=False)
    assert jobs.copy_tables(tables, database, "orders", resume=True).first().n_rows == 100
    assert jobs.copy_tables(tables, database, "orders:0", resume=True).first().n_rows == 100
    assert jobs.copy_tables(tables, database, "orders", resume=True).first().n_rows == 0


def test_keys_are_whole_numbers(spark, tables, database):
    assert jobs.copy_tables(tables, database, "orders", "u").first().high_key == 99
    with pytest.raises(jobs.CopyFailed):
        jobs.copy_tables(tables, database, "orders", "price")


def test_update_of_a_plain_target_does_not_shuffle(spark, tables, database, monkeypatch):
    jobs.recreate_tables(tables, database, "orders")
    plans = []
    write = Target._write

    def seen(self, frame, *args, **options):
        plans.append((frame._jdf.queryExecution().executedPlan().toString(), options.get("parts")))
        return write(self, frame, *args, **options)

    monkeypatch.setattr(Target, "_write", seen)
    jobs.update_tables(tables, database, "orders::10", "orders:g:4")
    assert "Exchange" not in plans[0][0] and plans[0][1] is None


def test_declared_widths_are_kept(spark, tables, database):
    spark.sql(f"CREATE TABLE {tables.identifier('declared')} (id bigint, a varchar(1000), b string) USING parquet")
    spark.sql(f"INSERT INTO {tables.identifier('declared')} VALUES (1, repeat('a', 1000), repeat('b', 600))")
    report = jobs.copy_tables(tables, database, "declared").first()
    assert report.n_cut == 1
    assert types_of(Target(spark, database, "declared")) == [("id", "bigint"), ("a", "varchar(1000)"), ("b", "varchar(255)")]
    assert jobs.copy_tables(tables, database, "declared", string_width=600).first().n_cut == 0


def test_selected_fields_replace_what_was_appended(spark, tables, database):
    target = Target(spark, database, "users")
    frame = tables.read("parts").drop("list", "price")
    kinds = [("id", T.DecimalType(18, 0)), ("note", T.VarcharType(3))]
    first, second = jobs.append_then_select(frame, frame, ["id", "gone", "note"], target, selected_columns=kinds)
    assert (first.n_rows, second.n_rows) == (10, 10)
    assert types_of(target) == [("id", "decimal(18,0)"), ("note", "varchar(3)")]
    assert {row.note for row in target.read().collect()} == {"é"}


def test_workspace_is_the_clusters_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


class Settings:
    """The settings of a session that names no shared folder."""

    def __init__(self, master):
        self.conf = {"spark.master": master}


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Settings("yarn"))
    assert "tidemark-" in shared_folder(Settings("local[2]"))


# -- several tables at a time ----------------------------------------------------------------------------


class Waiting:
    """A load that takes a while, and says what becomes of it."""

    def __init__(self, log, name):
        self.log, self.name = log, name

    def publish(self):
        self.log.append(("published", self.name))
        return Loaded(1, 0, None)

    def discard(self):
        self.log.append(("discarded", self.name))


def test_tables_are_loaded_side_by_side_and_published_in_order(spark):
    log, names = [], [f"t{i}" for i in range(10)]

    def prepare(i):
        time.sleep(0.5 if i % 3 else 0.3)
        return Waiting(log, names[i])

    started = time.monotonic()
    report, error = jobs._side_by_side(spark, names, prepare, 4)
    assert time.monotonic() - started <= 0.5 * (4 * 0.3 + 6 * 0.5)
    assert error is None and [r[0] for r in report] == names
    assert log == [("published", name) for name in names]


def test_the_first_error_in_the_list_stops_the_rest(spark):
    log, names, running = [], ["a", "b", "c", "d", "e", "f"], threading.Event()

    def prepare(i):
        if names[i] == "b":
            running.wait(20)
            raise ValueError("b is broken")
        if names[i] == "c":
            running.set()  # a long Spark job, which is interrupted
            spark.range(4).repartition(4).select(F.expr("java_method('java.lang.Thread', 'sleep', 60000L)")).write.format("noop").mode("overwrite").save()
        return Waiting(log, names[i])

    started = time.monotonic()
    report, error = jobs._side_by_side(spark, names, prepare, 4)
    assert time.monotonic() - started < 30
    assert str(error) == "b is broken"
    assert [(r[0], r[1]) for r in report] == [("a", "ok"), ("b", "failed")] + [(n, "not published") for n in "cdef"]
    assert [name for what, name in log if what == "published"] == ["a"]


def test_a_table_that_is_listed_twice_is_loaded_in_turn(spark, tables, database):
    jobs.recreate_tables(tables, database, "orders;parts;ORDERS:id")
    assert types_of(Target(spark, database, "orders")) == [("id", "bigint")]
    jobs.recreate_tables(tables, database, "orders:id,g")
    report = jobs.update_tables(tables, database, "orders:id,g;orders:id:50;orders:id:90")
    assert [r.n_rows for r in report.collect()] == [100, 50, 10]
    orders = Target(spark, database, "orders").read()
    assert orders.count() == 100 and orders.where("g IS NULL").count() == 50


def test_stopped_updates_leave_nothing(spark, tables, database):
    jobs.recreate_tables(tables, database, "orders;parts")
    Target(spark, database, "orders").recreate([("id", T.ShortType()), ("note", T.IntegerType())])
    before = Target(spark, database, "parts")._segment_tables()
    report = jobs.update_tables(tables, database, "orders:id,note;parts", raise_on_failure=False)
    assert [(r.table_name, r.status) for r in report.collect()] == [("orders", "failed"), ("parts", "not published")]
    assert Target(spark, database, "parts")._segment_tables() == before


# -- ledger ----------------------------------------------------------------------------------------------


def test_a_restarted_run_takes_what_did_not_end_well(spark, tables, database):
    for _ in range(2):
        with pytest.raises(jobs.CopyFailed):
            jobs.copy_tables(tables, database, "orders:20,missing,parts", run="one")
    rows = Ledger(spark, database).rows("one").collect()
    assert sorted((r.table_name, r.status) for r in rows) == [("missing", "failed"), ("missing", "failed"), ("orders", "ok"), ("parts", "ok")]
    assert all(r.at is not None for r in rows)
    spark.range(3).write.saveAsTable(tables.identifier("missing"))
    report = {r.table_name: r for r in jobs.copy_tables(tables, database, "orders:20,missing,parts", run="one").collect()}
    assert (report["orders"].n_rows, report["parts"].as_text, report["missing"].n_rows) == (79, ["list"], 3)
    assert {r.table_name: r.status for r in Ledger(spark, database).last("one").collect()} == dict.fromkeys(["orders", "parts", "missing"], "ok")
    # another run copies all of them
    jobs.copy_tables(tables, database, "orders,parts", run="two")
    assert Ledger(spark, database).rows("two").count() == 2 and Ledger(spark, database).rows().count() == 7


def test_rows_are_there_when_a_table_has_ended(spark, tables, database, monkeypatch):
    """A run that is lost as a whole has the rows of the tables that had ended."""
    copy = jobs.copy_table

    def lost(source, database, name, *args, **options):
        if name == "parts":
            raise KeyboardInterrupt
        return copy(source, database, name, *args, **options)

    monkeypatch.setattr(jobs, "copy_table", lost)
    with pytest.raises(KeyboardInterrupt):
        jobs.copy_tables(tables, database, "orders,parts", run="one", max_concurrent=1)
    assert [(r.table_name, r.status) for r in Ledger(spark, database).rows("one").collect()] == [("orders", "ok")]


def test_another_table_is_no_ledger(spark, tables, database):
    spark.range(1).write.saveAsTable(f"`{database}`.`tidemark_runs`")
    with pytest.raises(ValueError, match="is not a ledger"):
        jobs.copy_tables(tables, database, "orders", run="one")


def test_new_source_columns_are_copied(spark, tables, database):
    name = tables.identifier("grows")
    spark.range(10).select(F.col("id").cast("int"), F.lit("abc").alias("note")).write.saveAsTable(name)
    jobs.copy_tables(tables, database, "grows")
    base = Target(spark, database, "grows").state().segments[0]
    spark.range(20).select("id", F.lit("abc").alias("note"), F.lit(1.5).alias("price")).write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    report = jobs.copy_tables(tables, database, "grows", resume=True).first()
    target = Target(spark, database, "grows")
    assert (report.n_rows, types_of(target)) == (10, [("id", "bigint"), ("note", "varchar(255)"), ("price", "double")])
    assert target.state().segments[0].table == base.table
    assert target.read().where("price IS NULL").count() == 10 and target.read().count() == 20
