"""Published targets: equal results by different ways, failures, bounds, layout, cleaning up."""

import json
import random

import pytest
from pyspark import TaskContext
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import segments as parts_of
from tidemark.operators import sketches, skew, targets
from tidemark.operators.layout import Layout, bucket_count, by_ranges, estimated_bytes, spread_by_key
from tidemark.operators.partitions import Parts
from tidemark.operators.segments import Segment, State
from tidemark.operators.targets import OWNER, Target, TooManyRejects, bookmarks, published
from tidemark.sources.catalog import table_columns, target_columns


def numbered(spark, low, high, tag="a"):
    return spark.range(low, high).select(F.col("id"), F.lit(tag).alias("tag"))


def rows(target):
    return sorted(map(tuple, target.read().collect()), key=repr)


def segments(target):
    return target._segment_tables()


@pytest.fixture
def target(spark, database):
    return Target(spark, database, "numbers")


def test_tail_replaced_twice_is_as_once(spark, target):
    target.replace_table(numbered(spark, 0, 100), "id")
    for _ in range(3):
        loaded = target.replace_tail(numbered(spark, 51, 120, "b"), "id", 50)
        assert (loaded.n_rows, loaded.high_key) == (69, 119)
    assert rows(target) == sorted(
        [(i, "a") for i in range(51)] + [(i, "b") for i in range(51, 120)], key=repr
    )
    assert len(target.state().segments) == 2


def test_unequal_bounds_repeat_the_boundary_row(spark, target):
    target.replace_table(numbered(spark, 0, 10), "id")
    target.replace_tail(numbered(spark, 5, 10, "b"), "id", 5, ">")
    assert [row for row in rows(target) if row[0] == 5] == [(5, "a"), (5, "b")]
    target.replace_tail(numbered(spark, 5, 10, "c"), "id", 5, ">=")
    assert rows(target) == [(i, "a") for i in range(5)] + [(i, "c") for i in range(5, 10)]


def test_full_load_is_a_tail_load_from_below(spark, database):
    whole, tail = Target(spark, database, "whole"), Target(spark, database, "tail")
    whole.replace_table(numbered(spark, 0, 50), "id")
    tail.replace_table(numbered(spark, 0, 30, "old"), "id")
    tail.replace_tail(numbered(spark, 0, 50), "id", -1)
    assert rows(whole) == rows(tail)
    assert len(tail.state().segments) == 1


def test_rows_without_key_stay(spark, target):
    data = spark.createDataFrame([(None, "n"), (1, "a"), (9, "a")], "id bigint, tag string")
    target.replace_table(data, "id")
    for _ in range(2):
        target.replace_tail(numbered(spark, 5, 6, "b"), "id", 0)
    assert rows(target) == [(5, "b"), (None, "n")]
    target.replace_tail(data, "id", 5)
    assert rows(target) == [(1, "a"), (5, "b"), (9, "a"), (None, "n"), (None, "n")]


def test_deepening_and_rising_bounds(spark, target):
    target.replace_table(numbered(spark, 0, 100), "id")
    model = {i: "a" for i in range(100)}
    for step, (start, high) in enumerate([(80, 110), (90, 95), (20, 40), (30, 130), (20, 25), (-5, 3)]):
        target.replace_tail(numbered(spark, start + 1, high, str(step)), "id", start)
        model = {k: v for k, v in model.items() if k <= start} | {k: str(step) for k in range(start + 1, high)}
        assert rows(target) == sorted(model.items(), key=repr)


def test_empty_loads(spark, target):
    empty = numbered(spark, 0, 0)
    assert target.replace_table(empty, "id").high_key is None
    assert rows(target) == []
    assert target.replace_tail(empty, "id", 5).high_key is None
    target.append(numbered(spark, 0, 3))
    target.append(empty)
    assert len(target.state().segments) == 1
    assert rows(target) == [(0, "a"), (1, "a"), (2, "a")]
    target.replace_tail(empty, "id", -1)
    assert rows(target) == [] and target.read().columns == ["id", "tag"]


def test_folding_keeps_the_rows(spark, target, monkeypatch):
    monkeypatch.setattr(targets, "MAX_SEGMENTS", 4)
    target.replace_table(numbered(spark, -1000, 10), "id", Layout(("id",), "id", 2))
    base = target.state().segments[0].table
    for step in range(1, 9):
        target.replace_tail(numbered(spark, 10 * step, 10 * step + 10, str(step)), "id", 10 * step - 1)
        assert len(target.state().segments) <= 4
    target.replace_tail(numbered(spark, 46, 49, "x"), "id", 45)
    assert target.state().segments[0].table == base
    tags = {i: str(i // 10) if i >= 10 else "a" for i in range(-1000, 46)} | dict.fromkeys([46, 47, 48], "x")
    assert rows(target) == sorted(tags.items(), key=repr)


def test_what_is_merged():
    assert parts_of.merge_start([1000, 10, 10, 10]) == 1
    assert parts_of.merge_start([20, 10, 10, 10]) == 0
    assert parts_of.merge_start([None, 10, 10]) == 1
    assert parts_of.merge_start([1000, 100, 10, 1]) == 2
    assert parts_of.merge_start([5, None]) == 0


def test_failed_load_leaves_the_target(spark, target):
    target.replace_table(numbered(spark, 0, 10), "id")
    before, tables = rows(target), segments(target)
    broken = numbered(spark, 0, 20).withColumn("tag", F.when(F.col("id") == 19, F.raise_error(F.lit("boom"))).otherwise("x"))
    for load in (
        lambda: target.replace_rows(broken, "id"),
        lambda: target.replace_table(broken, "id"),
        lambda: target.replace_tail(broken, "id", 3),
        lambda: target.append(broken),
    ):
        with pytest.raises(PySparkException, match="boom"):
            load()
        assert rows(target) == before and segments(target) == tables


def test_reject_limit(spark, target):
    target.recreate([("id", T.IntegerType()), ("tag", T.VarcharType(3))])
    data = spark.createDataFrame([("1", "abcd"), ("x", "b"), (None, "c"), ("99999999999", "d")], "id string, tag string")
    for limit in (1, 2):
        with pytest.raises(TooManyRejects, match=f"2 rows do not fit .*, limit {limit}"):
            target.replace_rows(data, "id", max_errors=limit)
    assert rows(target) == []
    loaded = target.replace_rows(data, "id", max_errors=3)
    assert (loaded.n_rows, loaded.n_rejects, loaded.high_key) == (2, 2, 1)
    assert rows(target) == [(1, "abc"), (None, "c")]
    kept = sorted(row.record for row in target.rejects().collect())
    assert kept == ['{"id":"99999999999","tag":"d"}', '{"id":"x","tag":"b"}']
    assert len({row.segment for row in target.rejects().collect()}) == 1
    target.drop()
    assert target.rejects().count() == 0


def test_counts_survive_failed_tasks(spark, target):
    def flaky(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")

    data = numbered(spark, 0, 1000).repartition(4).mapInPandas(flaky, "id bigint, tag string")
    for layout in (Layout(), Layout(("id",), "id", 3)):
        loaded = target.replace_table(data, "id", layout)
        assert (loaded.n_rows, loaded.high_key) == (1000, 999)
        assert target.read().count() == 1000


def test_a_target_can_feed_its_own_load(spark, target):
    target.replace_table(numbered(spark, 0, 10), "id")
    target.replace_rows(target.read().withColumn("id", F.col("id") + 1), "id")
    target.replace_tail(target.read().where("id > 5").withColumn("tag", F.lit("b")), "id", 5)
    assert rows(target) == sorted([(i, "a" if i <= 5 else "b") for i in range(1, 11)], key=repr)


def test_running_readers_survive_the_next_publication(spark, target):
    target.replace_table(numbered(spark, 0, 10), "id")
    reader = target.read()
    target.replace_table(numbered(spark, 0, 3), "id")
    assert reader.count() == 10
    target.replace_table(numbered(spark, 0, 4), "id")
    assert len(segments(target)) == 2


def test_leftovers_of_a_crashed_load_are_dropped(spark, target):
    target.replace_table(numbered(spark, 0, 3), "id")
    orphan = target._create([("id", T.LongType())], Layout())
    other = f"`{target.database}`.`numbers__mine`"
    spark.sql(f"CREATE TABLE {other} (id bigint) USING parquet")
    target.append(numbered(spark, 3, 5))
    assert orphan not in segments(target)
    assert spark.catalog.tableExists(other)
    target.drop()
    assert segments(target) == [] and not target.exists() and spark.catalog.tableExists(other)


def test_plain_tables_are_taken_over(spark, target):
    spark.sql(f"CREATE TABLE {target.name} (id bigint, tag varchar(2)) USING parquet")
    numbered(spark, 0, 4, "xx").write.insertInto(target.name)
    target.replace_tail(numbered(spark, 3, 5, "long"), "id", 2)
    assert rows(target) == [(0, "xx"), (1, "xx"), (2, "xx"), (3, "lo"), (4, "lo")]


def test_fixed_width_and_nested_columns_of_plain_tables(spark, target):
    spark.sql(f"CREATE TABLE {target.name} (id bigint, c char(3), s struct<Xy:int>, g int) USING parquet PARTITIONED BY (g)")
    spark.sql(f"INSERT INTO {target.name} VALUES (1, 'abc', struct(1), 7)")
    target.append(spark.sql("SELECT 2L AS id, 'éé' AS c, struct(2 AS Xy) AS s, 8 AS g"))
    target.append(spark.sql("SELECT 3L AS id, 9 AS g"))
    assert [(r.id, r.c, r.s and r.s.Xy, r.g) for r in target.read().orderBy("id").collect()] == [
        (1, "abc", 1, 7),
        (2, "é  ", 2, 8),
        (3, None, None, 9),
    ]


@pytest.mark.parametrize("kind", ["TABLE {} (x int) USING parquet", "VIEW {} AS SELECT 1 AS x"])
def test_plain_tables_and_views_are_replaced(spark, target, kind):
    spark.sql("CREATE " + kind.format(target.name))
    target.recreate([("id", T.LongType()), ("tag", T.StringType())])
    assert target.read().columns == ["id", "tag"] and rows(target) == []


def test_a_lost_take_over_is_completed(spark, target):
    spark.sql(f"CREATE TABLE {target.name} (id bigint, tag varchar(2)) USING parquet")
    numbered(spark, 0, 4).write.insertInto(target.name)
    spark.sql(f"ALTER TABLE {target.name} RENAME TO {target._qualified(target._base)}")
    assert not target.exists()
    spark.sql(f"ALTER TABLE {target._qualified(target._base)} SET TBLPROPERTIES ('{OWNER}' = '{target.table}')")
    assert target.exists()
    target.replace_tail(numbered(spark, 3, 6, "b"), "id", 2)
    assert rows(target) == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "b")]
    for _ in range(2):
        target.replace_rows(numbered(spark, 0, 1))
    assert not spark.catalog.tableExists(target._qualified(target._base))


def test_failed_loads_keep_plain_tables(spark, target):
    spark.sql(f"CREATE TABLE {target.name} (id bigint, tag varchar(2)) USING parquet")
    numbered(spark, 0, 2).write.insertInto(target.name)
    with pytest.raises(PySparkException, match="boom"):
        target.replace_table(numbered(spark, 0, 2).withColumn("tag", F.raise_error(F.lit("boom")).cast("string")))
    assert rows(target) == [(0, "a"), (1, "a")]


def test_other_views_are_only_replaced_as_a_whole(spark, target):
    spark.sql(f"CREATE VIEW {target.name} AS SELECT 1L AS id")
    with pytest.raises(ValueError, match="is another view"):
        target.append(spark.range(3))
    target.replace_table(spark.range(3))
    assert target.read().count() == 3
    target.drop()
    assert not target.exists()


def test_columns_are_aligned_by_name(spark, target):
    target.recreate([("id", T.LongType()), ("tag", T.VarcharType(9)), ("on", T.DateType())])
    target.append(spark.createDataFrame([("x", 7)], "TAG string, Id int"))
    assert rows(target) == [(7, "x", None)]
    with pytest.raises(ValueError, match="columns missing in the target: more"):
        target.append(spark.createDataFrame([(1, 2)], "id int, more int"))
    with pytest.raises(ValueError, match="has no column key"):
        target.replace_tail(spark.createDataFrame([(1,)], "id int"), "key", 1)
    with pytest.raises(ValueError, match="rows for .* have no column id"):
        target.replace_tail(spark.createDataFrame([("x",)], "tag string"), "id", 1)


def test_missing_targets_are_an_error(spark, target):
    with pytest.raises(ValueError, match="does not exist"):
        target.replace_rows(numbered(spark, 0, 1))
    with pytest.raises(ValueError, match="does not exist"):
        target.replace_tail(numbered(spark, 0, 1), "id", 5)


def test_one_key_bounds_a_target(spark, target):
    target.replace_table(numbered(spark, 0, 9).withColumn("other", F.col("id")), "id")
    with pytest.raises(ValueError, match="bounded by id"):
        target.replace_tail(numbered(spark, 0, 1).withColumn("other", F.col("id")), "other", 5)


def test_declared_types_and_layout(spark, target):
    columns = [("id", T.LongType()), ("d", T.DecimalType(20, 0)), ("tag", T.VarcharType(255))]
    target.recreate(columns, Layout(("tag", "id"), "id", 4))
    assert target.columns() == columns
    assert dict(table_columns(spark, target.name))["tag"] == "varchar(255)"
    assert target_columns(spark, target.name, ["tag", "id", "ta"]) == [("id", "bigint"), ("tag", "varchar(65535)")]
    target.replace_rows(spark.range(100).selectExpr("id", "id d", "string(id) tag"), "id")
    segment = target._qualified(target.state().segments[0].table)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {segment}").collect()}
    assert described["Num Buckets"] == "4"
    assert described["Bucket Columns"] == "[`id`]" and described["Sort Columns"] == "[`tag`, `id`]"


def test_buckets_are_whole_and_sorted(spark, target, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    target.replace_table(lines, "l_orderkey", Layout(("l_orderkey",), "l_partkey", 5))
    files = target.read().groupBy(F.input_file_name().alias("f")).agg(F.collect_set(F.expr("pmod(hash(l_partkey), 5)")).alias("b"))
    found = [row.b for row in files.collect()]
    assert sorted(b for bs in found for b in bs) == [0, 1, 2, 3, 4]
    ordered = target.read().select("l_orderkey", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"))
    drops = ordered.selectExpr("l_orderkey < lag(l_orderkey) over (partition by f order by n) as d").where("d").count()
    assert drops == 0


def test_buckets_follow_the_size_of_a_full_replacement(spark, target):
    large, small = spark.range(1 << 19).select("id"), spark.range(5).select("id")
    assert bucket_count(large) > bucket_count(small)
    target.replace_table(small, "id", Layout((), "id"))
    target.replace_rows(large, "id")
    assert target.state().layout == Layout((), "id", bucket_count(large), True)
    target.replace_tail(small, "id", 2)
    assert target.state().layout.buckets == bucket_count(large)
    target.replace_table(small, "id", Layout((), "id", 6))
    target.replace_rows(large, "id")
    assert target.state().layout == Layout((), "id", 6)


def test_statistics(spark, target):
    target.replace_table(numbered(spark, 0, 100), "id", Layout(("id",)))
    target.append(spark.createDataFrame([(None, "x"), (500, None)], "id bigint, tag string"))
    stats = sorted(tuple(row)[1:] for row in target.statistics("id").collect())
    assert stats == [(2, "500", "500", 1), (100, "0", "99", 0)]
    assert {row.n_nulls for row in target.statistics("tag").collect()} == {None}
    target.refresh_statistics()
    assert sorted(row.n_nulls for row in target.statistics("tag").collect()) == [0, 1]


def test_bookmarks(spark, database):
    Target(spark, database, "a").replace_table(numbered(spark, 0, 7), "id")
    Target(spark, database, "b").replace_table(numbered(spark, 0, 7))
    spark.sql(f"CREATE VIEW `{database}`.`plain` AS SELECT 1 AS x")
    assert sorted(map(tuple, bookmarks(spark, database).collect())) == [("a", 6), ("b", None)]
    assert sorted(t.table for t in published(spark, database)) == ["a", "b"]
    Target(spark, database, "a").append(numbered(spark, 3, 5))
    assert Target(spark, database, "a").state().high == 6
    Target(spark, database, "a").append(numbered(spark, 30, 50))
    assert Target(spark, database, "a").state().high == 49


def test_odd_names(spark, database):
    target = Target(spark, database, "oddName_1")
    frame = spark.range(20).select(F.col("id").alias("the.key"), F.lit("q'uo\\te").alias("it's `it`"))
    target.replace_table(frame, "the.key", Layout(("the.key",), "the.key", 2))
    target.replace_tail(frame.where("`the.key` > 4"), "the.key", 4)
    assert rows(target) == sorted([(i, "q'uo\\te") for i in range(20)], key=repr)
    assert target.state().layout.sort_key == ("the.key",)


def test_state_round_trip():
    state = State((Segment("t__0", 3, ("<", 9)), Segment("t__1")), "k", 8, Layout(("a", "b"), "k", 4))
    assert State.load(state.dump()) == state
    assert State.load(State((Segment("s"),)).dump()) == State((Segment("s"),))


def test_segment_bounds():
    assert Segment("s", 5).cut(("<=", 4)) is None
    assert Segment("s", 5).cut(("<", 5)) is None
    assert Segment("s", 5).cut(("<=", 5)).keep == ("<=", 5)
    assert Segment("s", None, ("<=", 5)).cut(("<", 5)).keep == ("<", 5)
    assert Segment("s", None, ("<", 5)).cut(("<=", 5)).keep == ("<", 5)
    assert Segment("s", None, ("<", 5)).cut(("<=", 3)).keep == ("<=", 3)


def test_size_decisions(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert 10_000 < estimated_bytes(lines) < 100_000_000
    assert bucket_count(lines) == 1
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert bucket_count(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))) <= 8
    for spread in (spread_by_key(lines, "l_orderkey"), spread_by_key(lines, "l_orderkey", 4)):
        assert "Rebalance" in spread._jdf.queryExecution().optimizedPlan().toString()


def test_parts_do_not_change_rows(spark, target):
    data = numbered(spark, 0, 500)
    target.replace_table(data, "id", Layout(("id",)), parts=Parts("tag", 7))
    assert rows(target) == sorted(map(tuple, data.collect()), key=repr)


def test_replacing_the_rows_of_an_empty_target_is_a_full_copy(spark, database, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    copied, filled = Target(spark, database, "copied"), Target(spark, database, "filled")
    first = copied.replace_table(lines, "l_orderkey")
    filled.recreate(copied.columns())
    assert filled.replace_rows(lines, "l_orderkey") == first
    assert filled.read().exceptAll(copied.read()).isEmpty() and copied.read().exceptAll(filled.read()).isEmpty()


@pytest.mark.parametrize("layout", [Layout(), Layout(("id",)), Layout(("id",), "id", 3)])
def test_a_load_reads_its_source_once(spark, target, layout):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    target.replace_table(numbered(spark, 0, 1000).mapInPandas(counted, "id bigint, tag string"), "id", layout)
    assert seen.value == 1000
    target.replace_tail(numbered(spark, 500, 1000).mapInPandas(counted, "id bigint, tag string"), "id", 499)
    assert seen.value == 1500


def test_foreign_tables_stay(spark, target):
    """Tables whose names look like segments, but that no load of this target wrote."""
    foreign = [f"{target.table}__base", f"{target.table}__0123456789ab"]
    for name in foreign:
        spark.range(3).write.saveAsTable(target._qualified(name))
    assert not target.exists()
    for step in range(5):
        target.replace_table(numbered(spark, 0, step + 1), "id")
    assert target.read().count() == 5
    assert len(target._segment_tables()) == 2
    target.drop()
    for name in foreign:
        assert spark.table(target._qualified(name)).count() == 3


def test_a_cut_skips_rows_without_a_layout(spark, target, sf_dir):
    """Rows are ordered by the bounding key within files, so a cut view hands on little more than what it keeps."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").orderBy(F.rand(1))
    target.replace_table(lines, "l_orderkey")
    key = spark.table(target._qualified(target.state().segments[0].table)).select("l_orderkey")
    files = key.select("l_orderkey", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    steps = files.selectExpr("l_orderkey - lag(l_orderkey) OVER (PARTITION BY f ORDER BY i) AS step")
    assert steps.where("step < 0").count() == 0


def test_a_bound_at_the_end_leaves_no_filter(spark, target):
    target.replace_table(numbered(spark, 0, 10), "id")
    for _ in range(2):
        target.replace_tail(numbered(spark, 0, 0), "id", 9)
    assert [s.keep for s in target.state().segments] == [None]
    assert target.state().high == 9


def test_cut_values_are_counted_and_nested_ones_rejected(spark, target):
    frame = spark.range(6).selectExpr("id", "repeat('x', cast(id as int) * 60) AS tag", "array_repeat(id, cast(id as int)) AS list")
    loaded = target.replace_table(frame, "id", string_width=120, other_width=65535)
    assert (loaded.n_rows, loaded.n_rejects, loaded.n_cut) == (6, 0, 3)
    loaded = target.replace_table(frame, "id", string_width=300, other_width=9, max_errors=3)
    assert (loaded.n_rows, loaded.n_rejects, loaded.n_cut) == (5, 1, 0)
    assert target.replace_table(frame, "id", string_width=1000).n_cut == 0


# -- rejects ---------------------------------------------------------------------------------------------

WANTED = [("id", T.LongType()), ("size", T.IntegerType()), ("day", T.DateType())]


def dirty(spark, low=0, high=100):
    """One size in ten is no number, one day in seven no date."""
    size = F.when(F.col("id") % 10 == 3, "much").otherwise(F.col("id").cast("string"))
    day = F.when(F.col("id") % 7 == 1, "someday").otherwise("2024-02-29")
    return spark.range(low, high).select("id", size.alias("size"), day.alias("day"))


def misfits(low=0, high=100):
    return sum(i % 10 == 3 for i in range(low, high)), sum(i % 7 == 1 for i in range(low, high))


def test_rejects_have_reasons(spark, target):
    target.recreate(WANTED)
    loaded = target.replace_rows(dirty(spark), "id", max_errors=1000)
    sizes, days = misfits()
    assert loaded.by_column == (("day", days), ("size", sizes))
    reasons = {r.record: [tuple(x) for x in r.reasons] for r in target.rejects().collect()}
    assert loaded.n_rejects == len(reasons)
    assert reasons['{"id":43,"size":"much","day":"someday"}'] == [("size", "much", "int"), ("day", "someday", "date")]
    assert reasons['{"id":3,"size":"much","day":"2024-02-29"}'] == [("size", "much", "int")]
    assert target.read().count() == 100 - loaded.n_rejects


def test_rejects_go_with_their_version(spark, target, monkeypatch):
    target.recreate(WANTED)
    target.replace_rows(dirty(spark), "id", max_errors=1000)
    first = target.rejects().count()
    target.append(dirty(spark, 100, 150), max_errors=1000)
    both = target.rejects().count()
    assert both > first and len({r.segment for r in target.rejects().collect()}) == 2
    # a publication that fails leaves none
    with monkeypatch.context() as broken:
        broken.setattr(Target, "_publish", lambda self, state: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            target.append(dirty(spark, 200, 300), max_errors=1000)
    assert target.rejects().count() == both
    # merging keeps them, a full replacement does not
    merging = Target(spark, target.database, target.table, max_segments=2)
    merging.append(numbered(spark, 500, 503).select("id"))
    assert target.rejects().count() == both and len(target.state().segments) == 2
    assert target.read().count() == 150 - both + 3
    target.replace_rows(numbered(spark, 0, 3).select("id"))
    assert target.rejects().count() == 0 and target.read().count() == 3


def test_refused_loads_show_what_they_would_leave_out(spark, target):
    target.recreate(WANTED)
    for high in (50, 100):
        with pytest.raises(TooManyRejects) as refused:
            target.replace_rows(dirty(spark, 0, high), "id", max_errors=2)
        sizes, days = misfits(0, high)
        assert refused.value.by_column == {"size": sizes, "day": days}
    assert target.refused().count() == 24 and target.rejects().count() == 0 and rows(target) == []
    with pytest.raises(TooManyRejects, match=r"limit 1 \(size: 10, day: 15\)"):
        target.replace_rows(dirty(spark), "id")
    tables = segments(target)
    target.replace_rows(numbered(spark, 0, 3).select("id"))
    assert target.refused().count() == 0 and len(set(segments(target)) & set(tables)) == 1


def test_a_foreign_table_gets_no_rejects(spark, target):
    other = target._qualified(f"{target.table}__rejects")
    spark.sql(f"CREATE TABLE {other} (segment string, record string) USING parquet")
    target.recreate(WANTED)
    target.replace_rows(dirty(spark), "id", max_errors=1000)
    assert spark.table(other).count() == 0 and target.rejects().count() == 24
    target.drop()
    assert spark.catalog.tableExists(other)


def test_rejects_of_a_distributed_table(spark, target):
    target.recreate(WANTED, Layout(("day",), "id", 3))
    loaded = target.replace_rows(dirty(spark), "id", max_errors=1000)
    assert target.read().count() == loaded.n_rows == 76 and target.rejects().count() == 24
    target.replace_tail(dirty(spark, 50, 120), "id", 49, max_errors=1000)
    assert target.read().agg(F.max("id")).first()[0] == 119


def test_reserved_names_are_refused(spark, target):
    with pytest.raises(ValueError, match="reserved names: _record"):
        target.replace_table(spark.range(3).withColumn("_record", F.lit("x")))


# -- schemas by segment ----------------------------------------------------------------------------------


def test_new_and_wider_columns(spark, target):
    old = [("id", T.IntegerType()), ("tag", T.VarcharType(3)), ("x", T.FloatType()), ("d", T.DecimalType(5, 2)), ("on", T.DateType())]
    target.replace_table(spark.sql("SELECT 1 id, 'abcdef' tag, 0.5 x, 1.25 d, DATE'2024-01-02' on"), "id", columns=old)
    base = target.state().segments[0].table
    new = [("ID", T.LongType()), ("tag", T.VarcharType(9)), ("x", T.DoubleType()), ("d", T.DecimalType(9, 3)), ("on", T.TimestampNTZType()), ("more", T.VarcharType(5))]
    frame = spark.sql("SELECT 5000000000L id, 'abcdef' tag, 0.1D x, 123456.125 d, TIMESTAMP_NTZ'2024-01-02 03:04:05' on, 'mm' more")
    target.append(frame, evolve=new)
    assert [(n, t.simpleString()) for n, t in target.columns()] == [
        ("id", "bigint"), ("tag", "varchar(9)"), ("x", "double"), ("d", "decimal(9,3)"), ("on", "timestamp_ntz"), ("more", "varchar(5)"),
    ]
    found = {r.id: r for r in target.read().collect()}
    assert (found[1].tag, found[1].x, str(found[1].d), found[1].more) == ("abc", 0.5, "1.250", None)
    assert (found[5000000000].tag, found[5000000000].more, found[1].on.hour) == ("abcdef", "mm", 0)
    assert target.state().segments[0].table == base
    target.replace_tail(frame.limit(0), "id", 1)
    assert [r.id for r in target.read().collect()] == [1]


def test_columns_never_become_narrower(spark, target):
    target.replace_table(numbered(spark, 0, 5), "id")
    for columns, wrong in (([("id", T.IntegerType())], "id from bigint to int"), ([("tag", T.VarcharType(9))], "tag from"), ([("id", T.DoubleType())], "id from")):
        with pytest.raises(ValueError, match=wrong):
            target.widen(columns)
    # a load takes what is wider, and leaves the rest as it is
    target.append(numbered(spark, 5, 6, "x" * 300), evolve=[("id", T.IntegerType()), ("tag", T.VarcharType(400))])
    assert dict((n, t.simpleString()) for n, t in target.columns()) == {"id": "bigint", "tag": "varchar(400)"}
    assert {len(r.tag) for r in target.read().collect()} == {1, 300}
    with pytest.raises(ValueError, match="columns missing in the target: more"):
        target.append(numbered(spark, 6, 7).withColumn("more", F.lit(1)))
    target.widen([("more", T.IntegerType())])
    assert target.read().where("more IS NULL").count() == 6
    target.append(numbered(spark, 6, 7).withColumn("more", F.lit(1)))
    assert len(target.state().schemas) == 3
    target.replace_rows(numbered(spark, 0, 2))
    assert len(target.state().schemas) == 1 and target.read().columns == ["id", "tag", "more"]


def test_merging_conforms_old_segments(spark, database):
    target = Target(spark, database, "numbers", max_segments=3)
    target.replace_table(spark.range(10).select(F.col("id").cast("int")), "id")
    for i in range(1, 5):
        target.append(spark.range(10 * i, 10 * i + 10).withColumn(f"c{i}", F.lit(i)), evolve=[("id", T.LongType()), (f"c{i}", T.IntegerType())])
    assert target.read().columns == ["id", "c1", "c2", "c3", "c4"]
    assert target.read().where("c2 = 2 AND c1 IS NULL").count() == 10
    assert sorted(r.id for r in target.read().select("id").collect()) == list(range(50))


def test_states_of_earlier_versions(spark, target):
    target.replace_table(numbered(spark, 0, 5), "id")
    old = {"segments": [{"table": target.state().segments[0].table, "low": 0, "keep": None, "rows": 5}], "key": "id", "high": 4}
    old["layout"] = {"sort_key": [], "dist_key": None, "buckets": None}
    spark.sql(f"ALTER VIEW {target.name} SET TBLPROPERTIES ('{targets.STATE}' = '{json.dumps(old)}')")
    target.replace_tail(numbered(spark, 3, 8, "b"), "id", 2)
    assert rows(target) == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "b"), (6, "b"), (7, "b")]


# -- what is live ----------------------------------------------------------------------------------------


def test_a_mostly_dead_segment_is_written_anew(spark, target):
    target.replace_table(numbered(spark, 0, 1000), "id")
    base = target.state().segments[0].table
    target.replace_tail(numbered(spark, 50, 60, "b"), "id", 49)
    first = target.live_rows().where(F.col("segment") == base).first()
    assert (first.n_written, first.is_cut) == (1000, True) and abs(first.n_live - 50) <= 20
    for step in range(2):
        target.append(numbered(spark, 100 + step, 101 + step, "c"))
    assert base not in {s.table for s in target.state().segments}
    assert rows(target) == sorted([(i, "a") for i in range(50)] + [(i, "b") for i in range(50, 60)] + [(100, "c"), (101, "c")], key=repr)
    # one that is half live stays
    target.replace_table(numbered(spark, 0, 1000), "id")
    base = target.state().segments[0].table
    for step in range(3):
        target.replace_tail(numbered(spark, 500, 600), "id", 499)
    assert target.state().segments[0].table == base


@pytest.mark.parametrize("op", ["<=", "<"])
def test_shares_follow_the_keys(op):
    draw = random.Random(3)
    keys = sorted([draw.randrange(1000) ** 2 for _ in range(5000)] + [77_777] * 2500)
    depths = tuple(keys[round(i * (len(keys) - 1) / 50)] for i in range(51))
    for bound in [*draw.sample(keys, 50), -1, 10**9, 77_776, 77_777, 77_778]:
        kept = sum(k <= bound if op == "<=" else k < bound for k in keys) / len(keys)
        assert abs(sketches.share_kept(depths, op, bound) - kept) <= 0.021


def test_statistics_of_cut_segments(spark, target):
    data = spark.range(3000).select("id", (F.col("id") % 7).alias("g"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("n"))
    target.replace_table(data, "id", analyze=["id", "g", "n"])
    whole = {r.column: r for r in target.merged_statistics().collect()}
    assert {(r.n_rows, r.exact) for r in whole.values()} == {(3000, True)}
    assert (whole["id"].low, whole["id"].high, whole["g"].n_distinct, whole["n"].n_nulls) == ("0", "2999", 7, 1500)
    target.replace_tail(data.where("id >= 2500"), "id", 1999, analyze=["id", "g", "n"])
    cut = {r.column: r for r in target.merged_statistics().collect()}
    assert not cut["id"].exact and abs(cut["id"].n_rows - 2500) <= 60 and cut["id"].high == "2999"
    target.replace_tail(data.limit(0), "id", 999)
    left = target.merged_statistics().where("column = 'id'").first()
    assert (left.low, left.high) == ("0", "999") and abs(left.n_rows - 1000) <= 30
    target.append(numbered(spark, 5000, 5001).select("id"))  # knows nothing of g and n
    assert {r.column for r in target.merged_statistics().collect()} == {"id"}
    target.replace_rows(data.limit(0))
    assert target.merged_statistics().collect() == []


def test_a_load_reads_no_segment(spark, target):
    """Statistics come from the writing pass: nothing reads what was written."""
    seen = []
    run = spark.sql

    class Watched:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            seen.append(text)
            return run(text)

    watched = Target(Watched(), target.database, target.table)
    watched.replace_table(numbered(spark, 0, 100), "id", Layout(("id",)))
    assert not [text for text in seen if text.startswith("ANALYZE")]
    assert [tuple(r)[1:] for r in target.statistics("id").collect()] == [(100, "0", "99", 0)]


# -- hot keys and ranges ---------------------------------------------------------------------------------


def skewed(spark, n=20_000):
    """Nine in ten rows have key 7, some have none."""
    key = F.when(F.col("id") % 10 != 0, 7).when(F.col("id") % 100 != 0, F.col("id") % 991)
    return spark.range(n).select("id", key.cast("bigint").alias("k"))


def test_hot_keys_are_dealt_to_several_buckets(spark, target):
    data = skewed(spark)
    target.replace_table(data, "id", Layout(dist_key="k", buckets=8, spread_hot=True))
    assert dict(target.state().layout.hot)["7"] > 8
    stored, _ = target.read_salted()
    tasks = sorted(r["count"] for r in stored.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
    assert rows(target) == sorted(map(tuple, data.collect()), key=repr)
    # a key that becomes hot later, and loads before and after it
    later = spark.range(20_000, 60_000).select("id", F.lit(5).cast("bigint").alias("k"))
    for part in (later, later.withColumn("id", F.col("id") + 100_000)):
        target.append(part)
    assert {"5", "7"} <= dict(target.state().layout.hot).keys()
    users = spark.range(991).select(F.col("id").alias("k"), F.concat(F.lit("u"), "id").alias("name"))
    whole = target.read()
    for how in ("inner", "left", "left_semi", "left_anti"):
        found, plain = target.join(users, how=how), whole.join(users, "k", how)
        assert sorted(found.columns) == sorted(plain.columns)
        assert found.select(plain.columns).exceptAll(plain).isEmpty() and found.count() == plain.count()


def test_skewed_join_is_a_join(spark):
    left = skewed(spark)
    right = spark.range(5, 300).select(F.col("id").alias("k"), "id").withColumnRenamed("id", "v")
    right = right.unionByName(right.where("k = 7"))
    assert dict(skew.hot_keys(left, "k", 8))["7"] >= 8
    for how in ("inner", "left", "left_semi", "left_anti"):
        found, plain = skew.skewed_join(left, right, "k", 8, how), left.join(right, "k", how)
        assert found.select(plain.columns).exceptAll(plain).isEmpty() and found.count() == plain.count()
    with pytest.raises(ValueError, match="how is"):
        skew.skewed_join(left, right, "k", 8, "full")
    salted = skew.with_salt(left, "k", dict(skew.hot_keys(left, "k", 8)), 8)
    largest = salted.groupBy("k", skew.SALT).count().agg(F.max("count")).first()[0]
    assert largest < 18_000 / 50


def test_a_cut_of_a_ranged_target_opens_few_files(spark, target):
    data = numbered(spark, 0, 40_000).orderBy(F.rand(2)).withColumn("pad", F.md5(F.col("id").cast("string")))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        target.replace_table(data, "id", Layout(("id",), ranged=True, buckets=None))
        bounds = target.read().select("id", F.input_file_name().alias("f")).groupBy("f").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        files = sorted((r.low, r.high) for r in bounds.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(a[1] < b[0] for a, b in zip(files, files[1:]))
    target.replace_tail(data.limit(0), "id", 99)
    assert sum(low <= 99 for low, _ in files) == 1
    assert target.read().count() == 100


def test_ranges_split_a_frequent_key(spark):
    data = spark.range(10_000).select("id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"))
    sizes = [r["count"] for r in by_ranges(data, ("k",), 8).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.5 * 10_000 / 8
