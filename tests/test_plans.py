"""The plans: what reaches the scan, and where rows are shuffled."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from tidemark.functions.text import truncate_utf8
from tidemark.operators import conform, scans, specs
from tidemark.operators.layout import Layout, lay_out
from tidemark.operators.targets import Target


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_bounds_and_columns_reach_the_scan(spark, sf_dir):
    orders = contract.table(spark, sf_dir, "orders")
    text = plan(scans.scan(orders, ["o_totalprice"], "o_orderkey", 500))
    assert "GreaterThanOrEqual(o_orderkey,500)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    text = plan(scans.after_key(orders, "o_orderkey", 500).select("o_custkey"))
    assert "GreaterThan(o_orderkey,500)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_a_cut_tail_is_skipped_by_the_scan(spark, database):
    target = Target(spark, database, "t")
    target.replace_table(spark.range(100).withColumn("x", F.col("id")), "id")
    target.replace_tail(spark.range(50, 200).withColumn("x", F.col("id")), "id", 49)
    text = plan(target.read().select("x").where("x > 3"))
    assert "Or(LessThanOrEqual(id,49),IsNull(id))" in text
    assert text.count("GreaterThan(x,3)") == 2
    assert "Exchange" not in text


@pytest.mark.parametrize(
    "name",
    [
        "scan_catalog_table", "scan_projected_from_key", "scan_after_bookmark", "select_fields", "include_columns",
        "unsigned_longs_to_long", "decimals_to_double", "clamp_decimals", "cast_by_type_names", "truncate_to_bytes",
        "conform_to_target", "rejected_rows", "keyed_specs", "named_specs", "spec_values",
    ],
)
def test_narrow_operators_do_not_shuffle(spark, sf_dir, name):
    text = plan(contract.queries()[name](spark, sf_dir))
    assert "Exchange" not in text
    assert "Python" not in text


def test_conversions_stay_in_generated_code(spark, sf_dir):
    documents = contract.table(spark, sf_dir, "documents")
    text = plan(documents.select(truncate_utf8(F.col("text"), 255)))
    assert re.search(r"\[codegen id : \d+\]", text)
    assert "ReadSchema: struct<text:string>" in text


def test_rows_without_possible_misfits_carry_no_flag(spark, sf_dir):
    orders = contract.table(spark, sf_dir, "orders")
    assert conform.align(orders, conform.target_schema(orders)).columns == orders.columns
    assert conform.align(orders.select("o_orderkey"), [("o_orderkey", T.IntegerType())]).columns == [
        "o_orderkey",
        conform.REJECTED,
    ]


def test_a_layout_is_one_shuffle(spark, sf_dir):
    lines = contract.table(spark, sf_dir, "lineitem")
    text = plan(lay_out(lines, Layout(("l_shipdate",), "l_partkey", 4)))
    assert len(re.findall(r"\n\(\d+\) Exchange", text)) == 1
    assert "hashpartitioning(l_partkey" in text and "REBALANCE_PARTITIONS_BY_COL" in text
    assert not re.findall(r"\n\(\d+\) Exchange", plan(lay_out(lines, Layout(("l_shipdate",)))))


def test_a_distributed_target_is_grouped_and_joined_without_shuffle(spark, database):
    target = Target(spark, database, "t")
    data = spark.range(1000).selectExpr("id", "id % 7 as v")
    target.replace_table(data, "id", Layout(("id",), "id", 4))
    assert "Exchange" not in plan(target.read().groupBy("id").agg(F.sum("v")))
    target.replace_tail(data.where("id > 500"), "id", 500)
    assert "Exchange" not in plan(target.read().groupBy("id").agg(F.sum("v")))
    assert target.read().groupBy("id").count().where("count = 1").count() == 1000


def test_repeated_names_are_reduced_before_the_shuffle(spark, sf_dir):
    lists = contract.table(spark, sf_dir, "customer").select(
        "c_custkey", F.format_string("t_%s:%s", "c_nationkey", "c_custkey").alias("spec")
    )
    last = specs.last_bookmarks(specs.bookmark_entries(lists, "spec"), ["c_custkey", "pos"])
    assert "partial_max_by" in plan(last)
    configs = lists.select(F.col("spec").alias("table_name"), "spec", F.lit("a").alias("hashfield"), F.lit("2").alias("hashpartitions"), F.lit(0).alias("pos"))
    assert "partial_min_by" in plan(specs.with_partition_config(lists.withColumnRenamed("spec", "name"), configs))


def test_filters_reach_segments_of_other_schemas(spark, database):
    """Old segments are cast and filled by the view, and still skip data: by their own type, or as a whole."""
    target = Target(spark, database, "t")
    target.replace_table(spark.range(100).select(F.col("id").cast("int"), F.lit("a").alias("tag")), "id")
    wide = spark.range(100, 200).select("id", F.lit("b").alias("tag"), F.col("id").alias("more"))
    target.append(wide, evolve=[("id", T.LongType()), ("more", T.LongType())])
    text = plan(target.read().where("id > 42 AND tag = 'a'"))
    assert text.count("GreaterThan(id,42)") == 2 and text.count("EqualTo(tag,a)") == 2
    text = plan(target.read().where("more = 150"))
    assert text.count("PushedFilters") == 1 and "EqualTo(more,150)" in text


def test_rejects_are_no_part_of_a_scan(spark, database):
    target = Target(spark, database, "t")
    target.recreate([("id", T.IntegerType()), ("v", T.IntegerType())])
    target.replace_rows(spark.sql("SELECT id, if(id = 3, 'x', string(id)) AS v FROM range(10)"), "id", max_errors=5)
    text = plan(target.read().select("id").where("v > 4"))
    assert "PartitionFilters: [isnotnull(_rejected" in text and "_record" not in text and "GreaterThan(v,4)" in text


def test_a_salted_join_shuffles_the_small_side_only(spark, database):
    target = Target(spark, database, "t")
    data = spark.range(20_000).select("id", F.when(F.col("id") % 10 > 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"))
    target.replace_table(data, "id", Layout(dist_key="k", buckets=8, spread_hot=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(target.join(spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("name"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"\n\(\d+\) Exchange", text)) == 1


def test_rejects_and_reasons_stay_in_generated_code(spark, sf_dir):
    lines = contract._dirty_lines(spark, sf_dir)
    columns = [(name, T.DataType.fromDDL(kind)) for name, kind in contract._LINE_TYPES.items()]
    text = plan(conform.align(lines, columns, count_cut=True, keep_rejects=True, reasons=True))
    assert "* Project" in text and not re.search(r"^[\s:+-]*Project", text, re.M)
    # each value is cast once, whatever uses the result
    assert all(text.count(f"try_cast({name}#") == 1 for name in ("l_linenumber", "l_quantity", "l_shipdate"))
