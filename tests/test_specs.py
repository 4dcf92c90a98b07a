"""Specification strings: the known cases of the string format, and its edges."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row

from tidemark.operators import specs
from tidemark.operators.partitions import Parts
from tidemark.plans import jobs

NAME_COLUMNS_KEY = ["name", "columns", "sort_key"]
TEXT_LIST_TEXT = ["str", "list", "str"]
FOUR = ["name", "columns", "sort_key", "dist_key"]

# The known cases of the format.
CASES = [
    (
        "table1:col1,col2:key1;table2:*:key2",
        NAME_COLUMNS_KEY,
        TEXT_LIST_TEXT,
        [("table1", ["col1", "col2"], "key1"), ("table2", ["*"], "key2")],
    ),
    ("", NAME_COLUMNS_KEY, None, []),
    (" \t\n", NAME_COLUMNS_KEY, None, []),
    (
        "table1:col1;table2:col2,col3:key2:extra",
        FOUR,
        ["str", "list", "str", "str"],
        [("table1", ["col1"], None, None), ("table2", ["col2", "col3"], "key2", "extra")],
    ),
    (
        "table1:10:key1;table2:20:key2",
        ["name", "id", "sort_key"],
        ["str", "int", "str"],
        [("table1", 10, "key1"), ("table2", 20, "key2")],
    ),
    (
        "table1:10:key1;table2:20:key2",
        ["name", "id", "sort_key"],
        None,
        [("table1", "10", "key1"), ("table2", "20", "key2")],
    ),
    (
        " table1 : col1, col2 : key1 ; table2 : * : key2 ",
        NAME_COLUMNS_KEY,
        TEXT_LIST_TEXT,
        [("table1", ["col1", "col2"], "key1"), ("table2", ["*"], "key2")],
    ),
    (
        "table1::key1;table2:col1,:",
        NAME_COLUMNS_KEY,
        TEXT_LIST_TEXT,
        [("table1", None, "key1"), ("table2", ["col1"], None)],
    ),
    (
        "table-1:col.1,col@2:key_1",
        NAME_COLUMNS_KEY,
        TEXT_LIST_TEXT,
        [("table-1", ["col.1", "col@2"], "key_1")],
    ),
    ("a:,:k", NAME_COLUMNS_KEY, TEXT_LIST_TEXT, [("a", [], "k")]),
    (";; \u00a0a\u2003 :\tx\n,\x1cy\x1f:\x0bk\f;;\n;", NAME_COLUMNS_KEY, TEXT_LIST_TEXT, [("a", ["x", "y"], "k")]),
    ("a:1;a:2;a:1", ["name", "id"], ["str", "int"], [("a", 1), ("a", 2), ("a", 1)]),
    ("a: +1_000 ;b:-7;c", ["name", "id"], ["str", "int"], [("a", 1000), ("b", -7), ("c", None)]),
    ("a:1:2:3", ["name"], None, [("a",)]),
]


def text(spark, value):
    return spark.createDataFrame([(value,)], "spec string")


@pytest.mark.parametrize("value, keys, types, expected", CASES)
def test_keyed_specs(spark, value, keys, types, expected):
    rows = specs.keyed_specs(text(spark, value), "spec", keys, types).orderBy("pos").collect()
    assert [row.pos for row in rows] == list(range(len(expected)))
    assert [tuple(row)[1:] for row in rows] == expected


@pytest.mark.parametrize("bad", ["not_a_number", "1.5", "1__0", "_1", "99999999999999999999", "0x10"])
def test_bad_integer_stops_the_query(spark, bad):
    frame = specs.keyed_specs(text(spark, f"table1:{bad}:key1"), "spec", ["name", "id", "k"], ["str", "int", "str"])
    with pytest.raises(PySparkException, match=f"Failed to convert value '{bad}'.*'id'"):
        frame.collect()


def test_lengths_must_match(spark):
    with pytest.raises(ValueError, match="^Length of types must match length of keys$"):
        specs.keyed_specs(text(spark, "table1:col1:key1"), "spec", NAME_COLUMNS_KEY, ["str", "list"])


def test_named_specs(spark):
    rows = specs.named_specs(text(spark, "t:a, b:5:9;u"), "spec", ["name", "columns", "start_id", "end_id"])
    assert [tuple(row)[1:] for row in rows.orderBy("pos").collect()] == [
        ("t", ["a", "b"], 5, 9),
        ("u", None, None, None),
    ]


def test_other_delimiters_are_literal(spark):
    rows = specs.spec_values(text(spark, "a.b|c..+d"), "spec", "|", ".").orderBy("pos").collect()
    assert [row["values"] for row in rows] == [["a", "b"], ["c", None, "+d"]]
    rows = specs.spec_values(text(spark, r"a\Eb"), "spec", ";", r"\E").collect()
    assert [row["values"] for row in rows] == [["a", "b"]]
    with pytest.raises(ValueError, match="empty delimiter"):
        specs.spec_values(text(spark, "a"), "spec", "")


def test_null_text_gives_no_rows(spark):
    assert specs.spec_values(text(spark, None), "spec").count() == 0
    assert specs.bookmark_entries(text(spark, None), "spec").count() == 0


def test_bookmark_entries(spark):
    value = "orders:150000, customers : 500000,products,a:b:c,a:x,bad-name,,a:,n:-3"
    rows = specs.bookmark_entries(text(spark, value), "spec").orderBy("pos").collect()
    assert [(row.name, row.bookmark, row.valid) for row in rows] == [
        ("orders", 150000, True),
        ("customers", 500000, True),
        ("products", 0, True),
        ("a", None, False),
        ("a", None, False),
        ("bad-name", None, False),
        ("", None, False),
        ("a", None, False),
        ("n", -3, True),
    ]


def test_last_bookmark_wins_at_first_place(spark):
    entries = specs.bookmark_entries(text(spark, "a:1,b:2,a:3,a:x,b"), "spec")
    rows = specs.last_bookmarks(entries).orderBy("pos").collect()
    assert [tuple(row) for row in rows] == [(0, "a", 3), (1, "b", 0)]


def test_bookmarks_within_groups(spark):
    frame = spark.createDataFrame([(1, "a:1,a:2"), (2, "a:9")], "job int, spec string")
    rows = specs.last_bookmarks(specs.bookmark_entries(frame, "spec"), within=["job"]).orderBy("job").collect()
    assert [(row.job, row.name, row.bookmark) for row in rows] == [(1, "a", 2), (2, "a", 9)]


def test_job_bookmark_list(spark):
    assert list(jobs.bookmark_list(spark, "b:1,a,b:2").items()) == [("b", 2), ("a", 0)]
    with pytest.raises(jobs.InvalidTables, match="'x-y'.*'a:b'"):
        jobs.bookmark_list(spark, "ok,x-y,a:b")
    with pytest.raises(jobs.InvalidTables):
        jobs.bookmark_list(spark, "")


def test_partition_config(spark):
    names = spark.createDataFrame([("orders",), ("part",), ("blank",), ("one",), ("orders",)], "name string")
    configs = specs.keyed_specs(
        text(spark, "orders:o_custkey:8;orders:x:2;blank;blank:y:4;one:k:1;unused:u:9"),
        "spec",
        ["table_name", "hashfield", "hashpartitions"],
    )
    rows = specs.with_partition_config(names, configs).collect()
    assert sorted(tuple(row) for row in rows) == [
        ("blank", "id", "1", False),
        ("one", "k", "1", False),
        ("orders", "o_custkey", "8", True),
        ("orders", "o_custkey", "8", True),
        ("part", "id", "1", False),
    ]


def test_table_specs_are_rows_in_order(spark):
    rows = jobs.table_specs(spark, "z:*:5;a", ["name", "columns", "start_id"], ["str", "list", "int"])
    assert rows == [Row(pos=0, name="z", columns=["*"], start_id=5), Row(pos=1, name="a", columns=None, start_id=None)]


def test_job_partition_configs(spark):
    configs = jobs.partition_configs(spark, "orders:o_custkey:8;orders:x:2;a::4;b:k:1;c:k")
    assert configs == {"orders": Parts("o_custkey", 8), "a": Parts("id", 4)}
    assert jobs.partition_configs(spark, " ") == {}
    with pytest.raises(ValueError):
        jobs.partition_configs(spark, "a:k:many")
