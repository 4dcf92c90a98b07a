"""Text width, type maps, casts and rejects."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import types
from tidemark.functions.casts import conformed, never_fails
from tidemark.functions.text import strip, truncate_utf8
from tidemark.operators import conform


def cut(text, width):
    return text.encode()[:width].decode(errors="ignore")


def test_truncation_equals_brute_force_on_whole_documents(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    widths = [0, 1, 2, 3, 4, 5, 255, 256, 1000, 65535]
    rows = texts.select("text", *[truncate_utf8(F.col("text"), w).alias(f"w{w}") for w in widths]).collect()
    assert len(rows) == texts.count()
    for row in rows:
        for width in widths:
            assert row[f"w{width}"] == cut(row.text, width)


def test_wide_text_is_cut_at_the_wide_limit(spark):
    value = "a" + "\u20ac" * 30000
    row = spark.createDataFrame([(value,)], "s string").select(truncate_utf8(F.col("s"), 65535).alias("s")).first()
    assert row.s == cut(value, 65535) and len(row.s.encode()) == 65533


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=40),
    st.integers(0, 12),
)
def test_truncation_of_any_text(spark, values, width):
    frame = spark.createDataFrame([(v,) for v in values], "s string")
    rows = frame.select("s", truncate_utf8(F.col("s"), width).alias("c")).collect()
    assert [row.c for row in rows] == [cut(row.s, width) for row in rows]


def test_strip_equals_python(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    others = ["\u200b", "\ufeff", "x", "\x00", "\x1b"]
    values = [f"{b}a{b}b{b}{b}" for b in blanks + others] + ["", " ", "\t\r\n"]
    rows = spark.createDataFrame([(v,) for v in values], "s string").select("s", strip(F.col("s")).alias("c")).collect()
    assert [row.c for row in rows] == [row.s.strip() for row in rows]


NAMES = {
    # name: (Spark type, target type)
    "string": ("string", "varchar(255)"),
    "varchar": ("string", "varchar(255)"),
    "char": ("string", "varchar(255)"),
    "varchar(40)": ("string", "varchar(65535)"),
    "int": ("int", "int"),
    "INTEGER": ("int", "int"),
    "bigint": ("bigint", "bigint"),
    "float": ("double", "float"),
    "double": ("double", "double"),
    "Boolean": ("boolean", "boolean"),
    "timestamp": ("timestamp", "timestamp_ntz"),
    "timestamp_ntz": ("string", "timestamp_ntz"),
    "date": ("date", "date"),
    "decimal": ("decimal(38,10)", "decimal(38,10)"),
    "decimal(10,2)": ("decimal(10,2)", "decimal(10,2)"),
    "DECIMAL( 20, 0 )": ("decimal(20,0)", "decimal(20,0)"),
    "decimal(x)": ("decimal(38,10)", "varchar(65535)"),
    "smallint": ("string", "varchar(65535)"),
    "array<int>": ("string", "varchar(65535)"),
    "no_such_type": ("string", "varchar(65535)"),
}


@pytest.mark.parametrize("name", NAMES)
def test_type_maps(spark, name):
    spark_name, target_name = NAMES[name]
    assert types.spark_type(name).simpleString() == spark_name
    assert types.target_type(name).simpleString() == target_name


def test_clamp_decimal():
    assert types.clamp_decimal(T.DecimalType(38, 10)) == T.DecimalType(38, 10)
    assert types.clamp_decimal(T.DecimalType(38, 10), 18) == T.DecimalType(18, 10)
    assert types.clamp_decimal(T.DecimalType(38, 20), 18) == T.DecimalType(18, 18)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unsigned_long_overflow_never_wraps(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(Decimal(2**63 - 1),), (Decimal(2**64 - 1),), (None,)]
        frame = spark.createDataFrame(rows, "u decimal(20,0)")
        with pytest.raises(PySparkException, match="Failed to convert value '18446744073709551615'"):
            conform.unsigned_longs_to_long(frame).collect()
        kept = conform.unsigned_longs_to_long(frame, "null")
        assert kept.schema["u"].dataType == T.LongType()
        assert [row.u for row in kept.collect()] == [2**63 - 1, None, None]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_only_exact_unsigned_longs_change(spark):
    frame = spark.range(1).selectExpr("cast(id as decimal(20,0)) a", "cast(id as decimal(20,1)) `b.c`", "cast(id as decimal(19,0)) d")
    assert [f.dataType.simpleString() for f in conform.unsigned_longs_to_long(frame).schema] == [
        "bigint",
        "decimal(20,1)",
        "decimal(19,0)",
    ]
    assert {f.dataType.simpleString() for f in conform.decimals_to_double(frame).schema} == {"double"}


def test_cast_by_names_fails_or_nulls(spark):
    frame = spark.createDataFrame([("1",), ("x",)], "a string")
    with pytest.raises(PySparkException, match="Failed to convert value 'x'"):
        conform.cast_by_names(frame, {"a": "int"}).collect()
    assert [row.a for row in conform.cast_by_names(frame, {"a": "int"}, "null").collect()] == [1, None]


def test_nested_and_binary_become_text(spark):
    frame = spark.createDataFrame(
        [([1, None], {"k": 1.5}, (1, None), bytearray(b"\xff\x00"), True, None)],
        "a array<int>, m map<string,double>, s struct<x:int,y:string>, b binary, t boolean, n array<int>",
    )
    row = conform.to_target(frame).first()
    assert tuple(row) == ("[1,null]", '{"k":1.5}', '{"x":1,"y":null}', "/wA=", True, None)
    assert conform.unmapped_columns(frame) == ["a", "m", "s", "b", "n"]


def test_rejects_keep_their_form(spark):
    frame = spark.createDataFrame([(1, "5", "x"), (2, "y", "x"), (3, None, None)], "k int, v string, s string")
    columns = [("K", T.LongType()), ("s", T.VarcharType(1)), ("V", T.IntegerType()), ("extra", T.DateType())]
    fits, rejects = conform.split_rejects(frame, columns)
    assert fits.columns == ["K", "s", "V", "extra"]
    assert sorted(map(tuple, fits.collect())) == [(1, "x", 5, None), (3, None, None, None)]
    assert [tuple(row) for row in rejects.collect()] == [(2, "y", "x")]
    with pytest.raises(ValueError, match="columns missing in the target: s, v"):
        conform.align(frame, columns[:1])


def test_casts_called_safe_are_safe(spark):
    kinds = "tinyint smallint int bigint float double decimal(20,0) decimal(38,10) decimal(5,2) date timestamp timestamp_ntz boolean".split()
    extremes = {
        "tinyint": ["-128", "127"],
        "smallint": ["-32768", "32767"],
        "int": ["-2147483648", "2147483647"],
        "bigint": [str(-(2**63)), str(2**63 - 1)],
        "float": ["3.4e38", "NaN", "-Infinity"],
        "double": ["1.7e308", "NaN", "-Infinity"],
        "decimal(20,0)": ["9" * 20],
        "decimal(38,10)": ["9" * 28 + "." + "9" * 10],
        "decimal(5,2)": ["999.99"],
        "date": ["0001-01-01", "9999-12-31"],
        "timestamp": ["0001-01-02 00:00:00", "9999-12-30 23:59:59"],
        "timestamp_ntz": ["0001-01-01 00:00:00", "9999-12-31 23:59:59"],
        "boolean": ["true"],
    }
    for source in kinds:
        frame = spark.createDataFrame([(v,) for v in extremes[source]], "v string").select(F.col("v").cast(source))
        kind = frame.schema["v"].dataType
        safe = [t for t in map(types.parse_type, kinds) if never_fails(kind, t)]
        row = frame.select(*[F.count(conformed(F.col("v"), kind, t)).alias(str(i)) for i, t in enumerate(safe)]).first()
        assert set(row) == {len(extremes[source])}, source
