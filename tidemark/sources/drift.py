"""How the types of JSON values differ from record to record."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Paths of a whole record, and the type of a line that is none.
ROOT, BROKEN = "$", "BROKEN"


def _schema(text: str | None) -> T.DataType | None:
    """The type that Spark gives for variants, by Spark's own type parser: their objects are its structs."""
    if text is None:
        return None
    # names stand in back-quotes if they are no plain words
    plain = re.sub(r"`(?:[^`]|``)*`|\bOBJECT(?=<)", lambda found: found[0] if found[0][0] == "`" else "STRUCT", text)
    return T.DataType.fromDDL(plain)


def _child(value: Column, name: str) -> Column:
    quote = "'" if "'" not in name else '"'
    return F.try_variant_get(value, f"$[{quote}{name}{quote}]", "variant")


def _kind(value: Column) -> Column:
    """The outermost type of a variant, without its parts or digits; NULL where there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)


def _found(value: Column, path: str, schema: T.DataType) -> Column:
    """An array of (path, type) for a value and all that is in it; a path that a record lacks has none."""
    own = F.array(F.struct(F.lit(path).alias("path"), _kind(value).alias("type")))
    found = [F.when(value.isNotNull(), own).otherwise(F.expr("array()").cast("array<struct<path:string,type:string>>"))]
    if isinstance(schema, T.StructType):
        found += [_found(_child(value, field.name), f"{path}.{field.name}", field.dataType) for field in schema.fields]
    elif isinstance(schema, T.ArrayType):
        items = F.coalesce(value.try_cast("array<variant>"), F.expr("array()").cast("array<variant>"))
        found.append(F.flatten(F.transform(items, lambda item: _found(item, f"{path}[]", schema.elementType))))
    return reduce(lambda a, b: F.concat(a, b), found)


def _objects(value: Column) -> Column:
    """A value where it is an object."""
    return F.when(_kind(value) == "OBJECT", value)


def _complete(lines: DataFrame, schema: T.DataType, path: tuple[str, ...] = ()) -> T.DataType:
    """The schema with objects where objects are mixed with other types, which Spark's merged schema leaves open."""
    value = reduce(_child, path, F.col("value"))
    if isinstance(schema, T.StructType):
        fields = [T.StructField(f.name, _complete(lines, f.dataType, (*path, f.name))) for f in schema.fields]
        return T.StructType(fields)
    if isinstance(schema, T.VariantType):
        merged = _schema(lines.agg(F.schema_of_variant_agg(_objects(value)).alias("s")).first()["s"])
        return _complete(lines, merged, path) if isinstance(merged, T.StructType) else schema
    return schema


def json_drift(spark: SparkSession, paths: str | list[str], recursive: bool = True) -> DataFrame:
    """Path, type, n_records: for each path in JSON lines the types that its values have, and how many records each.

    A record counts once for a path and type, also where an array has several such values; ``[]`` stands for an
    array's items. Lines that are no JSON count as BROKEN at the root, blank lines not at all. One pass finds the
    paths, another counts; where objects are mixed with other types a further one looks into them. Mixed items of an
    array are counted by their outermost type.
    """
    text = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(paths).where("trim(value) <> ''")
    lines = text.select(F.try_parse_json("value").alias("value"))
    merged = _schema(lines.agg(F.schema_of_variant_agg("value").alias("s")).first()["s"])
    whole = _complete(lines, merged if merged is not None else T.VariantType())
    broken = F.array(F.struct(F.lit(ROOT).alias("path"), F.lit(BROKEN).alias("type")))
    found = F.when(F.col("value").isNull(), broken).otherwise(F.array_distinct(_found(F.col("value"), ROOT, whole)))
    counted = lines.select(F.explode(found).alias("of")).groupBy("of.path", "of.type")
    return counted.agg(F.count("*").alias("n_records"))
