"""What several text operators need: written steps, whole texts as bytes, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quoted
from tidemark.workspace import shared_folder


def written(frame: DataFrame) -> DataFrame:
    """The frame, written as Parquet to the folder that all executors share, and read again.

    Cuts the lineage: what follows can be read by any executor, whichever one is lost.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm_{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def digest_of_text(column: str = "text") -> Column:
    """The SHA-256 of the text as it came, in hex digits; null is empty."""
    return F.sha2(whole_text(column), 256)


def id_text(doc_id: Column) -> Column:
    """An id as text, empty for null, so that it joins and groups like any other value."""
    return F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))


def one_row_each(docs: DataFrame, kept: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """One row of ``docs`` for each row of ``kept``, whose columns are the ``keys``; keys must not be null.

    Rows travel whole in one column beside their keys, so that no column of ``docs`` can clash. The rows of a key
    lie together after the join, so that the choice among them needs no further shuffle.
    """
    whole = F.struct(*(F.col(quoted(c)) for c in docs.columns))
    rows = docs.select(whole.alias("row"), *(key.alias(name) for name, key in keys.items()))
    found = rows.join(kept.select(*keys).distinct(), list(keys), "left_semi")
    first = F.min_by("row", F.xxhash64(F.coalesce("row.text", F.lit("")))).alias("row")
    return found.groupBy(*keys).agg(first).select(*(F.col(f"row.{quoted(c)}") for c in docs.columns))


def few_rows(batches, rows: int = 256):
    """The rows of Arrow batches, a few at a time, so that a batch of any size takes little memory beside itself."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any one orderable type to (node, root): root is the smallest node reachable.

    Large and small star steps in turn, each written before the next, until the edges stay the same. An edge set
    never grows, hubs are aggregated before the shuffle, and joins on a hub can be split at run time.
    """
    edges = written(edges.where("a <> b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
