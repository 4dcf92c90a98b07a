"""Token counts of the documents in flat token files that have no index, by a scan for separators."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.common import few_rows, written
from tidemark.workspace import shared_folder

#: Bytes that are read and searched at once, and blocks that one window of the prefix scan has.
BLOCK, RUN = 4 << 20, 1024
TASK_BYTES = 64 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (mounted, HDFS or object store) and the path in it."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def write_tokens(docs: DataFrame, folder: str, path: str, pattern: str, separator: int, width: int) -> DataFrame:
    """Write each task's documents to a flat file, each followed by the separator; returns (file, place, doc_id).

    Tokens are little-endian integers of ``width`` bytes; ids that do not fit, and a separator that a token has or
    that does not fit, are an error before anything is written. A task that runs again writes another file; only
    files in the result count. A null text has no tokens.
    """
    ranks = bpe.shared_ranks(docs, path)
    bpe.check_ids(bpe.encoder(ranks.value, pattern).ranks, path, separator, width)
    kind = f"<u{width}"
    end = np.array([separator], kind).tobytes()

    def run(batches):
        # encoded and written by the same worker, so that a core has one
        encode = bpe.encoder(ranks.value, pattern).encode
        name, place, out = f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}.tokens", 0, None
        for batch in few_rows(batches):
            if out is None:
                system, inside = opened(folder)
                out = system.open_output_stream(f"{inside}/{name}")
            for found in encode(batch.column("text").to_pylist()):
                out.write(np.frombuffer(found, "<u4").astype(kind).tobytes() + end)
            n = batch.num_rows
            places = pa.array(range(place, place + n), pa.int64())
            place += n
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), places, batch.column("doc_id")], ["file", "place", "doc_id"])
        if out is not None:
            out.close()

    system, inside = opened(folder)
    system.create_dir(inside)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return written(rows.mapInArrow(run, "file string, place long, doc_id long"))


def separators(blocks, separator: int, width: int, block: int):
    """For (uri, block, bytes of the file) the positions of the separators in the block, in tokens of the file."""
    held, data = "", None
    for batch in blocks:
        rows = []
        for uri, number, length in zip(*(c.to_pylist() for c in batch.columns)):
            if uri != held:
                system, inside = opened(uri)
                held, data = uri, system.open_input_file(inside)
            start = number * block
            size = min(block, length - length % width - start)
            tokens = np.frombuffer(data.read_at(size, start), f"<u{width}")
            rows.append((uri, number, start // width + np.flatnonzero(tokens == separator), (start + size) // width))
        columns = zip(*rows) if rows else ([], [], [], [])
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["uri", "block", "at", "upto"])


def count_tokens(spark: SparkSession, folder: str, separator: int, width: int, block: int = BLOCK) -> DataFrame:
    """One row per document in the ``*.tokens`` files of a folder: file, place, start, n_tokens, terminated.

    ``place`` and ``start`` count documents and tokens from 0 in the file. Documents end before a separator;
    tokens after the last one are a document that is not terminated, and so is nothing else. Bytes after the last
    whole token are ignored. A file without bytes has no documents. Blocks are searched on their own; a prefix
    scan, first within runs of blocks and then over the runs, gives each block the documents before it and where
    the one began that it continues. So neither a large file nor a long document is held by one task.
    """
    block -= block % width
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    files = files.select(F.col("path").alias("uri"), "length").where(F.col("length") >= width)
    whole = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, whole // TASK_BYTES + 1)
    last = F.floor((F.col("length") - F.lit(width)) / block)
    blocks = files.select("uri", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "length")
    found = written(
        blocks.repartition(tasks, "uri", "block").sortWithinPartitions("uri", "block")
        .mapInArrow(lambda b: separators(b, separator, width, block), "uri string, block long, at array<long>, upto long")
        .withColumn("run", F.floor(F.col("block") / RUN))
    )

    before = Window.partitionBy("uri", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = found.groupBy("uri", "run").agg(F.sum(F.size("at")).alias("n"), F.max(F.try_element_at("at", F.lit(-1))).alias("last"), F.max("upto").alias("upto"))
    earlier = Window.partitionBy("uri").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("uri", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.max("last").over(earlier).alias("last0"))
    here = found.select(
        "uri", "run", "at", F.coalesce(F.sum(F.size("at")).over(before), F.lit(0)).alias("n1"), F.max(F.try_element_at("at", F.lit(-1))).over(before).alias("last1")
    )
    stitched = here.join(runs, ["uri", "run"]).select(
        "uri", "at", (F.col("n0") + F.col("n1")).alias("n"), F.coalesce("last1", "last0", F.lit(-1)).alias("last")
    )
    starts = F.transform("at", lambda at, i: F.when(i == 0, F.col("last")).otherwise(F.get("at", i - 1)) + 1)
    ended = stitched.select("uri", "n", F.posexplode(F.arrays_zip(F.col("at").alias("at"), starts.alias("start"))))
    ended = ended.select(
        "uri", (F.col("n") + F.col("pos")).alias("place"), F.col("col.start").alias("start"),
        (F.col("col.at") - F.col("col.start")).alias("n_tokens"), F.lit(True).alias("terminated"),
    )
    files = found.groupBy("uri").agg(F.sum(F.size("at")).alias("place"), (F.coalesce(F.max(F.try_element_at("at", F.lit(-1))), F.lit(-1)) + 1).alias("start"), F.max("upto").alias("upto"))
    open_end = files.where("upto > start").select("uri", "place", "start", (F.col("upto") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated"))
    file = F.element_at(F.split("uri", "/"), -1).alias("file")
    return ended.unionByName(open_end).select(file, "place", "start", "n_tokens", "terminated")


def documents_counted(docs: DataFrame, path: str, pattern: str, separator: int, width: int = 2) -> DataFrame:
    """(doc_id, n_tokens) of each row of ``docs``, written to flat files and counted there.

    Repeated rows and rows without a doc_id count each; a null text has 0 tokens. Other columns are not read. An
    empty table writes no file and gives no rows.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens_{uuid.uuid4().hex}"
    index = write_tokens(docs, folder, path, pattern, separator, width)
    return index.join(count_tokens(spark, folder, separator, width), ["file", "place"]).select("doc_id", "n_tokens")
