"""From raw documents to packed training sequences, each stage written before the next reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.text import quoted
from tidemark.llm import exact_dedup, packing, simhash, suffix_dedup, toxicity
from tidemark.llm.common import written  # noqa: F401
from tidemark.workspace import new_database

#: The tokenizer of the sequences, what ends a document, and the tokens of a sequence.
RANKS, SEPARATOR, SEQUENCE = "byte_bpe_50k.tiktoken", 50256, 4096


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go.

    Null and empty texts, and all documents where no label is known, stay; repeated rows are judged alike.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the row with the most code points stays, then the smallest id.

    Null counts as empty, and a null id comes last; of rows that agree in all of this one stays.
    """
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that SimHash links, one row with the smallest id stays; null ids come last.

    Texts without words, null ones too, are linked to each other.
    """
    return simhash.one_of_each(docs, shingle=3, distance=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has are cut out; all documents stay.

    Null texts become empty, and a null id counts as larger than any other.
    """
    return suffix_dedup.without_repeats(docs, length=50)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: the tokens of the documents in bins, and which pieces of which documents these are.

    Every document ends with a separator, so empty and null texts have one token; repeated rows and rows without
    an id are documents of their own.
    """
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return packing.token_sequences(docs, path, pattern, SEPARATOR, SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

#: SQL expresses none of the stages; the tests run each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other. What a stage has written goes when the next one has written its own."""
    docs, database = spark.read.parquet(f"{sf_dir}/documents.parquet"), quoted(new_database(spark, "pipeline"))
    before = None
    for name, stage in STAGES:
        table = f"{database}.{quoted(name)}"
        stage(spark, docs, sf_dir).write.format("parquet").saveAsTable(table)
        docs = spark.table(table)
        if before is not None:
            spark.sql(f"DROP TABLE {before}")
        before = table
    return docs
