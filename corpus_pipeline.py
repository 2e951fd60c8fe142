"""The corpus pipeline: five stages over ``documents``, each one's rows written and read by the next.

run(spark, sf_dir) returns the last stage's rows: the documents that the mix takes, with their words.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontam, mixing, quality, secrets, simhash
from marketloom.llm.common import learned, shared_dir, table
from marketloom.llm.queries import ACCEPT
from marketloom.sources import lake


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, by the text alone: equal texts, repeated rows and rows with null ids
    share their fate.  Null texts count as empty ones.  An empty table gives an empty one."""
    machine = quality.learn(docs, table(spark, sf_dir, "labels"), learned("doc_id", 5))
    name = "score"
    while name in docs.columns:
        name += "_"
    return quality.score(docs, machine, output=name).where(F.col(name) >= ACCEPT).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-copies (5-word shingles, similarity of 0.8 or more), as ``simhash`` tells them.

    Rows count by all of their columns: different texts under one doc_id, or under null, are different rows.
    Texts that are null, empty or without words are one group; an empty table gives an empty one.
    """
    return simhash.without_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item; null and empty texts stay, repeated rows share their fate."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; every secret is replaced in the text, and n_chars follows the text.

    Rows without secrets stay as they are: null and empty texts, and their n_chars, too.  Repeated rows stay repeated.
    """
    columns = docs.columns
    text = secrets.redacted(F.col("text"), F.col("spans"))
    # The scan replaces a column of the name "spans", so one of the documents goes through under another.
    aside = "spans_"
    while aside in columns:
        aside += "_"
    found = secrets.scan(docs.withColumnRenamed("spans", aside)).withColumn("text", text)
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        found = found.withColumn(
            "n_chars", F.when(F.size("spans") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return found.select(*(F.col(aside if c == "spans" else f"`{c}`").alias(c) for c in columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the mix takes, with size, source_size, target and taken; input columns of those names are replaced.

    Texts that are null or without words take nothing.  A null source is a source.  An empty table gives an empty one.
    """
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Near-copies and the fitted classifier have no SQL; tests/llm/plain.py runs the five stages plainly, row by row.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    for name, _ in STAGES[:-1]:  # the last one's rows are what is returned
        lake.delete(spark, f"{folder}/{name}")
    return docs
