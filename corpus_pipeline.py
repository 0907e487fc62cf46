"""A corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), reads all rows its predecessor kept and
returns a DataFrame; run() writes each result to the shared folder and reads it
again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.frames import written
from feedloom.llm import decontaminate, lines, mixing, simhash, toxicity
from feedloom.llm.common import free_name, word_count


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7; the model learns from labels outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").filter(~toxicity.held_out("doc_id", 3, 1))
    score = free_name(docs.columns, "score")
    text = free_name(docs.columns, "scored")
    model = toxicity.fit(docs, labels)
    found = toxicity.scored(docs.withColumn(text, F.col("text")), model, text, score)
    return found.filter(F.col(score) < 0.7).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words or more.

    n_chars follows the text. A document that had words and keeps none goes.
    """
    removed = free_name(docs.columns, "removed")
    found = lines.without_repeats(docs, removed=removed)
    emptied = (F.col(removed) > 0) & (word_count(F.col("text")) == 0)
    n_chars = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return (
        found.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
        .filter(~emptied)
        .select(*docs.columns)
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return simhash.deduplicated(docs).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as drawn, with its copy number and its source's target."""
    return mixing.emitted(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
]

# A trained model, XXH64 and greedy tiling have no SQL; tests run a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
