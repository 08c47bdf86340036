"""A corpus pipeline over ``documents``: quality, near duplicates, benchmark leaks, secrets, mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; all but the last return the columns of ``documents``. Between
stages the rows are written as Parquet to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelake.llm import decontaminate, mixing, ngramjoin, quality, secrets
from scorelake.llm.store import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on this input without labels."""
    return quality.keep_good(docs, quality.train(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return ngramjoin.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in place; n_chars follows the text."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes."""
    return mixing.mix(docs)


STAGES = [("quality_classifier", good_quality), ("ngram_jaccard_join", one_of_each_group),
          ("benchmark_decontamination", without_benchmark), ("secret_scan", without_secrets),
          ("source_mixing", mixed_sources)]

#: Weak-label training and the scorer have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
