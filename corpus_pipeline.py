"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read as the next one's input.

Rows go for three reasons only: toxicity (score of 0.5 or more), being a near copy of a kept document, and holding
a benchmark item. Secrets are masked within their documents. The mix then says how often to read each document and leaves
out those with no copies. All stages but the last return the columns of their input. Nulls, repeated rows, empty
tables and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import crc_mod, table, written
from strataflow.llm.decontaminate import drop_contaminated
from strataflow.llm.mixing import mix
from strataflow.llm.secret_scan import mask_secrets
from strataflow.llm.simhash import drop_near_duplicates
from strataflow.llm.toxicity import drop_toxic, train_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier finds toxic; it learns from the labelled ones among ``docs``."""
    usable = crc_mod(F.col("doc_id"), 5) != 0
    return drop_toxic(docs, train_toxicity(docs, table(spark, sf_dir, "labels"), usable=usable))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near copies."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, with its values or others."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return mask_secrets(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often, and their source's target."""
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
]

#: SQL has no form of the classifier, the hashes of the near copies or the random mix.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
