"""A corpus pipeline of five of the operators: quality, near duplicates, benchmarks, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents.  ``run`` writes each stage's rows as Parquet into the shared checkpoint folder and reads
them back, so that lineage is cut and a lost executor costs one stage's tasks at most; a stage's rows
are deleted once the next one's are written, and what a stage cuts on its way once its own are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontaminate, mixing, ngram_join, quality, secret_scan
from plumbline.llm.common import Cut, prepare, table
from plumbline.session import scratch


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near duplicates."""
    return ngram_join.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets replaced by a mark."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample at target weights, with topic, n_tokens and probability."""
    return mixing.mix_to_targets(docs).where("kept").drop("kept")


STAGES = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", clean_of_benchmarks),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
]

#: The quality stage learns its scores, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, cut = table(spark, sf_dir, "documents"), Cut(spark)
    for _, stage in STAGES:
        with scratch(spark):
            docs = cut(stage(spark, docs, sf_dir))
        cut.drop(keep=1)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
