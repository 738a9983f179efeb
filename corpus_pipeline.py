"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage takes all rows its predecessor kept and, but for the last, returns the columns of ``documents``;
n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.functions.lineage import store
from cellspark.llm import decontaminate, lines, packing, quality, simhash


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later copies of repeated line runs are cut out of the texts; every row stays."""
    cut = lines.dedup_lines(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a hit go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the place of every piece of every document."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: The classifier and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
