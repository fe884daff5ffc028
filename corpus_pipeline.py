"""The corpus pipeline: quality rules, near-dedup, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every stage's rows as
Parquet in the shared folder and rereads them for the next one, so that no stage is ever computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscan.llm.common import scratch_dir
from gridscan.llm.mixing import mix
from gridscan.llm.packing import pack
from gridscan.llm.quality_rules import quality_filter
from gridscan.llm.simhash import simhash_dedup
from gridscan.llm.suffix_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject."""
    return quality_filter(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near copies."""
    return simhash_dedup(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out that repeat earlier ones; n_chars follows the new text."""
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    top = scratch_dir(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
    return docs


#: Hashes that DuckDB lacks decide in several stages, so there is no SQL; the tests hold it against brute force.
ORACLE_SQL = None
