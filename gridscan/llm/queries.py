"""The operators' queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, fingerprint, mixing, packing, quality_mil, quality_rules, simhash, suffix_dedup, token_files, warc
from .common import scratch_dir
from .oracles import ORACLE_SQL as ORACLE_SQL


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that lie in a 100-byte string which starts earlier too, counted and cut out; odd rows as in ``repeat_report``."""
    return suffix_dedup.repeat_report(_documents(spark, sf_dir))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back; odd rows as in ``format_conversations``."""
    said = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(chat_format.format_conversations(turns.unionByName(extra)))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learned from the labels outside the held-out fold; odd rows as in ``quality_scores``."""
    return quality_mil.quality_scores(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of all sources takes; odd rows as in ``mix_plan``."""
    return mixing.mix_plan(_documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives in the shared folder and read back from them; odd rows as in ``write_warc``."""
    uri = scratch_dir(spark, "warc")
    manifest = warc.write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), uri)
    return warc.read_warc(manifest, uri).drop("url")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' pieces in sequences of at most 2048 ids; odd rows as in ``pack``."""
    return packing.pack(_documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written to files in the shared folder and read back from them; odd rows as in ``write_token_files``."""
    return token_files.token_round_trip(_documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, and likenesses; odd rows as in ``fingerprint_report``."""
    return fingerprint.fingerprint_report(_documents(spark, sf_dir))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 64-bit SimHash and the component that links at 2 bits connect it to; odd rows as in ``simhash_groups``."""
    return simhash.simhash_groups(_documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules for every document; odd rows as in ``quality_report``."""
    return quality_rules.quality_report(_documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (op1_suffix_dedup, op2_chat_formatting, op3_quality_classifier, op4_mixing, op5_warc, op6_packing, op7_token_files, op8_fingerprints, op9_simhash, op10_quality_rules)
}
