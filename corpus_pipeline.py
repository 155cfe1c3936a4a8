"""From raw documents to packed training sequences: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination and best-fit packing, in that order.

Each stage takes what its predecessor wrote and returns what the next one reads. The first four return the columns of
documents; the last returns one row for each piece of a document with its sequence.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rosterlake.llm import decontam, lines, packing, quality, queries, simhash
from rosterlake.llm.common import table
from rosterlake.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go: those that fail any rule of the current policy. Null and empty texts fail."""
    return quality.apply_policy(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; every document stays. Copies, which are still there, count as one page."""
    return lines.drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits stays, the one with the smallest id."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece, with its place in a sequence."""
    packed = packing.pack(packing.pieces(docs, queries.tokenizer_file()))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express fingerprints, window similarity and token ids; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each stage's rows are written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for at, (name, stage) in enumerate(STAGES, 1):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{at}-{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
