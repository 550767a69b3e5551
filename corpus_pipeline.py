"""From documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor
kept.  Its result is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.llm import align, packing, quality, simhash, spans
from tablecraft.plans.registry import Tables
from tablecraft.plans.storage import written
from tablecraft.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return quality.keep_good(docs, Tables(tune(spark), sf_dir).labels)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of linked fingerprints."""
    tune(spark)
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut sentences that an earlier document holds in the same surroundings."""
    tune(spark)
    return spans.cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a copy of a test item."""
    return align.drop_contaminated(docs, Tables(tune(spark), sf_dir).benchmark)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    tune(spark)
    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids"))
    return packing.pack(written(parts.drop("ids"), "pieces"), ["doc_id", "piece"])


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Trees, fingerprints, alignments and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(tune(spark), sf_dir).documents
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
