"""The training-data pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, packing.

Each stage gets the documents that its predecessor kept, written as Parquet
and read again, and returns the columns of ``documents``; the last returns
packed pieces.  ORACLE_SQL is None: the stages fit models and hash in ways that
SQL does not express.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelake.llm import common, cuckoo, mixing, packing, simhash, toxicity

#: Shares of expected tokens; every document stays at least once, and wanted ones are repeated as often as the shares take.
MIX_TARGETS = {"clean": 0.96, "low": 0.04}
SHINGLE, MAX_BITS = 3, 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go."""
    return toxicity.drop_toxic(docs, common.read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the greatest id stays."""
    return cuckoo.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of linked fingerprints, the row with the least id stays."""
    return simhash.drop_near_duplicates(docs, SHINGLE, MAX_BITS)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of wanted domains are repeated towards the target shares; none is lost."""
    return mixing.mix(docs, mixing.quality_domains(common.read(spark, sf_dir, "labels")), MIX_TARGETS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, one row per piece of a document."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
          ("mixing", mix_to_targets), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all documents; each stage's rows are written to the shared folder and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
