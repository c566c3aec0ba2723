"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, mixing and sharding.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet into the shared folder and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``, and any further ones.

Null and empty texts fail the quality rules, so later stages see none of them in a run; each stage by itself gives them
the result that its operator states. Repeated rows are near duplicates, of which one stays. Very long texts are handled
whole by every stage. An empty table runs through all stages and gives an empty manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantlink.llm import decontaminate, mixing, quality, sharding, simhash
from grantlink.llm.common import keep, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.drop_low_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that of the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more lies in benchmark windows go; those without words stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; those of sources below their target weight occur again, once per further epoch."""
    return mixing.mixed_documents(docs)


def sharding_by_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard manifest: a row for each row of the mixed stream, equal texts together."""
    return sharding.shard(docs)


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup), ("benchmark_decontamination", decontamination), ("mixing", mixing_to_weights), ("sharding", sharding_by_bytes)]

#: SQL expresses neither XXH64 fingerprints nor best-fit packing; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = keep(docs) if n < len(STAGES) - 1 else docs
    return docs
