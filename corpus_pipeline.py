"""The training-data pipeline: a row of documents in, packed token sequences out.

Stages, each over all that the one before kept:

1. quality       rejects what the weak-label quality classifier scores below 0.5
2. near_copies   keeps the document with the least id of each group linked by 5-word shingles at a similarity of 0.8
3. benchmark     drops documents that hold a 10-word window of a benchmark item
4. mixing        draws documents by source weight, 150 % of all words in total; a document that is drawn twice has two rows;
                 rows are placed by shard and shuffled within it
5. packing       tokenises and packs into sequences of 2,048 ids

Null or empty texts don't pass the first stage; columns of documents, extra ones too and whatever their names, pass through to the fourth.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomline.llm import decontaminate, jaccard, mixing, packing, quality
from loomline.llm.common import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained weights, seeded hashes and tokens can't be had in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
