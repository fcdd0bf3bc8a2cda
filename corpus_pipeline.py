"""A corpus pipeline: clean, deduplicate, decontaminate, mix and shard ``documents``.

Each stage takes what its predecessor kept, written as Parquet and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tussock.llm.decontam import without_leaks
from tussock.llm.jaccard import one_of_each
from tussock.llm.mixing import mixed_rows
from tussock.llm.sharding import shard
from tussock.llm.store import stored
from tussock.llm.toxicity import clean_rows

N_SHARDS = 24


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below the threshold of their language."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return clean_rows(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a Jaccard similarity of 0.8."""
    return one_of_each(docs, percent=80, n=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a repeated document is a repeated row."""
    return mixed_rows(docs, weights=(5, 2, 1), cap=3)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every row of the mix."""
    return shard(docs, n_shards=N_SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: No SQL: the first stage is a trained classifier. Tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
