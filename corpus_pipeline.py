"""The training corpus: documents through five operators, each stage over what the last kept.

``run`` writes every stage but the last as Parquet to the folder that driver and executors share
and reads it again for the next one. There is no SQL for the whole: SimHash, suffix arrays,
nearest neighbours and flows have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm import external_shuffle, flow_mix, simhash, suffix_decontaminate, toxicity
from ticksmith.llm.queries import SHARDS, WEIGHTS, shard_digest
from ticksmith.llm.shared import written

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.keep_clean(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    return simhash.keep_one(docs, words=3, bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go."""
    return suffix_decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    packed = docs.select(F.struct("*").alias("whole"), "doc_id", "text", "source")
    mixed, _ = flow_mix.mix(packed, F.array("source"), WEIGHTS)
    return flow_mix.repeated(mixed).select("whole.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return shard_digest(external_shuffle.shuffle_into_shards(docs, SHARDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
