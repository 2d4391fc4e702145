"""A training corpus from the documents table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``docs``, the last with its shard besides.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyspark.llm import decontam, mixing, quality, sharding, simhash
from plyspark.llm.runtime import Scratch, free


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Documents whose score is ``threshold`` or more; the model learns from the labels of all of them.

    A null text scores as an empty one; repeated rows stay or go together; rows with a null doc_id are scored, not learned from.
    """
    model, name = quality.fit(docs, _table(spark, sf_dir, "labels")), free("quality", docs)
    return quality.score(docs, model, name).where(F.col(name) >= threshold).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id; rows without doc_id stay, texts without words are one group."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return decontam.remove(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the mix takes them (0, 1 or 2 times); those without words aren't taken; a null source is one of its own."""
    return mixing.repeated(docs, mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as read back from target-sized shards, each with its shard_id (``_shard_id`` where documents have that name); rows are kept as they are."""
    store = sharding.shard(docs, Scratch(spark, "corpus").root)
    return store.read(with_shard=True).select(*docs.columns, free("shard_id", docs))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]

#: A trained network, alignments and groups by link are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            scratch.drop(f"stage-{k - 1}")
    return docs
