"""The training-data operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from cdcstrata.llm import (
    conversations,
    line_dedup,
    merkle,
    mixing,
    near_texts,
    near_vectors,
    oracle,
    pieces,
    quality,
    secrets,
    shards,
    syncmers,
    token_files,
    toxicity,
)
from cdcstrata.llm.batches import bound_batches
from cdcstrata.llm.vocabularies import vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return bound_batches(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.compared(table(spark, folder, "documents"))


def op2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.write_and_read(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_texts.jaccard_join(table(spark, folder, "documents"))


def op6_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(table(spark, folder, "documents"))


def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.assign(table(spark, folder, "documents"), shards=8)


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(table(spark, folder, "documents"))


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damage(table(spark, folder, "conversations"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_syncmers,
        op2_pieces,
        op3_token_files,
        op4_quality,
        op5_jaccard_join,
        op6_near_vectors,
        op7_mixing,
        op8_toxicity,
        op9_secrets,
        op10_shards,
        op11_merkle,
        op12_conversations,
        op13_line_dedup,
    )
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return oracle.oracle_sql() | whole
