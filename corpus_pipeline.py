"""A training corpus from raw documents, in five stages.

Every stage reads what the one before it kept, whole. All but the last return the columns of ``documents``. The methods
are not expressible in SQL (nearest examples, chosen paths, checksums, drawn blocks, tokenizers), so ``ORACLE_SQL`` is None
and the tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.llm import mixing, near_texts, pieces, secrets, toxicity
from cdcstrata.llm.batches import bound_batches
from cdcstrata.llm.vocabularies import vocabulary
from cdcstrata.sources.scratch import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by the labels of the folder."""
    labels = bound_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs.select(*COLUMNS), labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links connect: that of the least id, then of the least text. Rows without an id stay.

    Rows are stored with a number of their own and compared by it, so rows that share an id and hold different texts are
    rows of different groups, unless a link joins them.
    """
    bound_batches(spark)
    rows = docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id())
    rows = materialise(rows, "corpus-rows")
    named = rows.filter(F.col("doc_id").isNotNull())
    groups = near_texts.jaccard_join(named.select(F.col("__row").alias("doc_id"), "text"))
    order = F.struct("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text"), "__row")
    first = (
        groups.select(F.col("doc_id").alias("__row"), "class_id")
        .join(named.select("__row", order.alias("order")), "__row")
        .groupBy("class_id")
        .agg(F.min("order").alias("first"))
        .select("first.__row")
    )
    kept = named.join(first, "__row", "left_semi")
    return kept.unionByName(rows.filter(F.col("doc_id").isNull())).select(*COLUMNS)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each secret in it replaced by a note of its kind."""
    bound_batches(spark)
    clean = secrets.scan(docs, carry=("doc_id", "lang", "source"))
    clean = clean.withColumnRenamed("clean", "text").withColumn("n_chars", F.char_length("text").cast("bigint"))
    return clean.select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each draw of a document, in its output shard's shuffled order within every written file."""
    mixed = mixing.mix(docs.select(*COLUMNS))
    mixed = mixed.repartition("shard", "position_key").sortWithinPartitions("shard", "position_key")
    return mixed.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every drawn text, with the check that they decode to it."""
    bound_batches(spark)
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", remove_secrets),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is stored in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
