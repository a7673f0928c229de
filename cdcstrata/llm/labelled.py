"""Bounded samples of labelled documents for the trained operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """The CRC-32 of doc_id as text, modulo; null for a null doc_id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def held_out(modulus: int, remainder: int) -> Column:
    return F.coalesce(fold(modulus) == remainder, F.lit(False))


@dataclass
class Sample:
    """Texts by label, and how many rows of either label there are to learn from in all."""

    texts: tuple[list[str], list[str]]
    ids: tuple[list[int], list[int]]
    rows: tuple[int, int]

    @property
    def share(self) -> float:
        """Of label 1 among all labelled rows; a half where there are none, and never quite 0 or 1."""
        return (self.rows[1] + 1) / (sum(self.rows) + 2)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    remainder: int,
    per_label: int,
    most_chars: int,
    text: str = "text",
) -> Sample:
    """At most ``per_label`` texts of either label, none held out and none of over ``most_chars`` characters.

    Labelled rows are counted and ranked by a hash of their id in the narrow label table; only the chosen ids meet the
    documents. An id whose labels contradict each other, and a null label, teach nothing; of an id with several texts
    the least one is taken.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(modulus, remainder))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .filter("label = most")
        .select("doc_id", "label")
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    spark = docs.sparkSession
    chosen = [
        (r["doc_id"], value)
        for value in (0, 1)
        for r in known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label).collect()
    ]
    ids = spark.createDataFrame(chosen, "doc_id bigint, label int")
    rows = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(ids), "doc_id")  # 2 * per_label ids at most
        .filter(F.col("text").isNotNull() & (F.char_length("text") <= most_chars))
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))  # one text an id, however often it comes: 2 * per_label rows
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    by_label = [[r for r in rows if r["label"] == value][:per_label] for value in (0, 1)]
    texts, ids = (tuple([r[name] for r in some] for some in by_label) for name in ("text", "doc_id"))
    return Sample(texts, ids, (counts.get(0, 0), counts.get(1, 0)))
