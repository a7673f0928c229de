"""Rows in one global order, cut into ranges of near-equal size, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cdcstrata.sources.scratch import materialise, release, store

#: The white space that the contracts of the line and conversation operators name.
BLANKS = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Text of single bytes takes the built-in way, which does just that there."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def ranged(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows stored in order, with ``part`` (the range) and ``place``, which ascends with the order.

    ``place`` is the part times 2**33 plus the row's number in it, gapless from 0. The rows are stored once before, so that
    the bounds are drawn from a table and not from a second run of what made the rows, and given a number that
    parts equal ones: repeats of one key, or of one row, are spread over as many ranges as they fill.
    """
    spark = rows.sparkSession
    path = store(rows.withColumn("__salt", F.monotonically_increasing_id()), f"{name}-rows")
    stored = spark.read.schema(StructType([*rows.schema, StructField("__salt", LongType())])).parquet(path)
    keys = [*order, "__salt"]
    placed = (
        stored.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("place", 33).cast("int"))
        .drop("__salt")
    )
    out = materialise(placed, f"{name}-ranges")
    release(spark, path)
    return out


def ranked(rows: DataFrame, group: str, order: Sequence[str | Column], name: str) -> DataFrame:
    """The rows with ``rank``, gapless from 0 in their group, and ``n``, the group's rows. A null group is one like any other.

    A group of any size is spread over ranges. What is summed in order is one row for each range that a group lies in.
    """
    placed = ranged(rows, [F.col(group), *order], name)
    before = Window.partitionBy("__group").orderBy("__part")
    offsets = (
        placed.groupBy(F.col(group).alias("__group"), F.col("part").alias("__part"))
        .agg(F.min("place").alias("__first"), F.count(F.lit(1)).alias("__rows"))
        .withColumn("__before", F.sum("__rows").over(before) - F.col("__rows"))
        .withColumn("n", F.sum("__rows").over(Window.partitionBy("__group")))
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col("part") == F.col("__part"))
    joined = placed.join(offsets, same)
    rank = F.col("place") - F.col("__first") + F.col("__before")
    return joined.select(*rows.columns, rank.alias("rank"), "n")
