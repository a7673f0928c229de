"""Exact distinct counts that can be merged: bitmaps over dense ids.

Every value gets a small number of its own, once and for all. What is stored a group is not how many values it has but
which ones, as a bit each, in pieces of 32,768 bits. Groups are merged by OR, and counted at the end, so one stored table
answers for any set of groups, where distinct counts themselves cannot be added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.operators.numbering import numbered


def extended_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """The numbers of all values seen: those in ``known`` as they are, new ones counted on from the greatest.

    Returns ``column`` and ``number``, from 1. NULL has no number.
    """
    fresh = values.select(column).filter(F.col(column).isNotNull()).distinct()
    if known is None:
        return numbered(fresh, [column])
    fresh = fresh.join(known, column, "left_anti")
    last = known.agg(F.max("number")).first()[0] or 0
    return known.select(column, "number").unionByName(numbered(fresh, [column], start=last + 1))


def distinct_bitmaps(rows: DataFrame, keys: Sequence[str], column: str, ids: DataFrame) -> DataFrame:
    """``keys``, ``piece`` and ``bits``: which values of the column each group has. Groups without a value have no row.

    Pairs are made distinct on the map side before they meet their number.
    """
    pairs = rows.select(*keys, column).filter(F.col(column).isNotNull()).distinct().join(ids, column)
    piece = F.bitmap_bucket_number("number")
    return pairs.groupBy(*keys, piece.alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def merged_bitmaps(bitmaps: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """How many values each group has; one row a piece is summed."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
