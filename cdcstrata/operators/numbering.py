"""Gapless numbers along a global order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcstrata.sources.scratch import materialise


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "number", start: int = 1) -> DataFrame:
    """The rows with their number in the order, stored. Pass an order without ties, or reruns differ.

    Rows are cut into ranges and sorted in each; the rows of each range are counted, and the counts, one a range, summed up.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__place", 33).cast("int"))
    )
    placed = materialise(placed, "numbered")
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(offsets, "__part")
        .withColumn(name, (F.col("__before") + within + F.lit(start)).cast("bigint"))
        .select(*df.columns, name)
    )
