"""Swaps of partitions in several tables that are all done or done again.

What goes into the tables is staged first, by the partitions that are replaced, and the plan of the swaps written down in the shared folder. A plan counts once
Spark's mark of success is there. Then the swaps run, each replacing whole partitions by staged rows, so a plan that
is cut off can be run again from the start; when it is through, it is deleted with what it staged. Until it is written,
no table is touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.sources import writers
from cdcstrata.sources.scratch import release, scratch_root, store

_SCHEMA = "step int, table string, rows string, hit string, fmt string"


@dataclass(frozen=True)
class Swap:
    """Partitions of ``table`` listed in ``hit`` become ``rows``."""

    table: str
    rows: DataFrame
    hit: DataFrame
    fmt: str = "parquet"


def _place(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/pending-{name.replace('.', '-')}"


def _is_written(spark: SparkSession, place: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def swap_all(spark: SparkSession, name: str, swaps: Sequence[Swap]) -> None:
    """Stage all swaps, write the plan down under ``name``, run it. One plan of a name is open at a time."""
    resume(spark, name)
    plan = []
    for step, swap in enumerate(swaps):
        typed = [F.col(f.name).cast(f.dataType) for f in spark.table(swap.table).schema]
        rows = store(swap.rows.select(*typed), f"{name}-{step}", swap.hit.columns)
        hit = store(swap.hit, f"{name}-{step}-hit")
        plan.append((step, swap.table, rows, hit, swap.fmt))
    spark.createDataFrame(plan, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(_place(spark, name))
    resume(spark, name)


def resume(spark: SparkSession, name: str) -> bool:
    """Run the open plan of a name, if there is one; call it before anything reads the tables to change them."""
    place = _place(spark, name)
    if not _is_written(spark, place):
        return False
    plan = sorted(spark.read.schema(_SCHEMA).parquet(place).collect(), key=lambda s: s["step"])
    for s in plan:
        rows = spark.read.schema(spark.table(s["table"]).schema).parquet(s["rows"])
        writers.swap_partitions(spark, s["table"], rows, spark.read.parquet(s["hit"]), s["fmt"], True)
    release(spark, place, *[p for s in plan for p in (s["rows"], s["hit"])])
    return True
