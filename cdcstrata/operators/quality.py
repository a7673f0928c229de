"""Data-quality audits."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cdcstrata.functions.scalars import MASK_PREFIX, is_blank, is_masked
from cdcstrata.operators.aggregates import with_percent


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, cnt) for every table; each is a count-only scan."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class WrittenRows:
    """How many rows a run wrote to each table and read from each log, counted by the writing jobs themselves.

    A count is part of the job that writes, so it costs no scan. It is put on top of what the writer gets, where a task
    counts once, however often it is tried; counts of what is read stand below a shuffle, and count again what a lost
    executor had to read again.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def of(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows, counted under ``name`` when they are written. A name counts for one action."""
        seen = self._seen[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("cnt"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """(table_name, cnt) of all names, once their jobs are through; waits for those that run."""
        rows = [(name, seen.get["cnt"]) for name, seen in self._seen.items()]
        return spark.createDataFrame(rows, "table_name string, cnt bigint")


def status_buckets(
    df: DataFrame, bucket, name: str, income: str | None = None, share: bool = False
) -> DataFrame:
    """Rows per branch of a CASE column, optionally with an income sum and the share of all rows."""
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if income is not None:
        aggs.append(F.sum(income).alias("total_income"))
    out = df.groupBy(bucket.alias(name)).agg(*aggs)
    return with_percent(out, few=True) if share else out


def masking_coverage(
    mart: DataFrame, column: str = "bin", prefix: str = MASK_PREFIX, income: str | None = None
) -> DataFrame:
    """How many identifiers are masked, with their share."""
    bucket = F.when(is_masked(column, prefix), "MASKED").otherwise("REAL")
    return status_buckets(mart, bucket, "bin_status", income, share=True)


def blank_audit(
    mart: DataFrame,
    column: str,
    name: str = "fill_status",
    *,
    detail: bool = False,
    columns: Sequence[str] = ("year", "bin", "company_name"),
) -> DataFrame:
    """Filled against empty rows with shares; with ``detail`` the empty rows themselves."""
    if detail:
        return mart.filter(is_blank(column)).select(*columns)
    bucket = F.when(is_blank(column), "EMPTY").otherwise("FILLED")
    return status_buckets(mart, bucket, name, share=True)


def row_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before, rows after, rows removed."""
    return (
        table_counts({"before": before, "after": after})
        .groupBy()
        .agg(
            F.sum(F.when(F.col("table_name") == "before", F.col("cnt"))).alias("rows_before"),
            F.sum(F.when(F.col("table_name") == "after", F.col("cnt"))).alias("rows_after"),
        )
        .withColumn("removed", F.col("rows_before") - F.col("rows_after"))
    )


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The input, guarded: its evaluation fails with a clear error if a key repeats.

    Costs one aggregate over the keys and is meant for the small side of a join.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).agg(F.max("cnt")).scalar()
    guard = F.assert_true(F.coalesce(repeated, F.lit(0)) <= 1, F.lit(f"keys {list(keys)} are not unique"))
    return df.filter(guard.isNull())
