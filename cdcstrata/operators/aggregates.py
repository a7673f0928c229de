"""Aggregates that are the same for every table. All of them pre-aggregate on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcstrata.functions.scalars import percent
from cdcstrata.operators.selection import exact_quantiles
from cdcstrata.sources.scratch import release, store


def sum_or_zero(c: Column | str) -> Column:
    """Sum with NULL taken as 0, so a group without any value yields 0."""
    return F.sum(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)))


def sums(columns: Sequence[str] | Mapping[str, str]) -> list[Column]:
    """``sum_or_zero`` for every column; a mapping is output name -> input column."""
    pairs = columns.items() if isinstance(columns, Mapping) else ((c, c) for c in columns)
    return [sum_or_zero(src).alias(out) for out, src in pairs]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))


def rows_by_year(df: DataFrame) -> DataFrame:
    return value_counts(df, "year")


def with_percent(grouped: DataFrame, count: str = "cnt", name: str = "percent", few: bool = False) -> DataFrame:
    """Add each group's share of the total.

    The total is a scalar subquery, so the groups never gather in one task the way they do under a window
    without partitions. That computes the groups twice; pass ``few`` where their number is fixed and small,
    such as the branches of a CASE, to use the window instead.
    """
    total = F.sum(count).over(Window.partitionBy()) if few else grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(name, percent(F.col(count), total))


_PROFILE = "column string, count bigint, mean double, stddev double, min {kind}, p25 double, p50 double, p75 double, max {kind}"
_QUARTILES = (0.25, 0.5, 0.75)


def numeric_profile(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """One row per column: count, mean, stddev, min, quartiles, max.

    Quartiles are exact and interpolated. They are found by distributed selection, in a few passes over a stored copy of
    the columns, and no task holds more than a sketch; that runs when the profile is asked for. With ``accuracy``
    they come from a mergeable sketch with relative rank error 1/accuracy, in one pass and with nothing stored. All
    columns are profiled together. Minimum and maximum keep the columns' type where they share a whole-number one
    and are doubles otherwise. NaN is not a value.
    """
    kinds = dict(df.select(*columns).dtypes)
    whole = {c: kinds[c] in ("tinyint", "smallint", "int", "bigint") for c in columns}
    kind = "bigint" if all(whole.values()) else "double"
    typed = df.select(
        *[F.col(c).cast("bigint") if whole[c] else F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns]
    )
    if accuracy is not None:
        return _sketched_profile(typed, columns, kind, accuracy)
    spark, path = df.sparkSession, store(typed, "profile")
    stored = spark.read.schema(typed.schema).parquet(path)
    stats = stored.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast(kind).alias("min"),
                F.max(c).cast(kind).alias("max"),
                (F.kll_sketch_agg_bigint if whole[c] else F.kll_sketch_agg_double)(c).alias("sketch"),
            ).alias(f"c{k}")
            for k, c in enumerate(columns)
        ]
    ).first()
    sketches = {
        c: ("bigint" if whole[c] else "double", bytes(stats[k]["sketch"] or b""), stats[k]["count"])
        for k, c in enumerate(columns)
    }
    quartiles = exact_quantiles(stored, _QUARTILES, sketches)
    rows = [
        (c, s["count"], s["mean"], s["stddev"], s["min"], *quartiles[c], s["max"]) for c, s in zip(columns, stats, strict=True)
    ]
    release(spark, path)
    return spark.createDataFrame(rows, _PROFILE.format(kind=kind))


def _sketched_profile(df: DataFrame, columns: Sequence[str], kind: str, accuracy: int) -> DataFrame:
    stats = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast(kind).alias("min"),
            F.percentile_approx(c, list(_QUARTILES), accuracy).cast("array<double>").alias("quartiles"),
            F.max(c).cast(kind).alias("max"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*stats).alias("stats")).select(F.inline("stats"))
    return rows.select(
        "column",
        "count",
        "mean",
        "stddev",
        "min",
        F.col("quartiles")[0].alias("p25"),
        F.col("quartiles")[1].alias("p50"),
        F.col("quartiles")[2].alias("p75"),
        "max",
    )


def field_coverage(df: DataFrame, columns: Sequence[str], by: str = "year") -> DataFrame:
    """Rows per group and, for every column, how many of them are filled (``has_<column>``)."""
    filled = [F.count(c).alias(f"has_{c}") for c in columns]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("total"), *filled)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order; Spark keeps k rows per task instead of sorting everything.

    Pass an order without ties, or the cut is not repeatable.
    """
    return df.orderBy(*order).limit(k)


def sort_for_export(df: DataFrame, *order: Column | str) -> DataFrame:
    """Global sort, by default newest year first, then type, then newest report.

    For files people read. Table writes do not need it: it costs a range exchange.
    """
    keys = order or (F.desc("year"), F.asc("report_type"), F.desc("report_id"))
    return df.orderBy(*keys)
