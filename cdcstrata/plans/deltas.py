"""Stored summaries that are kept up by signed contributions of the rows that changed.

A summary is additive: a count and sums over rows, grouped by keys of which the year is one. The old version of every changed
row contributes -1 times its figures and the new version +1 times; the contributions are summed per group and added to
the stored summary. A group whose count falls to 0 vanishes. Only the years of groups with a contribution are read
and rewritten, whatever the size of the rest. Rows that count twice, in two groups or in none need no thought: each side
goes through the summary's own filter, so a draft that is signed, a delete or a move to another year are all alike.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcstrata.functions.periods import period_label
from cdcstrata.plans import summary
from cdcstrata.sources.pending import Swap

PARTITION = "year"


@dataclass(frozen=True)
class Additive:
    """A summary of ``rows(table)`` by ``keys``: how many there are, and the sums of ``measures``, NULL taken as 0.

    A measure is a column's name or a function that gives a column.
    ``rollups`` names further tables, each made by a function from the summary's rows of whole years.
    """

    keys: tuple[str, ...]
    rows: Callable[[DataFrame], DataFrame]
    count: str
    measures: Mapping[str, str | Callable[[], Column]]
    rollups: Mapping[str, Callable[[DataFrame], DataFrame]] = field(default_factory=dict)

    @property
    def figures(self) -> list[str]:
        return [self.count, *self.measures]

    def contributions(self, table: DataFrame, sign: int = 1) -> DataFrame:
        """What the rows of a table add to each group, or with ``sign=-1`` take from it."""
        counted = self.rows(table)
        columns = {n: F.col(c) if isinstance(c, str) else c() for n, c in self.measures.items()}
        sums = [F.sum(F.lit(sign) * F.coalesce(c, F.lit(0))).cast("bigint").alias(n) for n, c in columns.items()]
        return counted.groupBy(*self.keys).agg(F.sum(F.lit(sign)).cast("bigint").alias(self.count), *sums)

    def added(self, *parts: DataFrame) -> DataFrame:
        """Figures of all parts summed by key."""
        rows = reduce(DataFrame.unionByName, parts)
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.figures])

    def full(self, table: DataFrame) -> DataFrame:
        return self.contributions(table).filter(F.col(self.count) > 0)

    def delta(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Groups that change, with what changes."""
        rows = self.added(self.contributions(old, -1), self.contributions(new))
        return rows.filter(reduce(Column.__or__, [F.col(c) != 0 for c in self.figures]))


def of_years(table: DataFrame, years: Sequence[int | None]) -> DataFrame:
    """Rows of the named years, by a filter that prunes partitions; None stands for the NULL year."""
    year, named = F.col(PARTITION), [y for y in years if y is not None]
    wanted = year.isin(*named) if named else F.lit(False)
    return table.filter(wanted | year.isNull() if None in years else wanted)


def swaps(spark: SparkSession, table: str, spec: Additive, delta: DataFrame) -> list[Swap]:
    """The swaps that bring a stored summary and its rollups up to date. ``delta`` is read more than once: store it.

    The years of the delta, a few, reach the driver, so that the others are pruned from the plan.
    """
    hit = delta.select(PARTITION).distinct()
    years = [r[PARTITION] for r in hit.collect()]
    stored = of_years(spark.table(table), years).select(*spec.keys, *spec.figures)
    rows = spec.added(stored, delta).filter(F.col(spec.count) > 0)
    out = [Swap(table, rows, hit)]
    for name, roll in spec.rollups.items():
        out.append(Swap(name, roll(rows), hit))
    return out


QUARTER = Additive(
    ("year", "report_type"),
    summary.quarter_rows,
    "total_reports",
    {c: c for c in summary.QUARTER_SUMS},
)


def quarter_labels(stored: DataFrame) -> DataFrame:
    """The stored quarter summary with its period, which is text made from the keys and not stored."""
    return stored.withColumn("period", period_label("report_type", "year", "ru_short"))


def annual(taxes: str = "incentives", totals: str | None = None) -> Additive:
    """The annual summary; ``totals`` names a table for its rollup by year."""
    measures = {c: c for c in summary.ANNUAL_SUMS} | {"taxes_saved": partial(summary.taxes_saved, taxes)}
    measures |= {c: c for c in summary.ANNUAL_TAX_SUMS}
    rollups = {totals: summary.annual_totals} if totals else {}
    return Additive(("service_request_id", "year"), summary.annual_rows, "signed_quarters", measures, rollups)
