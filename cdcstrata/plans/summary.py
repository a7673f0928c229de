"""Summaries per period, per year and per participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.payload import parse_payload
from cdcstrata.functions.periods import period_label
from cdcstrata.functions.scalars import to_bigint
from cdcstrata.operators.aggregates import sum_or_zero, sums
from cdcstrata.operators.predicates import (
    FIRST_YEAR,
    not_deleted,
    quarters_only,
    report_filter,
    signed,
)
from cdcstrata.plans import fields as fl

# Output column -> payload field.
PERIOD_SUMS = {
    "total_residents": "residents_count",
    "total_nonresidents": "nonresidents_count",
    "total_gph": "gph_count",
    "total_income": "income_total",
    "total_income_international": "income_international",
    "total_investments": "main_capital_investments",
    "total_tax_incentives": "tax_incentives",
    "total_investor_amount": "investor_amount",
    "total_loans": "finance_source_loan",
    "total_government_support": fl.SUPPORT_OLD,
}
REGISTRY_SUMS = (
    "residents_count",
    "nonresidents_count",
    "income_total",
    "income_international",
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    *fl.LOANS,
    fl.SUPPORT_OLD,
    "finance_source_investment",
    "investor_amount",
    "tax_incentives",
)
QUARTER_SUMS = (
    "residents_count",
    "nonresidents_count",
    "income_total",
    "income_international",
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    *fl.LOANS,
    fl.SUPPORT_OLD,
    fl.SUPPORT_NEW,
    "finance_source_investment",
    "tax_incentives",
    "total_tax_saved",
)
ANNUAL_SUMS = (
    "residents_count",
    "nonresidents_count",
    "income_total",
    "income_international",
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    *fl.LOANS,
    fl.SUPPORT_OLD,
    "finance_source_investment",
    "investor_amount",
)
ANNUAL_TAX_SUMS = fl.TAXES[1:]


def period_summary(
    cdc: DataFrame,
    style: str = "en",
    year: int | None = None,
    report_type: str | None = None,
    *,
    start_year: int | None = FIRST_YEAR,
) -> DataFrame:
    """Per (year, report type) straight from the log: count, ten sums and a readable period."""
    rows = parse_payload(cdc.filter(report_filter(year, report_type, start_year)), PERIOD_SUMS.values())
    measures = rows.select(
        "year",
        "report_type",
        *[fl.typed("doc", f, fl.STAFF).alias(f) for f in PERIOD_SUMS.values()],
    )
    out = measures.groupBy("year", "report_type").agg(
        F.count(F.lit(1)).alias("reports_count"), *sums(PERIOD_SUMS)
    )
    return out.withColumn("period", period_label("report_type", "year", style))


def registry_summary(base: DataFrame, year: int) -> DataFrame:
    """Per report type for the one year the base was read for: count, twelve sums, period."""
    rows = parse_payload(base, REGISTRY_SUMS)
    staff = ("residents_count", "nonresidents_count")
    measures = rows.select("report_type", *[fl.typed("doc", f, staff).alias(f) for f in REGISTRY_SUMS])
    out = measures.groupBy("report_type").agg(F.count(F.lit(1)).alias("total"), *sums(REGISTRY_SUMS))
    return out.withColumn("year", F.lit(year)).withColumn("period", period_label("report_type", year, "ru_long"))


def with_missing(df: DataFrame, columns) -> DataFrame:
    """Older and newer report tables differ by the support measure; an absent column counts as NULL."""
    absent = {c: F.lit(None).cast("bigint") for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def quarter_rows(silver: DataFrame) -> DataFrame:
    """The report rows that a quarter summary counts."""
    return with_missing(signed(not_deleted(silver)), QUARTER_SUMS)


def quarter_summary(silver: DataFrame) -> DataFrame:
    """Per (year, report type) over signed report rows: count, thirteen sums, short period."""
    out = quarter_rows(silver).groupBy("year", "report_type").agg(
        F.count(F.lit(1)).alias("total_reports"), *sums(QUARTER_SUMS)
    )
    return out.withColumn("period", period_label("report_type", "year", "ru_short"))


def annual_rows(silver: DataFrame) -> DataFrame:
    """The report rows that an annual summary counts."""
    return with_missing(quarters_only(signed(silver)), (*ANNUAL_SUMS, "total_tax_saved"))


def taxes_saved(taxes: str) -> Column:
    if taxes == "incentives":
        return F.col("tax_incentives")
    if taxes == "saved_first":
        return F.coalesce("total_tax_saved", "tax_incentives")
    raise ValueError(f"taxes must be 'incentives' or 'saved_first', not {taxes!r}")


def annual_summary(silver: DataFrame, year: int | None = None, taxes: str = "incentives") -> DataFrame:
    """Per (participant, year) over signed quarters: number of quarters and sixteen sums.

    ``taxes="saved_first"`` counts the reported saving where there is one and the incentives otherwise.
    """
    rows, saved = annual_rows(silver), taxes_saved(taxes)
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    return rows.groupBy("service_request_id", "year").agg(
        F.count(F.lit(1)).alias("signed_quarters"),
        *sums(ANNUAL_SUMS),
        sum_or_zero(saved).alias("taxes_saved"),
        *sums(ANNUAL_TAX_SUMS),
    )


def annual_totals(annual: DataFrame) -> DataFrame:
    """The annual summary rolled up by year."""
    return annual.groupBy("year").agg(
        F.count(F.lit(1)).alias("companies_count"),
        F.sum("signed_quarters").alias("total_signed_quarters"),
        F.sum("income_total").alias("total_income"),
        F.sum("income_international").alias("total_export"),
        F.sum("taxes_saved").alias("total_taxes_saved"),
    )


def year_total(cdc: DataFrame, year: int) -> DataFrame:
    """One row for one year of signed versions, not ranked; the sum is NULL where nothing can be added."""
    rows = parse_payload(signed(cdc).filter(F.col("year") == year), ["income_total"])
    return rows.agg(
        F.count(F.lit(1)).alias("total_reports"),
        F.sum(to_bigint("doc.income_total")).alias("income_total"),
    )


def tax_by_year(tax_benefits: DataFrame) -> DataFrame:
    return tax_benefits.groupBy("year").agg(
        F.sum("kpn").alias("total_kpn"),
        F.sum("nds").alias("total_nds"),
        F.sum("ipn").alias("total_ipn"),
        F.sum("sn").alias("total_sn"),
        F.sum("total_tax_saved").alias("total_saved"),
    )


def staff_by_year(employees: DataFrame) -> DataFrame:
    return employees.groupBy("year").agg(
        F.sum("residents_count").alias("total_residents"),
        F.sum("nonresidents_count").alias("total_non_residents"),
        F.sum("gph_count").alias("total_civil_contracts"),
    )


def mart_totals(mart: DataFrame, by: str | None = None) -> DataFrame:
    """Totals of the report mart: per year or per report type, or with no ``by`` over everything."""
    grouped = mart.groupBy(by) if by else mart.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("reports"),
        sum_or_zero("income_total").alias("income_total"),
        sum_or_zero("income_international").alias("income_international"),
        sum_or_zero("tax_incentives").alias("tax_incentives"),
        sum_or_zero("residents_count").alias("residents_count"),
    )

