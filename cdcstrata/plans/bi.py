"""Dashboard queries over the marts.

Marts hold a row per report, so a company has up to five rows a year. Joining marts on (bin, year) as they
are would multiply sums; every side is therefore summed to one row per join key first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.scalars import percent
from cdcstrata.operators import bitmaps
from cdcstrata.operators.aggregates import top_k
from cdcstrata.operators.predicates import positive


def _per_company(mart: DataFrame, *columns: str) -> DataFrame:
    return mart.groupBy("bin", "year").agg(*[F.sum(c).alias(c) for c in columns])


def yearly_dashboard(general_indicators: DataFrame, tax_benefits: DataFrame, employees: DataFrame) -> DataFrame:
    """Per year: companies, investments, exports, tax saved and staff of the companies in the headline mart.

    Every mart is reduced to a row per (bin, year) before it is joined.
    """
    g = general_indicators.groupBy("bin", "year").agg(
        F.sum("total_funding").alias("total_funding"), F.sum("export_income").alias("export_income")
    )
    t = _per_company(tax_benefits, "total_tax_saved")
    e = _per_company(employees, "residents_count")
    joined = g.join(t, ["bin", "year"], "left").join(e, ["bin", "year"], "left")
    return joined.groupBy("year").agg(
        F.count("bin").alias("companies_count"),
        F.sum("total_funding").alias("total_investments"),
        F.sum("export_income").alias("total_exports"),
        F.sum("total_tax_saved").alias("total_tax_saved"),
        F.sum("residents_count").alias("total_employees"),
    )


def company_detail(
    general_indicators: DataFrame, tax_benefits: DataFrame, employees: DataFrame, tin: str | None = None
) -> DataFrame:
    """Per company and year, its figures from three marts; ``tin`` picks one company before the joins."""
    if tin is not None:
        general_indicators, tax_benefits, employees = (
            m.filter(F.col("bin") == tin) for m in (general_indicators, tax_benefits, employees)
        )
    g = general_indicators.groupBy("bin", "year").agg(
        F.max("company_name").alias("company_name"),
        F.sum("income_total").alias("income_total"),
        F.sum("export_income").alias("export_income"),
        F.sum("total_funding").alias("total_funding"),
    )
    t = _per_company(tax_benefits, "total_tax_saved")
    e = _per_company(employees, "residents_count", "nonresidents_count")
    return g.join(t, ["bin", "year"], "left").join(e, ["bin", "year"], "left")


def export_share(export_by_country: DataFrame, general_indicators: DataFrame, year: int | None = None) -> DataFrame:
    """Export per country as a percentage of the company's income in the same report period."""
    if year is not None:
        export_by_country = export_by_country.filter(F.col("year") == year)
        general_indicators = general_indicators.filter(F.col("year") == year)
    key = ["bin", "year", "report_type"]
    e = export_by_country.groupBy(*key, "country").agg(
        F.max("company_name").alias("company_name"), F.sum("export_income").alias("export_income")
    )
    g = general_indicators.groupBy(*key).agg(F.sum("income_total").alias("income_total"))
    return e.join(g, key).withColumn("export_share_percent", percent("export_income", "income_total"))


def top_countries(export_by_country: DataFrame, year: int | None = None, k: int = 10) -> DataFrame:
    """Countries with the largest exports, with the number of exporting companies."""
    rows = export_by_country if year is None else export_by_country.filter(F.col("year") == year)
    totals = rows.groupBy("country").agg(
        F.sum("export_income").alias("total_export"), F.countDistinct("bin").alias("companies_count")
    )
    return top_k(totals, k, F.desc_nulls_last("total_export"), F.asc("country"))


def exporter_bitmaps(export_by_country: DataFrame, ids: DataFrame) -> DataFrame:
    """Which companies exported to each country in each year: ``year``, ``country``, ``piece``, ``bits``.

    Store it by year: a year that is refreshed gives new rows for itself alone.
    """
    return bitmaps.distinct_bitmaps(export_by_country, ["year", "country"], "bin", ids)


def exporters_between(stored: DataFrame, first: int, last: int) -> DataFrame:
    """Companies that exported to each country in a range of years, from the stored bitmaps alone."""
    years = stored.filter(F.col("year").between(first, last))
    return bitmaps.counted(bitmaps.merged_bitmaps(years, ["country"]), ["country"], "companies_count")


def exporters_of_ranges(stored: DataFrame, ranges: DataFrame) -> DataFrame:
    """The same for many ranges at once: ``first_year``, ``last_year``, ``country``, ``companies_count``."""
    keys = ["first_year", "last_year", "country"]
    years = ranges.withColumn("year", F.explode(F.sequence("first_year", "last_year")))
    held = years.join(stored, "year")
    return bitmaps.counted(bitmaps.merged_bitmaps(held, keys), keys, "companies_count")


def export_countries_by_year(export_by_country: DataFrame) -> DataFrame:
    return export_by_country.groupBy("year").agg(
        F.count(F.lit(1)).alias("cnt"), F.countDistinct("country").alias("countries")
    )


def top_funding(financing: DataFrame, k: int = 10) -> DataFrame:
    """Reports with the largest funding; ties are cut by the remaining columns."""
    columns = ["year", "report_type", "certificate_number", "bin", "total_funding", "attracted_investments", "loan_funds"]
    rest = [F.asc_nulls_last(c) for c in columns if c != "total_funding"]
    return top_k(positive(financing, "total_funding").select(*columns), k, F.desc("total_funding"), *rest)


def top_identities(silver: DataFrame, year: int | None = None, k: int = 10) -> DataFrame:
    """The most frequent (company number, name) pairs, to spot identities that masking merged."""
    rows = silver if year is None else silver.filter(F.col("year") == year)
    pairs = rows.groupBy("company_tin", "company_name").agg(F.count(F.lit(1)).alias("cnt"))
    return top_k(pairs, k, F.desc("cnt"), F.asc_nulls_last("company_tin"), F.asc_nulls_last("company_name"))
