"""Payload fields of a report, their types, and the column lists of the tables made from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcstrata.functions.scalars import text_to_bigint, to_int

# Names of payload fields, as they appear in the JSON.
STAFF = ("residents_count", "nonresidents_count", "gph_count")
INCOME = (
    "income_total",
    "income_international",
    "income_total_current_quarter",
    "income_total_previous_quarter",
)
CAPITAL = (
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    "main_tangible_capital_investments",
    "main_intangible_capital_investments",
)
LOANS = ("finance_source_loan", "finance_source_loan_foreign")
SUPPORT_OLD = "finance_source_government"
SUPPORT_NEW = "government_support_measures"
TAXES = (
    "tax_incentives",
    "tax_incentives_kpn",
    "tax_incentives_nds",
    "tax_incentives_ipn",
    "tax_incentives_sn",
)
EXPORT_CURRENT = "income_international_current_quarter"
EXPORT_PREVIOUS = "income_international_previous_quarter"
FLAGS = ("has_nonresidents", "has_borrowed_funds", "has_raised_investors_funds")

# Payload fields that hold numbers; every other field is taken as text.
NUMERIC = frozenset(
    (
        *STAFF,
        *INCOME,
        "income_local",
        "income_to_collect",
        "investments_total_current_quarter",
        *CAPITAL,
        *LOANS,
        SUPPORT_OLD,
        SUPPORT_NEW,
        "finance_source_investment",
        "investor_amount",
        *TAXES,
        "total_tax_saved",
        "collection_amount",
    )
)

# Columns of the log itself that every report table starts with.
ENVELOPE = (
    "service_request_id",
    "year",
    "report_type",
    "status",
    "op",
    "version",
    "created_at",
    "updated_at",
    "signed_at",
    "author_id",
)

# Payload columns per table (identity columns company_tin and company_name are resolved apart).
SILVER_BASIC = (
    "certificate_number",
    "oked",
    *STAFF,
    "income_total",
    "income_international",
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    *LOANS,
    SUPPORT_NEW,
    "finance_source_investment",
    "investor_amount",
    "investor_country_company",
    *TAXES,
)
SILVER_REPORT = (
    "certificate_number",
    "oked",
    *STAFF,
    *INCOME,
    "investments_total_current_quarter",
    *CAPITAL,
    *LOANS,
    SUPPORT_NEW,
    "finance_source_investment",
    "investor_amount",
    "investor_country_company",
    *TAXES,
    "total_tax_saved",
    "collection_amount",
    "activity_fields",
)
SILVER_NATURAL_KEY = (*[f for f in SILVER_REPORT if f != "activity_fields"], EXPORT_CURRENT, EXPORT_PREVIOUS)
SILVER_PREVIEW = (
    "certificate_number",
    "oked",
    *STAFF,
    *INCOME,
    *CAPITAL,
    *LOANS,
    SUPPORT_OLD,
    "finance_source_investment",
    "investor_amount",
    "investor_country_company",
    *TAXES,
    "total_tax_saved",
)
SILVER_BY_ID = (
    "certificate_number",
    "activity_fields",
    "income_total",
    "income_total_current_quarter",
    "income_international",
    "income_local",
    "investments_total_current_quarter",
    "finance_source_loan",
    "finance_source_increase_authorized_capital",
    "finance_source_investment",
    *TAXES[1:],
    "total_tax_saved",
    SUPPORT_NEW,
    *STAFF,
    "investor_country_company",
)
REPORT_MART = (
    "company_name",
    "company_tin",
    "certificate_number",
    *STAFF,
    *INCOME,
    "investments_total_current_quarter",
    *CAPITAL,
    "investor_amount",
    "investor_country_company",
    *LOANS,
    SUPPORT_OLD,
    "finance_source_investment",
    *TAXES,
    "collection_amount",
    "oked",
    "executor_fullname",
    "executor_phone",
    *FLAGS,
)
DEDUPED_MART = (
    "company_tin",
    "company_name",
    "certificate_number",
    "oked",
    *STAFF,
    "income_total",
    "income_international",
    "finance_source_increase_authorized_capital",
    "main_capital_investments",
    *LOANS,
    SUPPORT_OLD,
    "finance_source_investment",
    "investor_amount",
    "investor_country_company",
    *TAXES,
)
# Reduced cuts of the report mart, by number of columns.
REPORT_MART_25 = (
    "report_id",
    "year",
    "report_type",
    "status",
    "signed_at",
    "version",
    "created_at",
    "updated_at",
    "service_request_id",
    "author_id",
    "company_name",
    "company_tin",
    "certificate_number",
    *STAFF,
    "income_total",
    "income_international",
    "main_capital_investments",
    "investor_amount",
    "finance_source_loan",
    SUPPORT_OLD,
    "tax_incentives",
    "oked",
    "executor_fullname",
)
REPORT_MART_27 = (
    *REPORT_MART_25,
    "finance_source_increase_authorized_capital",
    "finance_source_loan_foreign",
)
REPORT_MART_28 = (*REPORT_MART_27, "cdc_operation")


def typed(doc: str, field: str, ints: Iterable[str] = ()) -> Column:
    """A payload field with its type: BIGINT for numbers (INT where asked), text otherwise."""
    name = f"{doc}.{field}"
    if field in ints:
        return to_int(name)
    return text_to_bigint(name) if field in NUMERIC else F.col(name)
