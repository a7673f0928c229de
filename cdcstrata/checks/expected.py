"""What the tables hold, stated once more for the checks: columns, their sources and order.

Nothing here is taken from the code under test, so an entry that changes there turns a row red."""

from __future__ import annotations

# Columns of the log, of the payload, and of every table.
ENVELOPE = (
    "service_request_id", "year", "report_type", "status", "op", "version", "created_at", "updated_at", "signed_at",
    "author_id",
)
STAFF = (
    "residents_count", "nonresidents_count", "gph_count",
)
FLAGS = (
    "has_nonresidents", "has_borrowed_funds", "has_raised_investors_funds",
)
SILVER_BASIC = (
    "certificate_number", "oked", "residents_count", "nonresidents_count", "gph_count", "income_total",
    "income_international", "finance_source_increase_authorized_capital", "main_capital_investments",
    "finance_source_loan", "finance_source_loan_foreign", "government_support_measures", "finance_source_investment",
    "investor_amount", "investor_country_company", "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds",
    "tax_incentives_ipn", "tax_incentives_sn",
)
SILVER_REPORT = (
    "certificate_number", "oked", "residents_count", "nonresidents_count", "gph_count", "income_total",
    "income_international", "income_total_current_quarter", "income_total_previous_quarter",
    "investments_total_current_quarter", "finance_source_increase_authorized_capital", "main_capital_investments",
    "main_tangible_capital_investments", "main_intangible_capital_investments", "finance_source_loan",
    "finance_source_loan_foreign", "government_support_measures", "finance_source_investment", "investor_amount",
    "investor_country_company", "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn",
    "tax_incentives_sn", "total_tax_saved", "collection_amount", "activity_fields",
)
SILVER_NATURAL_KEY = (
    "certificate_number", "oked", "residents_count", "nonresidents_count", "gph_count", "income_total",
    "income_international", "income_total_current_quarter", "income_total_previous_quarter",
    "investments_total_current_quarter", "finance_source_increase_authorized_capital", "main_capital_investments",
    "main_tangible_capital_investments", "main_intangible_capital_investments", "finance_source_loan",
    "finance_source_loan_foreign", "government_support_measures", "finance_source_investment", "investor_amount",
    "investor_country_company", "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn",
    "tax_incentives_sn", "total_tax_saved", "collection_amount", "income_international_current_quarter",
    "income_international_previous_quarter",
)
SILVER_PREVIEW = (
    "certificate_number", "oked", "residents_count", "nonresidents_count", "gph_count", "income_total",
    "income_international", "income_total_current_quarter", "income_total_previous_quarter",
    "finance_source_increase_authorized_capital", "main_capital_investments", "main_tangible_capital_investments",
    "main_intangible_capital_investments", "finance_source_loan", "finance_source_loan_foreign",
    "finance_source_government", "finance_source_investment", "investor_amount", "investor_country_company",
    "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn", "tax_incentives_sn",
    "total_tax_saved",
)
SILVER_BY_ID = (
    "certificate_number", "activity_fields", "income_total", "income_total_current_quarter", "income_international",
    "income_local", "investments_total_current_quarter", "finance_source_loan",
    "finance_source_increase_authorized_capital", "finance_source_investment", "tax_incentives_kpn",
    "tax_incentives_nds", "tax_incentives_ipn", "tax_incentives_sn", "total_tax_saved", "government_support_measures",
    "residents_count", "nonresidents_count", "gph_count", "investor_country_company",
)
REPORT_MART = (
    "company_name", "company_tin", "certificate_number", "residents_count", "nonresidents_count", "gph_count",
    "income_total", "income_international", "income_total_current_quarter", "income_total_previous_quarter",
    "investments_total_current_quarter", "finance_source_increase_authorized_capital", "main_capital_investments",
    "main_tangible_capital_investments", "main_intangible_capital_investments", "investor_amount",
    "investor_country_company", "finance_source_loan", "finance_source_loan_foreign", "finance_source_government",
    "finance_source_investment", "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn",
    "tax_incentives_sn", "collection_amount", "oked", "executor_fullname", "executor_phone", "has_nonresidents",
    "has_borrowed_funds", "has_raised_investors_funds",
)
REPORT_MART_25 = (
    "report_id", "year", "report_type", "status", "signed_at", "version", "created_at", "updated_at",
    "service_request_id", "author_id", "company_name", "company_tin", "certificate_number", "residents_count",
    "nonresidents_count", "gph_count", "income_total", "income_international", "main_capital_investments",
    "investor_amount", "finance_source_loan", "finance_source_government", "tax_incentives", "oked",
    "executor_fullname",
)
REPORT_MART_27 = (
    "report_id", "year", "report_type", "status", "signed_at", "version", "created_at", "updated_at",
    "service_request_id", "author_id", "company_name", "company_tin", "certificate_number", "residents_count",
    "nonresidents_count", "gph_count", "income_total", "income_international", "main_capital_investments",
    "investor_amount", "finance_source_loan", "finance_source_government", "tax_incentives", "oked",
    "executor_fullname", "finance_source_increase_authorized_capital", "finance_source_loan_foreign",
)
REPORT_MART_28 = (
    "report_id", "year", "report_type", "status", "signed_at", "version", "created_at", "updated_at",
    "service_request_id", "author_id", "company_name", "company_tin", "certificate_number", "residents_count",
    "nonresidents_count", "gph_count", "income_total", "income_international", "main_capital_investments",
    "investor_amount", "finance_source_loan", "finance_source_government", "tax_incentives", "oked",
    "executor_fullname", "finance_source_increase_authorized_capital", "finance_source_loan_foreign", "cdc_operation",
)
DEDUPED_MART = (
    "company_tin", "company_name", "certificate_number", "oked", "residents_count", "nonresidents_count", "gph_count",
    "income_total", "income_international", "finance_source_increase_authorized_capital", "main_capital_investments",
    "finance_source_loan", "finance_source_loan_foreign", "finance_source_government", "finance_source_investment",
    "investor_amount", "investor_country_company", "tax_incentives", "tax_incentives_kpn", "tax_incentives_nds",
    "tax_incentives_ipn", "tax_incentives_sn",
)
SUPPORT_OLD = "finance_source_government"
SUPPORT_NEW = "government_support_measures"
EXPORT_CURRENT = "income_international_current_quarter"
EXPORT_PREVIOUS = "income_international_previous_quarter"
# Mart column -> payload field.
INDICATORS = {
    "activity_fields": "activity_fields",
    "government_support": "government_support_measures",
    "tax_saved": "total_tax_saved",
    "export_income": "income_international",
    "total_funding": "investments_total_current_quarter",
    "income_total": "income_total",
    "income_total_current_quarter": "income_total_current_quarter",
}
FINANCING = {
    "government_support": "government_support_measures",
    "loan_funds": "finance_source_loan",
    "authorized_capital_increase": "finance_source_increase_authorized_capital",
    "total_funding": "investments_total_current_quarter",
}
TAX_BENEFITS = {
    "kpn": "tax_incentives_kpn",
    "nds": "tax_incentives_nds",
    "ipn": "tax_incentives_ipn",
    "sn": "tax_incentives_sn",
    "total_tax_saved": "total_tax_saved",
}
MARTS = (
    "general_indicators", "financing", "tax_benefits", "employees", "exports",
)
# Sums.
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
    "total_government_support": "finance_source_government",
}
REGISTRY_SUMS = (
    "residents_count", "nonresidents_count", "income_total", "income_international",
    "finance_source_increase_authorized_capital", "main_capital_investments", "finance_source_loan",
    "finance_source_loan_foreign", "finance_source_government", "finance_source_investment", "investor_amount",
    "tax_incentives",
)
QUARTER_SUMS = (
    "residents_count", "nonresidents_count", "income_total", "income_international",
    "finance_source_increase_authorized_capital", "main_capital_investments", "finance_source_loan",
    "finance_source_loan_foreign", "finance_source_government", "government_support_measures",
    "finance_source_investment", "tax_incentives", "total_tax_saved",
)
ANNUAL_SUMS = (
    "residents_count", "nonresidents_count", "income_total", "income_international",
    "finance_source_increase_authorized_capital", "main_capital_investments", "finance_source_loan",
    "finance_source_loan_foreign", "finance_source_government", "finance_source_investment", "investor_amount",
)
ANNUAL_TAX_SUMS = (
    "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn", "tax_incentives_sn",
)
RESIDENT_FIELDS = (
    "oked", "activity_fields", "residents_count", "nonresidents_count", "gph_count",
    "investments_total_current_quarter", "finance_source_increase_authorized_capital", "finance_source_loan",
    "finance_source_loan_foreign", "main_capital_investments", "main_tangible_capital_investments",
    "main_intangible_capital_investments", "income_total", "income_total_previous_quarter",
    "income_total_current_quarter", "income_international", "income_international_previous_quarter",
    "income_international_current_quarter", "income_to_collect", "collection_amount", "tax_incentives",
    "tax_incentives_kpn", "tax_incentives_nds", "tax_incentives_ipn", "tax_incentives_sn", "executor_fullname",
    "executor_phone",
)
# Registry -> (array, text column -> item key, amount column -> item keys in turn).
REGISTRIES = {
    "nonresidents": (
        "nonresidents",
        {"fullname": "fullname", "birth_date": "birth_date", "citizenship": "citizenship", "passport": "passport", "has_visa": "has_visa", "stay_period": "stay_period", "qualification": "qualification", "visa_info": "visa_info", "visit_goal": "visit_goal", "address": "address"},
        {},
    ),
    "nonresidents_family": (
        "nonresidents_family",
        {"fullname": "fullname", "birth_date": "birth_date", "citizenship": "citizenship", "fullname_host": "fullname_host", "relation_degree": "relation_degree", "documents": "documents", "passport": "passport", "has_visa": "has_visa", "visa_info": "visa_info", "address": "address"},
        {},
    ),
    "nonresidents_outside": (
        "nonresidents_outside",
        {"fullname": "fullname", "birth_date": "birth_date", "citizenship": "citizenship", "passport": "passport", "stay_period": "stay_period", "qualification": "qualification", "visa_info": "visa_info", "visit_goal": "visit_goal", "address": "address"},
        {},
    ),
    "authorized_capital": (
        "finance_source_increase_authorized_capital_current_founder",
        {"founder": "founder"},
        {"capital_amount": ("capital_amount",)},
    ),
    "raised_investors": (
        "raised_investors_funds",
        {"country": "country", "investor": "investor", "deal_evaluation": "deal_evaluation"},
        {"sum": ("invested_sum", "capital_amount",)},
    ),
    "borrowed_funds": (
        "borrowed_funds",
        {"borrower": "borrower"},
        {"borrow_sum": ("borrow_sum",)},
    ),
    "borrowed_international": (
        "borrowed_funds_international",
        {"country": "country", "borrower": "borrower"},
        {"borrow_sum": ("borrow_sum",)},
    ),
    "another_method": (
        "another_method_investors_funds",
        {"country": "country", "investor": "investor", "cash_deposit_type": "cash_deposit_type"},
        {"sum": ("invested_sum",)},
    ),
    "debt_instruments": (
        "debt_instruments",
        {"country": "country", "investor": "investor"},
        {"sum": ("invested_sum",)},
    ),
    "export_previous": (
        "income_international_previous_quarter",
        {"country_previous": "country"},
        {"sum_previous": ("sum",)},
    ),
    "export_current": (
        "income_international_current_quarter",
        {"country_current": "country"},
        {"sum_current": ("current_sum",)},
    ),
}
