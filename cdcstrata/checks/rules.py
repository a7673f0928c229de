"""Modulo rules that turn the typed test tables into change logs.

Each rule is SQL that Spark and DuckDB read alike, over the columns of the order base:
``k`` order key, ``c`` customer key, ``p`` whole price, ``d`` order date, ``s`` status, ``y`` year, ``q`` quarter.
The Spark side packs the values into JSON and XML and hides them behind versions and dirty spellings; the
SQL side takes them as they are. So the checks compare what the library digs out with what went in.
"""

from __future__ import annotations

import re

START_YEAR = 1996
HOME = "Казахстан"

ORDER_COLUMNS = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "p": "CAST(floor(o_totalprice) AS BIGINT)",
    "d": "o_orderdate",
    "s": "o_orderstatus",
    "y": "CAST(year(o_orderdate) AS INT)",
    "q": "CAST(quarter(o_orderdate) AS INT)",
}

# What a JSON string field holds; NULL leaves the key out.
TEXT_RULES = {
    "company_tin": "CASE WHEN k % 8 = 1 THEN NULL WHEN k % 8 = 5 THEN '' ELSE lpad(CAST(c AS STRING), 12, '0') END",
    "company_name": "CASE WHEN k % 8 = 1 THEN NULL WHEN k % 8 = 5 THEN '' ELSE 'Company ' || CAST(c AS STRING) END",
    "certificate_number": "CASE WHEN k % 3 = 0 THEN CAST(k % 5000 AS STRING) WHEN k % 3 = 1 THEN '' END",
    "oked": "'62' || lpad(CAST(k % 1000 AS STRING), 3, '0')",
    "investor_country_company": "CASE WHEN k % 4 = 0 THEN 'Казахстан' WHEN k % 4 = 1 THEN '' WHEN k % 4 = 2 THEN 'Germany' END",
    "country": "CASE WHEN k % 5 = 0 THEN 'Казахстан' WHEN k % 5 = 1 THEN '' WHEN k % 5 = 2 THEN 'Germany' WHEN k % 5 = 4 THEN 'Italy' END",
    "executor_fullname": "'Executor ' || CAST(k % 1000 AS STRING)",
    "executor_phone": "'+7' || lpad(CAST(k % 1000000 AS STRING), 10, '0')",
}
# What a JSON number field holds.
NUMBER_RULES = {
    "residents_count": "k % 50",
    "nonresidents_count": "k % 7",
    "gph_count": "CASE WHEN k % 10 <> 0 THEN k % 5 END",
    "income_international": "p % 1000",
    "income_total_current_quarter": "p % 90001",
    "income_total_previous_quarter": "CASE WHEN k % 4 <> 0 THEN p % 70001 END",
    "income_local": "p % 50021",
    "income_to_collect": "k % 70",
    "investments_total_current_quarter": "CASE WHEN k % 6 = 0 THEN 0 ELSE (k * 13) % 100003 END",
    "finance_source_increase_authorized_capital": "CASE WHEN k % 12 <> 0 THEN (k % 1000) * 10 END",
    "main_capital_investments": "k % 2000",
    "main_tangible_capital_investments": "k % 1500",
    "main_intangible_capital_investments": "k % 500",
    "finance_source_loan": "k % 3000",
    "finance_source_loan_foreign": "k % 300",
    "finance_source_government": "CASE WHEN y < 1999 THEN k % 400 END",
    "government_support_measures": "CASE WHEN y >= 1998 THEN k % 450 END",
    "finance_source_investment": "CASE WHEN k % 14 <> 0 THEN k % 700 END",
    "investor_amount": "k % 800",
    "tax_incentives": "k % 900",
    "tax_incentives_kpn": "k % 100",
    "tax_incentives_nds": "k % 200",
    "tax_incentives_ipn": "k % 50",
    "tax_incentives_sn": "k % 25",
    "total_tax_saved": "CASE WHEN y >= 1998 THEN k % 950 END",
    "collection_amount": "k % 60",
}
# JSON text of a field that is an array of strings.
ACTIVITY = "'[\"f' || CAST(k % 10 AS STRING) || '\"]'"

# income_total is dirty; first matching rule wins. (raw JSON text, value it stands for)
INCOME_RAW = (
    "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN '\"\"' WHEN k % 23 = 0 THEN '\"abc\"' "
    "WHEN k % 29 = 0 THEN CAST(p AS STRING) || '.7' WHEN k % 5 = 0 THEN '\"' || CAST(p AS STRING) || '\"' "
    "ELSE CAST(p AS STRING) END"
)
INCOME_VALUE = "CASE WHEN k % 17 = 0 OR k % 19 = 0 OR k % 23 = 0 THEN NULL ELSE p END"

# Envelope columns of a version.
ENVELOPE = {
    "id": "k",
    "service_request_id": "CASE WHEN k % 97 <> 0 THEN c END",
    "year": "y",
    # The oldest kind of update moves a report to the next quarter, and so to another natural key.
    "report_type": (
        "CASE WHEN k % 11 = 0 THEN 'yearly' WHEN lag = 3 THEN 'quarter' || CAST(q % 4 + 1 AS STRING) "
        "ELSE 'quarter' || CAST(q AS STRING) END"
    ),
    "status": "CASE WHEN s = 'P' THEN 'draft' ELSE 'signed' END",
    "version": "'1.' || CAST(k % 4 AS STRING)",
    "created_at": "d",
    "signed_at": "CASE WHEN s <> 'P' THEN d END",
    "author_id": "k % 100 + 1",
}
# (operation, age in days, which orders have such a version)
VERSIONS = (
    ("r", 0, "k % 7 <> 0"),
    ("c", 0, "k % 7 = 0"),
    ("u", 1, "k % 3 = 0"),
    ("d", 2, "k % 20 = 0"),
    ("u", 3, "k % 9 = 0"),
)

# Identity inside the signature; ``lag`` is the age of the version in days. The update's document has no number at all for some orders.
SIGNED_TIN = "CASE WHEN k % 13 <> 0 THEN lpad(CAST(c AS STRING), 12, '0') END"
SIGNED_NAME = "CASE WHEN k % 13 <> 0 THEN 'Signed ' || CAST(c AS STRING) END"
FULL_NAME = "CASE WHEN k % 13 <> 0 THEN 'Full ' || CAST(c AS STRING) END"
MASKED_TIN = "CASE WHEN k % 15 <> 0 THEN '777777' || lpad(CAST(c % 1000000 AS STRING), 6, '0') END"
MASKED_NAME = "'Masked ' || CAST(c AS STRING) || '.' || CAST(lag AS STRING)"

# Registry arrays: item i (1..3) exists where i <= k % 4; the flag says true for every third order.
ITEMS = 3
MART_FLAGS = ("has_nonresidents", "has_borrowed_funds", "has_raised_investors_funds")
ITEM_COUNT = "k % 4"


def bound(rule: str, name: str, value: int) -> str:
    """The rule with one of its variables replaced by a number."""
    return re.sub(rf"\b{name}\b", str(value), rule)


def flag_rule(position: int) -> str:
    """The n-th registry's flag."""
    return f"CASE WHEN (k + {position}) % 3 = 0 THEN 'true' ELSE 'false' END"


def item_text(key: str) -> str:
    """Text value of an item key."""
    return f"'{key} ' || CAST(i AS STRING) || '-' || CAST(k % 97 AS STRING)"


def item_amount(position: int) -> str:
    return f"(k % 1000) * i + {position}"


# Previous-quarter exports: item 1 is a country, item 2 is noise.
PREVIOUS_COUNTRY = (
    "CASE WHEN i = 1 THEN 'Country ' || CAST(k % 25 AS STRING) WHEN k % 2 = 0 THEN 'None' WHEN k % 5 = 0 THEN '' END"
)
PREVIOUS_SUM = "(k % 1000) * i"
PREVIOUS_COUNT = "k % 3"
# Current-quarter exports: one item per supplier nation of the order, some nations stand for noise.
EXPORT_COUNTRY = "CASE WHEN n_nationkey = 7 THEN 'None' WHEN n_nationkey = 11 THEN '' WHEN n_nationkey <> 13 THEN n_name END"
EXPORT_IS_NUMBER = "k % 9 = 0"
EXPORT_NUMBER = "p % 777"

# Service requests, over customer columns: c key, name, segment.
CUSTOMER_COLUMNS = {"c": "c_custkey", "name": "c_name", "segment": "c_mktsegment"}
REQUEST_SERVICE = "CASE WHEN c % 10 = 0 THEN 'other' ELSE 'techpark' END"
REQUEST_STATUS = "CASE WHEN v = 1 THEN 'registered' WHEN c % 5 = 0 THEN 'deactivated' WHEN c % 5 = 1 THEN 'draft' ELSE 'registered' END"
REQUEST_CERTIFICATE = (
    "CASE WHEN c % 13 = 0 THEN '-1' WHEN c % 17 = 0 THEN NULL WHEN v = 1 THEN 'P' || CAST(c AS STRING) || 'v2' "
    "ELSE 'P' || CAST(c AS STRING) END"
)
# (text in the JSON, what it reads as)
REQUEST_ISSUE = "CASE WHEN c % 19 = 0 THEN '' WHEN c % 23 = 0 THEN '2024-02-31' ELSE '2020-03-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0') END"
REQUEST_ISSUE_VALUE = "CASE WHEN c % 19 = 0 OR c % 23 = 0 THEN NULL ELSE CAST('2020-03-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0') AS DATE) END"
REQUEST_END = "'2030-07-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0')"
REQUEST_SEARCH = (
    "CASE WHEN c % 11 = 0 THEN 'Person***iin' ELSE 'Person***iin***mail***' || lpad(CAST(c AS STRING), 12, '0') || '***' || name END"
)
REQUEST_TIN = "CASE WHEN c % 11 <> 0 THEN lpad(CAST(c AS STRING), 12, '0') END"
REQUEST_NAME = "'Participant ' || CAST(c AS STRING)"
REQUEST_REASON = "CASE WHEN c % 5 = 0 THEN 'reason ' || CAST(c % 3 AS STRING) END"
REQUEST_EXIT = "CASE WHEN c % 5 = 0 THEN '2023-05-' || lpad(CAST(1 + c % 28 AS STRING), 2, '0') END"
# (operation, age in days = v, which customers)
REQUEST_VERSIONS = (("r", 0, "TRUE"), ("u", 1, "c % 4 = 0"), ("d", 2, "c % 21 = 0"))
COMPANY_VERSIONS = (("r", 0, "TRUE"), ("u", 1, "c % 6 = 0"), ("d", 2, "c % 25 = 0"))
COMPANY_NAME = "CASE WHEN v = 1 THEN name || ' v2' ELSE name END"
