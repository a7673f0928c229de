"""Schemas of the stored tables. Nothing is inferred from data.

Identifiers are BIGINT, not INT, so that a large key neither overflows nor turns NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

from cdcstrata.plans import fields as fl
from cdcstrata.sources.tables import TableSpec, spec_of

# Bronze, as DDL text.
REPORT_CDC = (
    "op string, updated_ts timestamp, id bigint, created_at timestamp, updated_at timestamp, year int, report_type string, "
    "data string, signature string, status string, author_id bigint, service_request_id bigint, viewed array<int>, "
    "signed_at timestamp, version string"
)
REQUEST_CDC = (
    "id bigint, service_id string, company_id bigint, bp_status string, data string, search_field string, "
    "updated_at timestamp, op string"
)
COMPANY_CDC = "id bigint, name string, short_name string, tin string, updated_at timestamp, op string"
SERVICE_REPORT = (
    "id bigint, year int, status string, report_type string, data string, version string, signed_at timestamp, "
    "service_request_id bigint"
)
SERVICE_REQUEST = "id bigint, number string, data string, company_id bigint, hub_form_id bigint"
COMPANY = "id bigint, name string, tin string"
HUB_FORM = "id bigint, data string"
VISIT_RESPONSES = "visit_date date, raw_json string"
_CRM_PARTY = (
    "id bigint, name string, responsible_user_id int, created_at bigint, updated_at bigint, is_deleted boolean, "
    "custom_fields_values string"
)
CRM_LEADS = (
    f"{_CRM_PARTY}, price bigint, status_id int, pipeline_id int, loss_reason_id int, closed_at bigint, tags_json string, "
    "contacts_json string, companies_json string"
)
CRM_CONTACTS = f"{_CRM_PARTY}, first_name string, last_name string, companies_json string, leads_json string"
CRM_COMPANIES = _CRM_PARTY
CRM_TASKS = (
    "id bigint, responsible_user_id int, entity_id bigint, entity_type string, is_completed boolean, created_at bigint, "
    "updated_at bigint"
)
CRM_PIPELINES = "id int, name string, is_main boolean, statuses_json string"
CRM_USERS = "id int, name string"

_ENVELOPE_TYPES = {
    "service_request_id": "bigint",
    "year": "int",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "signed_at": "timestamp",
    "author_id": "bigint",
}


def _typed(names, ints=(), text=()) -> str:
    def kind(name: str) -> str:
        if name in ints:
            return "int"
        if name in text:
            return "string"
        return _ENVELOPE_TYPES.get(name) or ("bigint" if name in fl.NUMERIC else "string")

    return ", ".join(f"{name} {kind(name)}" for name in names)


_IDENTITY = ("company_tin", "company_name")
_MART_HEAD = "year int, report_type string, certificate_number string, bin string"
_REPORT_HEAD = ("year", "report_type", "status", "signed_at", "version", "created_at", "updated_at", "service_request_id", "author_id")

# Silver and gold, as DDL text by table name.
TABLES = {
    "silver_reports_basic": "report_id bigint, "
    + _typed((*fl.ENVELOPE, *_IDENTITY, *[fl.SUPPORT_OLD if c == fl.SUPPORT_NEW else c for c in fl.SILVER_BASIC])),
    "silver_reports": "report_id bigint, " + _typed((*fl.ENVELOPE, *_IDENTITY, *fl.SILVER_REPORT)),
    "silver_reports_natural_key": "report_id bigint, " + _typed((*fl.ENVELOPE, *_IDENTITY, *fl.SILVER_NATURAL_KEY)),
    "silver_participants": (
        "service_request_id bigint, company_id bigint, bp_status string, certificate_number string, certificate_issue_date date, "
        "certificate_end_date date, company_name string, company_tin string, deactivation_reason string, deactivation_date date, "
        "search_field string"
    ),
    "silver_companies": "company_id bigint, name string, short_name string, tin string",
    "silver_export_details": (
        "report_id bigint, service_request_id bigint, year int, report_type string, company_tin string, company_name string, "
        "certificate_number string, country string, export_amount bigint, quarter_type string"
    ),
    "general_indicators": (
        f"{_MART_HEAD}, company_name string, certificate_issue_date date, certificate_end_date date, activity_fields string, "
        "government_support bigint, tax_saved bigint, export_income bigint, total_funding bigint, income_total bigint, "
        "income_total_current_quarter bigint, is_resident boolean, country string"
    ),
    "financing": (
        f"{_MART_HEAD}, government_support bigint, loan_funds bigint, authorized_capital_increase bigint, total_funding bigint, "
        "attracted_investments bigint"
    ),
    "tax_benefits": f"{_MART_HEAD}, kpn bigint, nds bigint, ipn bigint, sn bigint, total_tax_saved bigint",
    "employees": f"{_MART_HEAD}, residents_count bigint, nonresidents_count bigint, gph_count bigint",
    "exports": f"{_MART_HEAD}, company_name string, export_income bigint",
    "export_by_country": f"{_MART_HEAD}, company_name string, country string, export_income bigint",
    "report_mart": "report_id bigint, "
    + _typed((*_REPORT_HEAD, *fl.REPORT_MART), ints=("certificate_number", *fl.STAFF)),
}
PARTITIONS = {"silver_export_details": ("year", "quarter_type"), "silver_participants": (), "silver_companies": ()}
COMMENTS = {
    "silver_reports": "Reports, newest version, one row per report",
    "silver_participants": "Participants, registered and deactivated",
    "general_indicators": "Headline figures per report",
    "financing": "Funding per report",
    "tax_benefits": "Tax relief per report",
    "employees": "Staff per report",
    "exports": "Export income per report",
    "export_by_country": "Export income per report and country",
    "report_mart": "All signed report versions, flat",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def table_spec(name: str, database: str | None = None, fmt: str = "parquet", **props: str) -> TableSpec:
    """Definition of a silver or gold table, with the load-time column."""
    return spec_of(
        f"{database}.{name}" if database else name,
        struct(TABLES[name]),
        partition_by=PARTITIONS.get(name, ("year",)),
        comment=COMMENTS.get(name, ""),
        fmt=fmt,
        props=props,
    )
