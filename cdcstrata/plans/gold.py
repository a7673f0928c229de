"""Marts. One certificate-resolved report row feeds all of them, each mart is a projection of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.payload import has_item_country, is_json_array, json_str, parse_nested, parse_payload, xml_tag
from cdcstrata.functions.scalars import (
    HOME_COUNTRY,
    NO_CERTIFICATE,
    blank_to_null,
    certificate_source,
    first_non_blank,
    is_resident,
    null_safe_sum,
    to_bigint,
    to_date,
    to_int,
)
from cdcstrata.operators.predicates import (
    FIRST_YEAR,
    in_years,
    not_deleted,
    payload_available,
    report_filter,
    requests_of,
    signed,
    with_op,
)
from cdcstrata.operators.quality import assert_unique
from cdcstrata.operators.unnest import explode_items
from cdcstrata.operators.versions import latest
from cdcstrata.plans import fields as fl
from cdcstrata.plans.silver import NATURAL_KEY, REQUEST_PAYLOAD, SERVICE_ID

# Mart column -> column of the report table.
FINANCING = {
    "government_support": fl.SUPPORT_NEW,
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
INDICATORS = {
    "activity_fields": "activity_fields",
    "government_support": fl.SUPPORT_NEW,
    "tax_saved": "total_tax_saved",
    "export_income": "income_international",
    "total_funding": "investments_total_current_quarter",
    "income_total": "income_total",
    "income_total_current_quarter": "income_total_current_quarter",
}
# Columns of the report table that a mart reads, beside envelope and identity.
NEEDED = {
    "general_indicators": ("certificate_number", *INDICATORS.values(), "investor_country_company"),
    "financing": (
        "certificate_number",
        *FINANCING.values(),
        "finance_source_investment",
    ),
    "tax_benefits": ("certificate_number", *TAX_BENEFITS.values()),
    "employees": ("certificate_number", *fl.STAFF),
    "exports": ("certificate_number", "income_international"),
}


def needed_by(*marts: str) -> tuple[str, ...]:
    """What the named marts read together; pass it as ``columns`` to the report table."""
    return tuple(dict.fromkeys(c for m in marts for c in NEEDED[m]))


# What the certificate resolution adds to a report row.
RESOLVED = ("resolved_certificate", "resolved_issue_date", "resolved_end_date", "fallback_tin", "fallback_name")


# --- certificates -----------------------------------------------------------------------------


def latest_certificates(requests: DataFrame, service_id: str = SERVICE_ID) -> DataFrame:
    """Certificate facts of the newest version of every request: id, cert_number, dates."""
    newest = latest(requests_of(requests, service_id), ["id"], ["updated_at"], tombstones="before")
    return parse_nested(newest, REQUEST_PAYLOAD).select(
        "id",
        F.col("doc.activation_info.certificate_number").alias("cert_number"),
        to_date("doc.activation_info.issue_date").alias("cert_issue_date"),
        to_date("doc.activation_info.end_date").alias("cert_end_date"),
    )


KEY = "service_request_id"


def certificate_lookup(
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    service_id: str = SERVICE_ID,
    *,
    check_unique: bool = False,
) -> DataFrame | None:
    """What participants and requests say about a request's certificate: one row a request, None without either.

    ``check_unique`` guards that: the lookup fails to evaluate if either side has a request twice, which would multiply
    reports. It costs an aggregate over each side.
    """
    sides = []
    if participants is not None:
        side = participants.select(
            KEY,
            F.col("certificate_number").alias("p_number"),
            F.col("certificate_issue_date").alias("p_issue"),
            F.col("certificate_end_date").alias("p_end"),
            F.col("company_tin").alias("p_tin"),
            F.col("company_name").alias("p_name"),
        )
        sides.append(side)
    if requests is not None:
        sides.append(latest_certificates(requests, service_id).withColumnRenamed("id", KEY))
    if check_unique:
        sides = [assert_unique(side, [KEY]) for side in sides]
    return reduce(lambda left, right: left.join(right, KEY, "full"), sides) if sides else None


def with_certificates(silver: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Report rows joined with a lookup of :func:`certificate_lookup`, as it is or as it was stored."""
    columns = lookup.columns if lookup is not None else ()
    number, issue, end = [blank_to_null("certificate_number")], [], []
    tin = name = F.lit(None).cast("string")
    if "p_number" in columns:
        number.append(F.col("p_number"))
        issue.append(F.col("p_issue"))
        end.append(F.col("p_end"))
        tin, name = F.col("p_tin"), F.col("p_name")
    if "cert_number" in columns:
        number.append(F.nullif(F.col("cert_number"), F.lit(NO_CERTIFICATE)))
        issue.append(F.col("cert_issue_date"))
        end.append(F.col("cert_end_date"))
    out = silver if lookup is None else silver.join(lookup, KEY, "left")
    none = F.lit(None).cast("date")
    return out.select(
        *silver.columns,
        F.coalesce(*number).alias("resolved_certificate"),
        F.coalesce(*issue, none).alias("resolved_issue_date"),
        F.coalesce(*end, none).alias("resolved_end_date"),
        tin.alias("fallback_tin"),
        name.alias("fallback_name"),
    )


def certificate_for(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    service_id: str = SERVICE_ID,
    *,
    check_unique: bool = False,
) -> DataFrame:
    """Report rows with the certificate resolved over up to three levels.

    Level 1 is the report's own number, level 2 the participants table, level 3 the newest request
    version (whose '-1' means none). Pass what there is: nothing, ``participants``, or both. The join is a
    left join on a unique key, so rows neither vanish nor multiply; ``check_unique`` makes sure of it. Spark
    broadcasts the lookup only when its measured size allows; else a sort-merge join runs, whose hot keys are split
    at run time. That is why it is a single join: two in a row on one key would rule the splitting out.
    """
    return with_certificates(silver, certificate_lookup(participants, requests, service_id, check_unique=check_unique))


def _resolved(silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id) -> DataFrame:
    if cert_fallback not in (0, 2, 3):
        raise ValueError("cert_fallback must be 0, 2 or 3")
    out = signed(silver) if signed_only else silver
    if set(RESOLVED) <= set(silver.columns):
        if cert_fallback != 3:
            raise ValueError("the rows come with their certificate; resolve them at the level that is wanted")
    else:
        out = certificate_for(
            out,
            participants if cert_fallback >= 2 else None,
            requests if cert_fallback == 3 else None,
            service_id,
        )
    if identity_fallback:
        out = out.withColumns(
            {
                "company_tin": first_non_blank("company_tin", "fallback_tin"),
                "company_name": first_non_blank("company_name", "fallback_name"),
            }
        )
    return out


def _mart(columns, silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id):
    rows = _resolved(silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id)
    if cert_fallback == 0 and not set(RESOLVED) <= set(silver.columns):
        rows = not_deleted(rows)
    return rows.select(
        "year",
        "report_type",
        F.col("resolved_certificate").alias("certificate_number"),
        F.col("company_tin").alias("bin"),
        *columns,
    )


def _renamed(columns: dict[str, str]) -> list[Column]:
    return [F.col(src).alias(out) for out, src in columns.items()]


# --- marts ------------------------------------------------------------------------------------
# Common parameters: ``silver`` is the report table, or the output of certificate_for so that several
# marts share one join. ``cert_fallback`` picks the number of certificate sources: 0 (report only),
# 2 (+ participants) or 3 (+ requests). ``signed_only=False`` keeps unsigned rows.
# ``identity_fallback`` lets the participants table fill a missing company number or name.


def general_indicators(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    signed_only: bool = True,
    identity_fallback: bool = False,
    residency: str = "investor_country_company",
    home: str = HOME_COUNTRY,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Headline figures per report, with certificate dates and residency (from column ``residency``)."""
    columns = [
        "company_name",
        F.col("resolved_issue_date").alias("certificate_issue_date"),
        F.col("resolved_end_date").alias("certificate_end_date"),
        *_renamed(INDICATORS),
        is_resident(residency, home).alias("is_resident"),
        blank_to_null(residency).alias("country"),
    ]
    return _mart(
        columns, silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id
    )


def financing(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    signed_only: bool = True,
    identity_fallback: bool = False,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Funding per report; attracted investments are capital increase plus investment."""
    attracted = null_safe_sum("finance_source_increase_authorized_capital", "finance_source_investment")
    columns = [*_renamed(FINANCING), attracted.alias("attracted_investments")]
    return _mart(
        columns, silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id
    )


def tax_benefits(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    signed_only: bool = True,
    identity_fallback: bool = False,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Tax relief per report and kind of tax."""
    return _mart(
        _renamed(TAX_BENEFITS),
        silver,
        participants,
        requests,
        cert_fallback,
        signed_only,
        identity_fallback,
        service_id,
    )


def employees(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    signed_only: bool = True,
    identity_fallback: bool = False,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Staff counts per report."""
    return _mart(
        list(fl.STAFF), silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id
    )


def exports(
    silver: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    signed_only: bool = True,
    identity_fallback: bool = False,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Export income per report."""
    columns = ["company_name", F.col("income_international").alias("export_income")]
    return _mart(
        columns, silver, participants, requests, cert_fallback, signed_only, identity_fallback, service_id
    )


MARTS = {
    "general_indicators": general_indicators,
    "financing": financing,
    "tax_benefits": tax_benefits,
    "employees": employees,
    "exports": exports,
}


# --- exports by country -----------------------------------------------------------------------


def _by_country(rows: DataFrame, json_array: str, keep: Sequence[Column | str], amount: str = "export_income") -> DataFrame:
    items = explode_items(rows, F.col(json_array), ["country", "current_sum"])
    return items.filter(has_item_country("item.country")).select(
        *keep,
        F.col("item.country").alias("country"),
        to_bigint("item.current_sum").alias(amount),
    )


def _keep_resolved() -> list[Column | str]:
    return [
        "year",
        "report_type",
        F.col("resolved_certificate").alias("certificate_number"),
        F.col("company_tin").alias("bin"),
        "company_name",
    ]


def export_by_country(
    silver: DataFrame,
    cdc: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    start_year: int | None = FIRST_YEAR,
    identity_fallback: bool = False,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """Canonical: signed reports of the report table, countries from the newest snapshot with an array.

    The ranking moves the arrays and not the payloads they are cut from. Arrays stay packed until both joins
    are done, so the joins move one row per report. What is no array goes where the text is cut out: a filter on the column
    would move below that and cut it out once more.
    """
    snapshots = payload_available(with_op(in_years(cdc, start_year), "r"))
    found = F.filter(F.array(json_str("data", fl.EXPORT_CURRENT)), is_json_array)
    with_array = snapshots.select("id", "updated_ts", "updated_at", "op", F.explode(found).alias("export_json"))
    arrays = latest(with_array, ["id"], ["updated_ts"], tombstones="keep").select(
        F.col("id").alias("report_id"), "export_json"
    )
    rows = signed(silver).join(arrays, "report_id")
    resolved = _resolved(rows, participants, requests, cert_fallback, False, identity_fallback, service_id)
    return _by_country(resolved, "export_json", _keep_resolved())


def export_by_country_natural_key(
    cdc: DataFrame, participants: DataFrame | None = None, *, start_year: int | None = FIRST_YEAR
) -> DataFrame:
    """Straight from the log: newest signed version with an array per natural key.

    Identity is payload, signed XML, participants, in this order; the certificate likewise without XML.
    """
    log = signed(not_deleted(in_years(cdc, start_year)))
    parsed = parse_payload(log, ("company_tin", "company_name", "certificate_number", fl.EXPORT_CURRENT))
    with_array = parsed.select(
        *NATURAL_KEY,
        "updated_at",
        "updated_ts",
        "id",
        "op",
        "signature",
        "doc.company_tin",
        "doc.company_name",
        "doc.certificate_number",
        F.col(f"doc.{fl.EXPORT_CURRENT}").alias("export_json"),
    ).filter(is_json_array("export_json"))
    newest = latest(with_array, NATURAL_KEY, ["updated_at"], tombstones="before")
    xml = json_str("signature", "signed_xml")
    rows = newest.select(
        *NATURAL_KEY,
        "certificate_number",
        F.coalesce(blank_to_null("company_tin"), xml_tag(xml, "company", "tin", "[0-9]+")).alias("company_tin"),
        F.coalesce(blank_to_null("company_name"), xml_tag(xml, "company", "name")).alias("company_name"),
        "export_json",
    )
    resolved = _resolved(rows, participants, None, 0 if participants is None else 2, False, participants is not None, "")
    return _by_country(resolved, "export_json", _keep_resolved(), "export_amount")


def export_by_country_stitched(
    silver_with_arrays: DataFrame,
    participants: DataFrame | None = None,
    requests: DataFrame | None = None,
    cert_fallback: int = 3,
    *,
    service_id: str = SERVICE_ID,
) -> DataFrame:
    """From report rows that carry the raw array themselves: no second pass over the log."""
    rows = signed(silver_with_arrays)
    resolved = _resolved(rows, participants, requests, cert_fallback, False, cert_fallback >= 2, service_id)
    return _by_country(resolved, fl.EXPORT_CURRENT, _keep_resolved())


def gold_export_details(silver_with_arrays: DataFrame) -> DataFrame:
    """Countries out of the array column of the natural-key report table, without any fallback."""
    items = explode_items(not_deleted(silver_with_arrays), F.col(fl.EXPORT_CURRENT), ["country", "current_sum"])
    return items.filter(F.col("item.country").isNotNull()).select(
        "year",
        "report_type",
        "certificate_number",
        F.col("company_tin").alias("bin"),
        "company_name",
        F.col("item.country").alias("country"),
        to_bigint("item.current_sum").alias("export_amount"),
    )


# --- report marts -----------------------------------------------------------------------------


def report_mart(
    cdc: DataFrame,
    year: int | None = None,
    report_type: str | None = None,
    columns: Sequence[str] | None = None,
    *,
    start_year: int | None = FIRST_YEAR,
) -> DataFrame:
    """Flat mart of all signed versions, 43 columns plus load time; ``columns`` cuts it down.

    ``cdc_operation`` may be asked for on top. Staff counts and the certificate number are INT here.
    """
    rows = parse_payload(cdc.filter(report_filter(year, report_type, start_year)), fl.REPORT_MART)
    ints = (*fl.STAFF,)
    out = rows.select(
        F.col("id").alias("report_id"),
        "year",
        "report_type",
        "status",
        "signed_at",
        "version",
        "created_at",
        "updated_at",
        "service_request_id",
        "author_id",
        *[
            (to_int(f"doc.{f}") if f == "certificate_number" else fl.typed("doc", f, ints)).alias(f)
            for f in fl.REPORT_MART
        ],
        F.col("op").alias("cdc_operation"),
    )
    return out.drop("cdc_operation") if columns is None else out.select(*columns)


def deduped_report_mart(
    cdc: DataFrame,
    year: int | None = None,
    report_type: str | None = None,
    *,
    start_year: int | None = FIRST_YEAR,
    tombstones: str = "before",
) -> DataFrame:
    """Newest signed version per natural key; BIGINT staff counts, textual certificate number."""
    if tombstones == "before":
        log = cdc.filter(report_filter(year, report_type, start_year))
        newest = latest(log, NATURAL_KEY, ["updated_at"], tombstones="before")
    else:
        newest = latest(in_years(cdc, start_year, year), NATURAL_KEY, ["updated_at"], tombstones="after")
        newest = newest.filter(report_filter(year, report_type, start_year))
    parsed = parse_payload(newest, fl.DEDUPED_MART)
    return parsed.select(
        F.col("id").alias("report_id"),
        *fl.ENVELOPE,
        *[fl.typed("doc", f).alias(f) for f in fl.DEDUPED_MART],
    )


def certificate_sources(silver: DataFrame, participants: DataFrame, requests: DataFrame, service_id: str = SERVICE_ID) -> DataFrame:
    """How many signed reports take their certificate from which level."""
    p = participants.select("service_request_id", F.col("certificate_number").alias("p_number"))
    c = latest_certificates(requests, service_id).select(F.col("id").alias("service_request_id"), "cert_number")
    lookup = p.join(c, "service_request_id", "full")
    rows = signed(silver).join(lookup, "service_request_id", "left")
    source = certificate_source("certificate_number", "p_number", "cert_number")
    return rows.groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("cnt"))

