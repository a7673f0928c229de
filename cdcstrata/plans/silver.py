"""Silver tables: typed rows out of the change logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.payload import json_str, parse_nested, parse_payload, xml_tag
from cdcstrata.functions.scalars import blank_to_null, first_non_blank, labelled_digits, nth_token, to_bigint, to_date
from cdcstrata.operators.predicates import FIRST_YEAR, in_years, not_deleted, payload_available, requests_of
from cdcstrata.operators.unnest import explode_items
from cdcstrata.operators.versions import latest, stitch_versions
from cdcstrata.plans import fields as fl

# Fixed values that decide results.
SERVICE_ID = "techpark"
PARTICIPANT_STATUSES = ("deactivated", "registered")
NATURAL_KEY = ("service_request_id", "report_type", "year")
TIN_TOKEN = 4
TIN_LABEL = "БИН"

# Payload of a service request, as far as it is read.
REQUEST_PAYLOAD = (
    "activation_info struct<certificate_number string, issue_date string, end_date string>, "
    "protocol struct<info struct<name string>>, deactivation_info struct<reason string, exit_date string>"
)

IDENTITIES = ("data_first", "signature_fields", "masked_first")


def _signed_tag(signature: Column, tag: str, mode: str) -> Column:
    content = "[0-9]+" if tag == "tin" else "[^<]+"
    return xml_tag(json_str(signature, "signed_xml"), "company", tag, content, mode)


def _identity(identity: str, doc: str, signature: Column, xml_mode: str) -> tuple[Column, Column]:
    """(company_tin, company_name): the payload, then what the signature says."""
    tin, name = F.col(f"{doc}.company_tin"), F.col(f"{doc}.company_name")
    if identity == "data_first":
        return (
            F.coalesce(blank_to_null(tin), _signed_tag(signature, "tin", xml_mode)),
            F.coalesce(blank_to_null(name), _signed_tag(signature, "name", xml_mode)),
        )
    if identity == "signature_fields":
        return (
            first_non_blank(tin, json_str(signature, "tin")),
            first_non_blank(name, json_str(signature, "full_name")),
        )
    raise ValueError(f"identity must be one of {IDENTITIES}, not {identity!r}")


def _columns(doc: str, names: Sequence[str]) -> list[Column]:
    return [fl.typed(doc, f).alias(f) for f in names]


def silver_reports_basic(cdc: DataFrame, start_year: int | None = FIRST_YEAR, tombstones: str = "before") -> DataFrame:
    """Newest version per natural key, core measures; the support measure keeps its older name."""
    newest = latest(in_years(cdc, start_year), NATURAL_KEY, ["updated_at"], tombstones=tombstones)
    names = fl.SILVER_BASIC
    parsed = parse_payload(newest, ("company_tin", "company_name", *names))
    return parsed.select(
        F.col("id").alias("report_id"),
        *fl.ENVELOPE,
        "doc.company_tin",
        "doc.company_name",
        *_columns("doc", names),
    ).withColumnRenamed(fl.SUPPORT_NEW, fl.SUPPORT_OLD)


def silver_reports_natural_key(cdc: DataFrame, start_year: int | None = None, tombstones: str = "after") -> DataFrame:
    """Newest version per natural key with the raw export arrays; deleted keys are gone."""
    newest = latest(in_years(cdc, start_year), NATURAL_KEY, ["updated_at"], tombstones=tombstones)
    names = fl.SILVER_NATURAL_KEY
    parsed = parse_payload(newest, ("company_tin", "company_name", *names))
    return parsed.select(
        F.col("id").alias("report_id"),
        *fl.ENVELOPE,
        "doc.company_tin",
        "doc.company_name",
        *_columns("doc", names),
    )


def silver_reports(
    cdc: DataFrame,
    identity: str = "masked_first",
    *,
    start_year: int | None = FIRST_YEAR,
    columns: Sequence[str] = fl.SILVER_REPORT,
    with_identity: bool = True,
    xml_mode: str = "first",
    tombstones: str = "before",
    require_payload: bool = False,
    attributes: str = "update_first",
    snapshot_ops: Sequence[str] = ("r",),
) -> DataFrame:
    """The report table, by where the company's identity comes from.

    ``masked_first`` (canonical): payload of the newest snapshot, identity from the signature of the
    newest update, then payload, then the snapshot's signature. Envelope columns come from the update
    where there is one; ``attributes="snapshot"`` takes them from the snapshot. Snapshots without payload
    are always passed over, so ``require_payload`` has nothing to add here and is refused.

    ``data_first``: newest version per natural key, identity from payload, then signed XML.
    ``signature_fields``: the same, with the signature's own ``tin`` and ``full_name`` as fallback.
    For these two, updates that carry no payload win as the newest version and blank the measures;
    ``require_payload=True`` passes over them.

    Fields are cut from payload and signature before versions are ranked, and only those in ``columns``; without
    ``with_identity`` company number and name are left out as well. So name what is needed: neither text is shuffled.
    """
    log = in_years(cdc, start_year)
    if identity == "masked_first":
        if require_payload:
            raise ValueError("masked_first takes snapshots with a payload in any case; require_payload does not apply")
        return _stitched(log, columns, with_identity, xml_mode, attributes, snapshot_ops, tombstones)
    fields = ("company_tin", "company_name", *columns) if with_identity else tuple(columns)
    newest = latest(
        log, NATURAL_KEY, ["updated_at"], tombstones=tombstones, require_payload=require_payload
    )
    parsed = parse_payload(newest, fields)
    named = []
    if with_identity:
        tin, name = _identity(identity, "doc", F.col("signature"), xml_mode)
        named = [tin.alias("company_tin"), name.alias("company_name")]
    return parsed.select(F.col("id").alias("report_id"), *fl.ENVELOPE, *named, *_columns("doc", columns))


def _stitched(
    log: DataFrame,
    columns: Sequence[str],
    with_identity: bool,
    xml_mode: str,
    attributes: str,
    snapshot_ops: Sequence[str],
    tombstones: str,
) -> DataFrame:
    needed = ["id", *fl.ENVELOPE, "updated_ts", "data", "signature"]
    fields = ("company_tin", "company_name", *columns) if with_identity else tuple(columns)
    cut = {f"f_{c}": fl.typed("doc", c) for c in columns}
    if with_identity:
        cut |= {"doc_tin": F.col("doc.company_tin"), "doc_name": F.col("doc.company_name")}
        cut |= {f"signed_{tag}": _signed_tag(F.col("signature"), tag, xml_mode) for tag in ("tin", "name")}
    parsed = parse_payload(log.select(*needed), fields) if fields else log.select(*needed)
    rows = parsed.select(*needed, *[c.alias(name) for name, c in cut.items()])
    # What is resolved from the row alone never depends on it: the hash that settles ties covers the row as it came.
    from_update = [c for c in cut if c.startswith("signed_")]
    stitched = stitch_versions(
        rows,
        snapshot_ops=snapshot_ops,
        snapshot_columns=[*fl.ENVELOPE, *cut],
        update_columns=list(dict.fromkeys([*(() if attributes == "snapshot" else fl.ENVELOPE), *from_update, "op"])),
        tombstones=tombstones,
    )

    def envelope(name: str) -> Column:
        old = F.col(f"snapshot.{name}")
        return (old if attributes == "snapshot" else F.coalesce(F.col(f"update.{name}"), old)).alias(name)

    def resolved(tag: str) -> Column:
        return F.coalesce(
            F.col(f"update.signed_{tag}"), blank_to_null(f"snapshot.doc_{tag}"), F.col(f"snapshot.signed_{tag}")
        ).alias(f"company_{tag}")

    return stitched.select(
        F.col("id").alias("report_id"),
        *[envelope(c) for c in fl.ENVELOPE],
        *([resolved("tin"), resolved("name")] if with_identity else []),
        *[F.col(f"snapshot.f_{c}").alias(c) for c in columns],
    )


def silver_reports_by_id(cdc: DataFrame, year: int | None = None, xml_mode: str = "first") -> DataFrame:
    """Newest version per report id that has a payload; identity from payload, then signed XML."""
    log = payload_available(not_deleted(cdc))
    newest = latest(log, ["id"], ["updated_ts"], tombstones="before")
    parsed = parse_payload(newest, ("company_tin", "company_name", *fl.SILVER_BY_ID))
    tin, name = _identity("data_first", "doc", F.col("signature"), xml_mode)
    rows = parsed.select(
        F.col("id").alias("report_id"),
        "service_request_id",
        "year",
        "report_type",
        "status",
        tin.alias("company_tin"),
        name.alias("company_name"),
        *_columns("doc", fl.SILVER_BY_ID),
    )
    return in_years(rows, None, year)


def silver_preview(cdc: DataFrame) -> DataFrame:
    """Every version that is not a delete, typed but not ranked; the operation stays for audits."""
    parsed = parse_payload(not_deleted(cdc), ("company_tin", "company_name", *fl.SILVER_PREVIEW))
    return parsed.select(
        F.col("id").alias("report_id"),
        *[F.col(c).alias("cdc_operation" if c == "op" else c) for c in fl.ENVELOPE],
        "doc.company_tin",
        "doc.company_name",
        *_columns("doc", fl.SILVER_PREVIEW),
    )


def silver_participants(
    requests: DataFrame,
    service_id: str = SERVICE_ID,
    statuses: Sequence[str] = PARTICIPANT_STATUSES,
    tin_from: str = "token",
) -> DataFrame:
    """Registered and deactivated participants, newest version per request.

    The company number is the 4th token of the search text, or with ``tin_from="label"`` the digits
    after its label.
    """
    rows = requests_of(not_deleted(requests), service_id, statuses)
    newest = latest(rows, ["id"], ["updated_at"], tombstones="before")
    tin = nth_token("search_field", TIN_TOKEN) if tin_from == "token" else labelled_digits("search_field", TIN_LABEL)
    return parse_nested(newest, REQUEST_PAYLOAD).select(
        F.col("id").alias("service_request_id"),
        "company_id",
        "bp_status",
        F.col("doc.activation_info.certificate_number").alias("certificate_number"),
        to_date("doc.activation_info.issue_date").alias("certificate_issue_date"),
        to_date("doc.activation_info.end_date").alias("certificate_end_date"),
        F.col("doc.protocol.info.name").alias("company_name"),
        tin.alias("company_tin"),
        F.col("doc.deactivation_info.reason").alias("deactivation_reason"),
        to_date("doc.deactivation_info.exit_date").alias("deactivation_date"),
        "search_field",
    )


def silver_companies(companies: DataFrame) -> DataFrame:
    """Company directory: newest version per id."""
    newest = latest(companies, ["id"], ["updated_at"], tombstones="before")
    return newest.select(F.col("id").alias("company_id"), "name", "short_name", "tin")


def export_details(cdc: DataFrame, start_year: int | None = FIRST_YEAR) -> DataFrame:
    """One row per report version, export country and period (current or previous quarter).

    Both arrays are unnested in one pass over the log: a row becomes two tagged arrays, each array its
    items. Scanning the log once per period would parse every payload twice.
    """
    names = ("company_tin", "company_name", "certificate_number", fl.EXPORT_CURRENT, fl.EXPORT_PREVIOUS)
    parsed = parse_payload(in_years(not_deleted(cdc), start_year), names)
    current, previous = F.col(f"doc.{fl.EXPORT_CURRENT}"), F.col(f"doc.{fl.EXPORT_PREVIOUS}")
    periods = parsed.select(
        F.col("id").alias("report_id"),
        "service_request_id",
        "year",
        "report_type",
        F.col("doc.company_tin").alias("company_tin"),
        F.col("doc.company_name").alias("company_name"),
        F.col("doc.certificate_number").alias("certificate_number"),
        F.explode(
            F.array(
                F.struct(F.lit("current").alias("quarter_type"), current.alias("items")),
                F.struct(F.lit("previous").alias("quarter_type"), previous.alias("items")),
            )
        ).alias("period"),
    )
    items = explode_items(periods, F.col("period.items"), ["country", "current_sum", "sum"])
    amount = F.when(F.col("period.quarter_type") == "current", F.col("item.current_sum")).otherwise(F.col("item.sum"))
    return items.filter(F.col("item.country").isNotNull()).select(
        "report_id",
        "service_request_id",
        "year",
        "report_type",
        "company_tin",
        "company_name",
        "certificate_number",
        F.col("item.country").alias("country"),
        to_bigint(amount).alias("export_amount"),
        F.col("period.quarter_type").alias("quarter_type"),
    )
