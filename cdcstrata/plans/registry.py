"""Registries: the lists behind a report, one row per array item.

Eleven registries are the same operator with different parameters; residents are a flat projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.payload import json_str, parse_payload
from cdcstrata.functions.scalars import to_bigint
from cdcstrata.operators.predicates import flag_true, signed
from cdcstrata.operators.unnest import explode_maps
from cdcstrata.plans import fields as fl
from cdcstrata.plans.summary import registry_summary


def registry_base(
    reports: DataFrame,
    requests: DataFrame,
    companies: DataFrame,
    forms: DataFrame | None = None,
    year: int | None = None,
    report_type: str | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Signed reports of a period with their request, company and (if given) form.

    Period and flag are applied to the reports before any join. Request, company and form meet first, so the
    reports with their payloads are shuffled once and not three times. Leave ``forms`` out where nothing of the
    form is needed: an outer join cannot be dropped by the optimizer once it is in the plan.
    """
    rows = signed(reports)
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    if report_type is not None:
        rows = rows.filter(F.col("report_type") == report_type)
    if flag:
        rows = flag_true(rows, flag)
    lookup = requests.select(
        F.col("id").alias("service_request_id"),
        "number",
        F.col("data").alias("request_data"),
        "company_id",
        "hub_form_id",
    ).join(
        companies.select(
            F.col("id").alias("company_id"),
            F.col("name").alias("company_name"),
            F.col("tin").alias("company_tin"),
        ),
        "company_id",
        "left",
    )
    form_data = F.lit(None).cast("string")
    if forms is not None:
        form = forms.select(F.col("id").alias("hub_form_id"), F.col("data").alias("hub_form_data"))
        lookup = lookup.join(form, "hub_form_id", "left")
        form_data = F.col("hub_form_data")
    out = rows.join(lookup, "service_request_id", "left")
    return out.select(
        "id",
        "year",
        "status",
        "report_type",
        "data",
        "version",
        "signed_at",
        "number",
        "request_data",
        "company_name",
        "company_tin",
        json_str("request_data", "activation_info").alias("activation_info"),
        form_data.alias("hub_form_data"),
    )


@dataclass(frozen=True)
class RegistrySpec:
    """An unnesting registry: the array, its text columns and its amounts.

    An amount lists the item keys to try in turn, since the key changed between report versions.
    """

    array: str
    text: dict[str, str]
    amounts: dict[str, tuple[str, ...]]

    @property
    def flag(self) -> str:
        return f"has_{self.array}"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# Arrays and item keys as they appear in the payload.
HOST_KEY = "fullname_host"
REGISTRIES = {
    "nonresidents": RegistrySpec(
        "nonresidents",
        _same(
            "fullname",
            "birth_date",
            "citizenship",
            "passport",
            "has_visa",
            "stay_period",
            "qualification",
            "visa_info",
            "visit_goal",
            "address",
        ),
        {},
    ),
    "nonresidents_family": RegistrySpec(
        "nonresidents_family",
        _same(
            "fullname",
            "birth_date",
            "citizenship",
            HOST_KEY,
            "relation_degree",
            "documents",
            "passport",
            "has_visa",
            "visa_info",
            "address",
        ),
        {},
    ),
    "nonresidents_outside": RegistrySpec(
        "nonresidents_outside",
        _same(
            "fullname",
            "birth_date",
            "citizenship",
            "passport",
            "stay_period",
            "qualification",
            "visa_info",
            "visit_goal",
            "address",
        ),
        {},
    ),
    "authorized_capital": RegistrySpec(
        "finance_source_increase_authorized_capital_current_founder",
        _same("founder"),
        {"capital_amount": ("capital_amount",)},
    ),
    "raised_investors": RegistrySpec(
        "raised_investors_funds",
        _same("country", "investor", "deal_evaluation"),
        {"sum": ("invested_sum", "capital_amount")},
    ),
    "borrowed_funds": RegistrySpec("borrowed_funds", _same("borrower"), {"borrow_sum": ("borrow_sum",)}),
    "borrowed_international": RegistrySpec(
        "borrowed_funds_international", _same("country", "borrower"), {"borrow_sum": ("borrow_sum",)}
    ),
    "another_method": RegistrySpec(
        "another_method_investors_funds",
        _same("country", "investor", "cash_deposit_type"),
        {"sum": ("invested_sum",)},
    ),
    "debt_instruments": RegistrySpec(
        "debt_instruments", _same("country", "investor"), {"sum": ("invested_sum",)}
    ),
    "export_previous": RegistrySpec(
        fl.EXPORT_PREVIOUS, {"country_previous": "country"}, {"sum_previous": ("sum",)}
    ),
    "export_current": RegistrySpec(
        fl.EXPORT_CURRENT, {"country_current": "country"}, {"sum_current": ("current_sum",)}
    ),
}

RESIDENT_FIELDS = (
    "oked",
    "activity_fields",
    *fl.STAFF,
    "investments_total_current_quarter",
    "finance_source_increase_authorized_capital",
    *fl.LOANS,
    "main_capital_investments",
    "main_tangible_capital_investments",
    "main_intangible_capital_investments",
    "income_total",
    "income_total_previous_quarter",
    "income_total_current_quarter",
    "income_international",
    fl.EXPORT_PREVIOUS,
    fl.EXPORT_CURRENT,
    "income_to_collect",
    "collection_amount",
    *fl.TAXES,
    "executor_fullname",
    "executor_phone",
)


def unnest_registry(
    base: DataFrame, spec: RegistrySpec, flag: str | None = None, rename_keys: dict[str, str] | None = None
) -> DataFrame:
    """id, company and one row per array item.

    ``flag`` restricts to reports that set it. ``rename_keys`` maps an output column to the item key that
    holds it, for payloads that name a key after their own product.
    """
    rows = flag_true(base, flag) if flag else base
    items = explode_maps(rows.select("id", "company_name", "company_tin", "data"), json_str("data", spec.array))
    keys = {**spec.text, **{k: v for k, v in (rename_keys or {}).items() if k in spec.text}}

    def value(key: str) -> Column:
        return F.col("item")[key]

    amounts = [F.coalesce(*[to_bigint(value(k)) for k in ks]).alias(out) for out, ks in spec.amounts.items()]
    return items.select(
        "id", "company_name", "company_tin", *[value(key).alias(out) for out, key in keys.items()], *amounts
    )


def registry_residents(base: DataFrame) -> DataFrame:
    """Residents: one row per report, from the payloads of report, request and form.

    An export field that holds an array instead of a number is NULL here.
    """
    parsed = parse_payload(base, RESIDENT_FIELDS)
    numbers = (fl.EXPORT_PREVIOUS, fl.EXPORT_CURRENT)

    def field(name: str) -> Column:
        if name in numbers:
            return to_bigint(f"doc.{name}").alias(name)
        return fl.typed("doc", name, fl.STAFF).alias(name)

    return parsed.select(
        "id",
        "company_name",
        F.col("number").alias("request_number"),
        json_str("activation_info", "certificate_number").alias("certificate_number"),
        json_str("activation_info", "issue_date").alias("issue_date"),
        json_str("request_data", "registration_date").alias("registration_date"),
        json_str("hub_form_data", "heads_full_name").alias("heads_full_name"),
        "company_tin",
        *[field(f) for f in RESIDENT_FIELDS],
        "signed_at",
    )


def run_registry(
    name: str,
    reports: DataFrame,
    requests: DataFrame,
    companies: DataFrame,
    forms: DataFrame | None = None,
    year: int | None = None,
    report_type: str | None = None,
    use_flag: bool = True,
    rename_keys: dict[str, str] | None = None,
) -> DataFrame:
    """One registry job by name: ``summary``, ``residents`` or a key of ``REGISTRIES``.

    ``rename_keys`` maps an output column to the item key that holds it in the payload at hand.
    """
    if name == "summary":
        if year is None:
            raise ValueError("the summary registry is made for one year")
        return registry_summary(registry_base(reports, requests, companies, None, year, report_type), year)
    if name == "residents":
        return registry_residents(registry_base(reports, requests, companies, forms, year, report_type))
    if name not in REGISTRIES:
        raise ValueError(f"unknown registry {name!r}")
    spec = REGISTRIES[name]
    flag = spec.flag if use_flag else None
    base = registry_base(reports, requests, companies, None, year, report_type, flag)
    return unnest_registry(base, spec, rename_keys=rename_keys)
