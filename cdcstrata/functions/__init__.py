"""Column helpers: lenient typing, payload extraction and period arithmetic."""

from cdcstrata.functions.payload import (
    has_item_country,
    is_json_array,
    json_items,
    json_str,
    parse_payload,
    xml_tag,
)
from cdcstrata.functions.periods import days_before, period_label, previous_quarter
from cdcstrata.functions.scalars import (
    blank_to_null,
    certificate_source,
    first_non_blank,
    is_blank,
    is_masked,
    is_resident,
    labelled_digits,
    nth_token,
    null_safe_sum,
    percent,
    to_bigint,
    to_date,
    to_int,
)

__all__ = [
    "blank_to_null",
    "certificate_source",
    "days_before",
    "first_non_blank",
    "has_item_country",
    "is_blank",
    "is_json_array",
    "is_masked",
    "is_resident",
    "json_items",
    "json_str",
    "labelled_digits",
    "nth_token",
    "null_safe_sum",
    "parse_payload",
    "percent",
    "period_label",
    "previous_quarter",
    "to_bigint",
    "to_date",
    "to_int",
    "xml_tag",
]
