"""Row filters. All of them are plain columns, so they reach the Parquet scan where they can."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcstrata.functions.payload import UNAVAILABLE_PAYLOAD
from cdcstrata.functions.periods import QUARTERS

# Fixed values that decide results.
DELETE = "d"
SIGNED = "signed"
FIRST_YEAR = 2019


def not_deleted(df: DataFrame, op: str = "op") -> DataFrame:
    """Drop delete records; a NULL operation is dropped too."""
    return df.filter(F.col(op) != DELETE)


def signed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == SIGNED)


def in_years(df: DataFrame, start: int | None = FIRST_YEAR, year: int | None = None) -> DataFrame:
    """One exact year, or a floor. Prunes partitions on tables partitioned by year."""
    if year is not None:
        return df.filter(F.col("year") == year)
    return df if start is None else df.filter(F.col("year") >= start)


def report_filter(
    year: int | None = None, report_type: str | None = None, start_year: int | None = FIRST_YEAR
) -> Column:
    """Signed, not deleted, of one year (or from ``start_year``) and optionally of one type."""
    cond = (F.col("op") != DELETE) & (F.col("status") == SIGNED)
    if year is not None:
        cond = cond & (F.col("year") == year)
    elif start_year is not None:
        cond = cond & (F.col("year") >= start_year)
    if report_type is not None:
        cond = cond & (F.col("report_type") == report_type)
    return cond


def quarters_only(df: DataFrame) -> DataFrame:
    """Keep quarters: the yearly report repeats them and must not be added on top."""
    return df.filter(F.col("report_type").isin(*QUARTERS))


def has_payload(payload: Column | str = "data") -> Column:
    """True where the payload is there: not NULL and not the capture tool's placeholder."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return c.isNotNull() & (c != UNAVAILABLE_PAYLOAD)


def payload_available(df: DataFrame, payload: str = "data") -> DataFrame:
    return df.filter(has_payload(payload))


def with_op(df: DataFrame, *ops: str) -> DataFrame:
    """Keep only the given operations, e.g. ``with_op(df, "r")`` for snapshot reads."""
    return df.filter(F.col("op").isin(*ops))


def flag_true(df: DataFrame, flag: str, payload: str = "data") -> DataFrame:
    """Keep rows whose JSON flag is the text (or boolean) true."""
    return df.filter(F.get_json_object(F.col(payload), f"$.{flag}") == "true")


def requests_of(df: DataFrame, service_id: str, statuses: Iterable[str] | None = None) -> DataFrame:
    out = df.filter(F.col("service_id") == service_id)
    return out if statuses is None else out.filter(F.col("bp_status").isin(*statuses))


def changed_since(df: DataFrame, since: str, column: str = "updated_at") -> DataFrame:
    """Rows changed at or after ``since``. The moment is passed in, so a rerun reads the same rows."""
    return df.filter(F.col(column) >= F.lit(since).cast(df.schema[column].dataType))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)
