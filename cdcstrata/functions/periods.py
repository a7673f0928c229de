"""Reporting periods: quarter names, labels and relative dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results.
QUARTERS = ("quarter1", "quarter2", "quarter3", "quarter4")
YEARLY = "yearly"
# style -> (text before the year, text after the year) for quarter n and for the whole year
PERIOD_STYLES = {
    "en": {"quarter": ("Q{n} ", ""), "year": ("Year ", "")},
    "ru": {"quarter": ("{n} кв. ", ""), "year": ("Итого ", "")},
    "ru_long": {"quarter": ("{n} кв. ", " г."), "year": ("Итого ", " г.")},
    "ru_short": {"quarter": ("{n}кв.", "г."), "year": ("итого.", "г.")},
}


def period_label(report_type: Column | str, year: Column | str | int, style: str = "en") -> Column:
    """Readable period such as ``Q1 2024``.

    Anything that is not a quarter gets the whole-year label, but the ``ru_short`` style labels just
    'yearly' that way and passes unknown types through.
    """
    kind = F.col(report_type) if isinstance(report_type, str) else report_type
    y = (F.lit(year) if isinstance(year, int) else F.col(year) if isinstance(year, str) else year).cast("string")
    text = PERIOD_STYLES[style]

    def label(pair: tuple[str, str], n: int | None = None) -> Column:
        return F.concat(F.lit(pair[0].format(n=n)), y, F.lit(pair[1]))

    out = None
    for n, quarter in enumerate(QUARTERS, start=1):
        value = label(text["quarter"], n)
        out = F.when(kind == quarter, value) if out is None else out.when(kind == quarter, value)
    if style == "ru_short":
        return out.when(kind == YEARLY, label(text["year"])).otherwise(kind)
    return out.otherwise(label(text["year"]))


def previous_quarter(day: Column | str) -> tuple[Column, Column]:
    """(year, 'quarterN') of the quarter before the one ``day`` falls in."""
    back = F.add_months(F.col(day) if isinstance(day, str) else day, -3)
    return F.year(back), F.concat(F.lit("quarter"), F.quarter(back).cast("string"))


def days_before(ts: Column | str, n: int) -> Column:
    """The DATE n days before ``ts``: a cutoff at midnight, not n * 24 hours."""
    return F.date_sub(F.col(ts) if isinstance(ts, str) else ts, n)
