"""Lenient scalar expressions. Nothing here raises under ANSI mode: bad text becomes NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that decide results.
HOME_COUNTRY = "Казахстан"
MASK_PREFIX = "777777"
NO_CERTIFICATE = "-1"
TOKEN_SEPARATOR = "***"

# Text is read through DECIMAL(38,18): 20 integer digits hold any BIGINT, and the fraction is cut
# off (12.7 -> 12, -12.7 -> -12) rather than rounded.
_WIDE_DECIMAL = "decimal(38,18)"


def _read(c: Column | str, target: str) -> Column:
    """A named column goes to the JVM as one expression; wide tables have dozens of these."""
    if isinstance(c, str):
        return F.expr(f"try_cast(try_cast({c} AS {_WIDE_DECIMAL}) AS {target})")
    return c.try_cast(_WIDE_DECIMAL).try_cast(target)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bigint(c: Column | str) -> Column:
    """Text (or number) to BIGINT; fractions are truncated, exponents accepted, junk is NULL."""
    return _read(c, "bigint")


def to_int(c: Column | str) -> Column:
    """Like :func:`to_bigint`, for values that must fit INT; overflow is NULL."""
    return _read(c, "int")


def text_to_bigint(c: str) -> Column:
    """:func:`to_bigint` of a text column: plain digits are read as they are, what else there is by way of the decimal.

    The plain reading also takes off DEL characters at the ends, which the decimal does not; so texts with one go the long way.
    """
    plain = f"if(contains({c}, '\x7f'), NULL, try_cast({c} AS bigint))"
    return F.expr(f"coalesce({plain}, try_cast(try_cast({c} AS {_WIDE_DECIMAL}) AS bigint))")


def to_date(c: Column | str) -> Column:
    """ISO text to DATE; '' and impossible dates are NULL."""
    return _col(c).try_cast("date")


def blank_to_null(c: Column | str, *sentinels: str) -> Column:
    """NULL for '' and for each further sentinel, the value otherwise."""
    return reduce(lambda acc, s: F.nullif(acc, F.lit(s)), ("", *sentinels), _col(c))


def first_non_blank(*cols: Column | str) -> Column:
    """First value that is neither NULL nor ''."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def is_blank(c: Column | str) -> Column:
    """True for NULL and ''. Never NULL itself."""
    return _col(c).isNull() | (_col(c) == F.lit("")).eqNullSafe(F.lit(True))


def nth_token(c: Column | str, n: int, sep: str = TOKEN_SEPARATOR) -> Column:
    """The n-th (1-based) token of a delimited string, NULL where there are fewer tokens."""
    pattern = "\\Q" + sep + "\\E"
    return blank_to_null(F.get(F.split(_col(c), pattern), F.lit(n - 1)))


def labelled_digits(c: Column | str, label: str) -> Column:
    """Digits after ``label:``, NULL where the label is missing."""
    return blank_to_null(F.regexp_extract(_col(c), rf"\Q{label}:\E\s*(\d+)", 1))


def is_resident(country: Column | str, home: str = HOME_COUNTRY) -> Column:
    """NULL, '' and the home country all count as resident."""
    return F.coalesce(blank_to_null(country), F.lit(home)) == F.lit(home)


def is_masked(c: Column | str, prefix: str = MASK_PREFIX) -> Column:
    """True where the identifier carries the mask prefix; NULL counts as not masked."""
    return F.coalesce(_col(c).startswith(prefix), F.lit(False))


def null_safe_sum(*cols: Column | str) -> Column:
    """Row-wise sum that takes NULL as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``round(part * 100 / whole, digits)`` as an exact decimal, NULL where whole is 0.

    Decimal division keeps the rounding identical on every platform. Both sides may have six decimal places.
    """
    number = "decimal(25,6)"
    share = (_col(part).cast(number) * F.lit(100)) / F.nullif(_col(whole).cast(number), F.lit(0).cast(number))
    return F.round(share, digits).cast("double")


def certificate_source(report: Column | str, participant: Column | str, request: Column | str) -> Column:
    """Which of the three levels supplies the certificate number."""
    return (
        F.when(~is_blank(report), "from_report")
        .when(_col(participant).isNotNull(), "from_participants")
        .when(F.nullif(_col(request), F.lit(NO_CERTIFICATE)).isNotNull(), "from_servicerequest")
        .otherwise("missing")
    )
