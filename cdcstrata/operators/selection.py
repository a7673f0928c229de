"""Exact order statistics of any number of values, without a task that holds them.

A mergeable sketch of the values in an open interval brackets each wanted rank between two values; one pass then counts what
lies below, at and above them, which either hits the rank or leaves a smaller open interval around it, with its own
sketch. A bracket that misses is drawn wider. Once few values are left in every interval, one last pass fetches those with
their counts. All ranks of all columns share each pass, and a pass sends one row of counts and small sketches.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: So many values of an interval may be fetched, and by how much of its rows a bracket first reaches beyond the rank.
FEW = 20_000
MARGIN = 0.03

Number = int | float


@dataclass
class _Search:
    """A rank (from 0, among the values that are not NULL) and the open interval that its value lies in."""

    column: str
    rank: int
    kind: str  # bigint or double
    sketch: bytes
    low: Number | None = None
    high: Number | None = None
    below: int = 0  # values up to and with ``low``
    inside: int = 0
    margin: float = MARGIN
    value: Number | None = None

    def within(self, low: Number | None, high: Number | None) -> Column:
        x, kept = F.col(self.column), F.lit(True)
        if low is not None:
            kept = kept & (x > F.lit(low).cast(self.kind))
        if high is not None:
            kept = kept & (x < F.lit(high).cast(self.kind))
        return kept & x.isNotNull()

    def shares(self) -> list[float]:
        """Where in the interval's sketch the bracket begins and ends."""
        at = (self.rank - self.below) / self.inside
        return [max(0.0, at - self.margin), min(1.0, at + self.margin)]

    def counts(self, a: Number, b: Number, k: int) -> list[Column]:
        x, (left, right) = F.col(self.column), (F.lit(v).cast(self.kind) for v in (a, b))
        sketch = getattr(F, f"kll_sketch_agg_{self.kind}")
        between = (x > left) & (x < right)
        return [
            F.struct(
                F.count_if(x < left).alias("under_a"),
                F.count_if(x <= left).alias("upto_a"),
                F.count_if(x < right).alias("under_b"),
                F.count_if(x <= right).alias("upto_b"),
                sketch(F.when(between, x)).alias("sketch"),
            ).alias(f"s{k}")
        ]

    def narrow(self, a: Number, b: Number, got) -> None:
        """Take the counts of a bracket in."""
        if got["under_a"] <= self.rank < got["upto_a"]:
            self.value = a
        elif got["under_b"] <= self.rank < got["upto_b"]:
            self.value = b
        elif got["upto_a"] <= self.rank < got["under_b"]:
            self.low, self.high, self.below = a, b, got["upto_a"]
            self.inside, self.sketch, self.margin = got["under_b"] - got["upto_a"], bytes(got["sketch"]), MARGIN
        else:
            self.margin *= 4


def _quantiles(df: DataFrame, searches: Sequence[_Search]) -> list[list[Number]]:
    """The values at the ends of each bracket, from the sketches."""
    rows = df.sparkSession.createDataFrame(
        [tuple(s.sketch for s in searches)], ", ".join(f"s{k} binary" for k in range(len(searches)))
    )
    ends = []
    for k, s in enumerate(searches):
        at = getattr(F, f"kll_sketch_get_quantile_{s.kind}")
        ends.append(F.array(*[at(f"s{k}", F.lit(share)) for share in s.shares()]))
    return [list(x) for x in rows.select(*ends).first()]


def order_statistics(df: DataFrame, ranks: Mapping[str, Sequence[int]], sketches: Mapping[str, tuple[str, bytes, int]]) -> dict:
    """The values at the given ranks of each column, as ``(column, rank) -> value``.

    ``sketches`` has each column's kind (``bigint`` or ``double``), the sketch of its values and their number. ``df`` is read
    once a round, so let it be stored and narrow. The rounds are few: each leaves about a fifteenth of an interval.
    """
    searches = []
    for column, wanted in ranks.items():
        kind, sketch, n = sketches[column]
        searches += [_Search(column, rank, kind, sketch, inside=n) for rank in dict.fromkeys(wanted)]
    while open_ := [s for s in searches if s.value is None and s.inside > FEW]:
        brackets = _quantiles(df, open_)
        wanted = [c for k, (s, (a, b)) in enumerate(zip(open_, brackets, strict=True)) for c in s.counts(a, b, k)]
        got = df.agg(*wanted).first()
        for k, (s, (a, b)) in enumerate(zip(open_, brackets, strict=True)):
            s.narrow(a, b, got[f"s{k}"])
    _fetch(df, [s for s in searches if s.value is None])
    return {(s.column, s.rank): s.value for s in searches}


def _fetch(df: DataFrame, searches: list[_Search]) -> None:
    """Read the values that are left in the intervals, FEW a search at most, grouped by value."""
    if not searches:
        return
    for kind in ("bigint", "double"):
        some = [(k, s) for k, s in enumerate(searches) if s.kind == kind]
        if not some:
            continue
        tagged = [
            F.when(s.within(s.low, s.high), F.struct(F.lit(k).alias("k"), F.col(s.column).cast(kind).alias("x"))) for k, s in some
        ]
        any_ = reduce(Column.__or__, [s.within(s.low, s.high) for _, s in some])
        values = df.filter(any_).select(F.explode(F.array_compact(F.array(*tagged))).alias("v")).groupBy("v.k", "v.x").count()
        found: dict[int, list] = {}
        for r in values.collect():
            found.setdefault(r["k"], []).append((r["x"], r["count"]))
        for k, s in some:
            at = s.below
            for x, count in sorted(found[k]):
                at += count
                if s.rank < at:
                    s.value = x
                    break


def quantile_ranks(point: float, n: int) -> tuple[int, int, float]:
    """The two ranks that an interpolated quantile lies between, and how far from the first."""
    at = point * (n - 1)
    return math.floor(at), math.ceil(at), at - math.floor(at)


def exact_quantiles(
    df: DataFrame, points: Sequence[float], sketches: Mapping[str, tuple[str, bytes, int]]
) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column; None where it has no value."""
    ranks = {
        c: [r for p in points for r in quantile_ranks(p, n)[:2]] for c, (_, _, n) in sketches.items() if n
    }
    values = order_statistics(df, ranks, sketches)
    out: dict[str, list[float | None]] = {}
    for c, (_, _, n) in sketches.items():
        if not n:
            out[c] = [None] * len(points)
            continue
        each = []
        for p in points:
            first, second, part = quantile_ranks(p, n)
            low, high = values[c, first], values[c, second]
            each.append((1 - part) * low + part * high if first != second else float(low))
        out[c] = each
    return out
