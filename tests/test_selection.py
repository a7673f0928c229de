"""Order statistics by selection, against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from cdcstrata.operators import aggregates, selection


def sketches(df, kind):
    agg = getattr(F, f"kll_sketch_agg_{kind}")
    row = df.agg(agg("x").alias("s"), F.count("x").alias("n")).first()
    return {"x": (kind, bytes(row["s"]), row["n"])}


CASES = {
    "many": [random.Random(1).randint(-(10**12), 10**12) for _ in range(6000)],
    "ties": [random.Random(2).choice([0, 0, 0, 5, 7, 7]) for _ in range(4000)],
    "two": [0] * 3000 + [1] * 3000,
    "one value": [42] * 3000,
    "steep": [2**k for k in range(60)] * 40 + [0] * 500,
    "null": [None, 3, None, 1, 2],
    "single": [9],
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_ranks_equal_those_of_a_sort(spark, name, kind, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 50)
    df = spark.createDataFrame([(x,) for x in CASES[name]], "x bigint").select(F.col("x").cast(kind)).repartition(4).persist()
    known = sorted(x for x in CASES[name] if x is not None)
    n = len(known)
    ranks = sorted({0, n - 1, n // 2, n // 3, n // 4, (3 * n) // 4, min(n - 1, 1)})
    got = selection.order_statistics(df, {"x": ranks}, sketches(df, kind))
    assert got == {("x", r): known[r] for r in ranks}
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = df.agg(F.percentile("x", points)).first()[0]
    assert selection.exact_quantiles(df, points, sketches(df, kind))["x"] == pytest.approx(want, rel=1e-12)
    df.unpersist()


def test_a_bracket_that_misses_is_drawn_wider(spark, monkeypatch):
    """A sketch of other values sends the first brackets astray."""
    monkeypatch.setattr(selection, "FEW", 50)
    df, other = spark.range(5000).selectExpr("id * 3 AS x"), spark.range(5000).selectExpr("id * 3 + 200 AS x")
    got = selection.order_statistics(df, {"x": [2500]}, {"x": ("bigint", sketches(other, "bigint")["x"][1], 5000)})
    assert got == {("x", 2500): 7500}


def test_profile_of_mixed_columns(spark):
    df = spark.range(1, 102).selectExpr("id AS a", "IF(id % 2 = 0, id / 4, double('NaN')) AS b", "CAST(NULL AS INT) AS c")
    got = {r["column"]: r for r in aggregates.numeric_profile(df, ["a", "b", "c"]).collect()}
    assert (got["a"]["p25"], got["a"]["p50"], got["a"]["max"]) == (26.0, 51.0, 101.0)
    assert (got["b"]["count"], got["b"]["p50"]) == (50, 12.75)
    assert (got["c"]["count"], got["c"]["p50"], got["c"]["min"]) == (0, None, None)
    sketched = aggregates.numeric_profile(df, ["a"], accuracy=1000)
    assert sketched.first()["p50"] == 51.0


def test_no_pass_holds_all_values(spark):
    """Counting and bracketing go by counts and sketches; nothing is collected, sorted or held by value."""
    df = spark.range(1000).selectExpr("id AS x")
    search = selection._Search("x", 500, "bigint", b"", inside=1000)
    plan = df.agg(*search.counts(400, 600, 0))._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan and "Sort" not in plan and "kll" in plan
