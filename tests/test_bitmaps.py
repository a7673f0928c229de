"""Merged distinct counts equal those taken from the rows."""

import pytest
from pyspark.sql import functions as F

from cdcstrata.operators import bitmaps
from cdcstrata.operators.numbering import numbered
from cdcstrata.plans import bi

SCHEMA = "year int, country string, bin string"


def exports(spark):
    rows = [(2020 + k % 5, f"c{k % 7}", None if k % 31 == 0 else f"b{(k * k) % 900}") for k in range(4000)]
    return spark.createDataFrame(rows, SCHEMA)


def test_numbers_are_gapless_and_ordered(spark):
    df = spark.range(3000).selectExpr("id * 7 % 3000 AS v")
    got = numbered(df, [F.desc("v")], start=10).collect()
    assert sorted(r["number"] for r in got) == list(range(10, 3010))
    assert all(r["number"] == 3009 - r["v"] for r in got)
    assert numbered(df.filter("v < 0"), ["v"]).count() == 0


def test_ids_stay_as_they_are(spark):
    rows = exports(spark)
    first = bitmaps.extended_ids(rows.filter("year < 2022"), "bin")
    both = bitmaps.extended_ids(rows, "bin", first)
    known = {r["bin"]: r["number"] for r in first.collect()}
    every = {r["bin"]: r["number"] for r in both.collect()}
    assert None not in every and sorted(every.values()) == list(range(1, len(every) + 1))
    assert all(every[b] == n for b, n in known.items()) and len(every) > len(known)


@pytest.mark.parametrize("first,last", [(2020, 2024), (2021, 2021), (2022, 2023), (2030, 2031)])
def test_any_range_of_years(spark, first, last):
    rows = exports(spark)
    stored = bi.exporter_bitmaps(rows, bitmaps.extended_ids(rows, "bin")).persist()
    got = {r["country"]: r["companies_count"] for r in bi.exporters_between(stored, first, last).collect()}
    want = rows.filter(F.col("year").between(first, last)).groupBy("country").agg(F.countDistinct("bin").alias("n"))
    assert got == {r["country"]: r["n"] for r in want.collect()}
    ranges = spark.createDataFrame([(first, last)], "first_year int, last_year int")
    many = {r["country"]: r["companies_count"] for r in bi.exporters_of_ranges(stored, ranges).collect()}
    assert many == got
    stored.unpersist()


def test_more_values_than_a_piece_holds(spark):
    rows = spark.range(70_000).selectExpr("CAST(id % 2 AS INT) AS g", "string(id % 50000) AS v")
    ids = bitmaps.extended_ids(rows, "v")
    stored = bitmaps.distinct_bitmaps(rows, ["g"], "v", ids)
    assert stored.select("piece").distinct().count() == 2
    whole = bitmaps.counted(bitmaps.merged_bitmaps(stored, [F.lit(1).alias("all")]), ["all"])
    assert whole.first()["cnt"] == 50_000


def test_a_refreshed_year_leaves_the_others(spark):
    rows = exports(spark)
    ids = bitmaps.extended_ids(rows, "bin")
    stored = bi.exporter_bitmaps(rows, ids)
    changed = rows.filter("NOT (year = 2023 AND bin < 'b5')")
    again = stored.filter("year <> 2023").unionByName(bi.exporter_bitmaps(changed.filter("year = 2023"), ids))
    state = lambda df: sorted((r["country"], r["companies_count"]) for r in df.collect())
    assert state(bi.exporters_between(again, 2020, 2024)) == state(bi.exporters_between(bi.exporter_bitmaps(changed, ids), 2020, 2024))
