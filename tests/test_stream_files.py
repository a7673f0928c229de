"""Streams of the checks come from as many files as tasks write, whatever the number of batches."""

from datetime import datetime

from cdcstrata.checks import registered


def _sources(spark, tmp_path, monkeypatch, query):
    days = [datetime(y, m, 5) for y in (1993, 1994, 1995, 1996) for m in range(1, 13)]
    rows = [(n, n % 9, 100.0 + n, days[n % len(days)], "F") for n in range(1, 400)]
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderstatus string"
    spark.createDataFrame(rows, schema).repartition(6).write.parquet(f"{tmp_path}/orders.parquet")
    kept = []
    monkeypatch.setattr(registered, "release", lambda spark, *paths: kept.extend(paths))
    out = registered.queries()[query](spark, str(tmp_path)).count()
    return out, len(spark.read.parquet(kept[0]).inputFiles())


def test_a_year_is_not_one_file(spark, tmp_path, monkeypatch):
    rows, files = _sources(spark, tmp_path, monkeypatch, "stream_replays_dropped")
    assert files > 4  # it was one a year, made by one task
    assert rows == sum(1 + (n % 3 == 0) + (n % 20 == 0) + (n % 9 == 0) for n in range(1, 400))  # every version once


def test_a_third_of_the_log_is_not_two_files(spark, tmp_path, monkeypatch):
    rows, files = _sources(spark, tmp_path, monkeypatch, "stream_cdc_equals_batch")
    assert files > 6
    assert rows == sum(n % 20 != 0 or n % 9 == 0 for n in range(1, 400))  # an update may come after the delete
