"""Staged swaps are read by table partition and not shuffled again."""

from cdcstrata.sources import pending, writers


def test_staged_rows_are_swapped_in_without_a_shuffle(spark, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS laid_out")
    rows = spark.createDataFrame([("a", 1, 2020), ("b", 2, 2021), ("c", 3, None), ("d", 4, 2022)], "k string, n bigint, year int")
    writers.create_or_replace(rows, "laid_out", partition_by=["year"])

    def shuffled(*_):
        raise AssertionError("staged rows are shuffled again")

    monkeypatch.setattr(writers, "clustered", shuffled)
    try:
        new = spark.createDataFrame([(2020, 10, "A"), (None, 30, "C")], "year int, n int, k string")
        hit = spark.createDataFrame([(2020,), (2021,), (None,)], "year int")
        pending.swap_all(spark, "laid_out", [pending.Swap("laid_out", new, hit)])
        got = sorted(map(tuple, spark.table("laid_out").select("k", "n", "year").collect()))
        assert got == [("A", 10, 2020), ("C", 30, None), ("d", 4, 2022)]
        pending.swap_all(spark, "laid_out", [pending.Swap("laid_out", new.filter("n < 0"), hit)])  # nothing is left
        assert [tuple(r) for r in spark.table("laid_out").select("k", "n", "year").collect()] == [("d", 4, 2022)]
    finally:
        spark.sql("DROP TABLE laid_out")
