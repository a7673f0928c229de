"""Readers see all tables of the old run or all of the new one, wherever a run is cut."""

import pytest
from pyspark.sql import functions as F

from cdcstrata.sources import releases as R

SCHEMA = "k int, v string, year int"


@pytest.fixture()
def marts(spark, request):
    base = "rel_" + request.node.name.split("[")[0].lower()
    out = R.Releases(spark, f"{base}_journal", {f"{base}_a": ["year"], f"{base}_b": []})
    out.drop()
    yield out
    out.drop()


def builds(spark, marts, version, years=(2023, 2024)):
    a, b = marts.partition_by
    rows = spark.createDataFrame([(k, version, years[k % len(years)]) for k in range(6)], SCHEMA)
    return {a: lambda of: rows, b: lambda of: of(a).groupBy("v").agg(F.count(F.lit(1)).alias("n"))}


def seen(spark, marts):
    """What one query over both views finds: the versions and the row counts that go with them."""
    a, b = marts.partition_by
    rows = spark.sql(f"SELECT 'a' AS t, v, count(*) AS n FROM {a} GROUP BY v UNION ALL SELECT 'b', v, n FROM {b}")
    return sorted(tuple(r) for r in rows.collect())


def whole(version):
    return [("a", version, 6), ("b", version, 6)]


def test_runs_replace_each_other(spark, marts):
    assert marts.released is None
    marts.refresh("one", builds(spark, marts, "old"))
    assert seen(spark, marts) == whole("old") and marts.released == "one"
    marts.refresh("two", builds(spark, marts, "new", years=(2025,)))
    assert seen(spark, marts) == whole("new")
    marts.refresh("two", builds(spark, marts, "other"))  # done already
    assert seen(spark, marts) == whole("new")
    marts.drop_old(keep=1)
    a = next(iter(marts.partition_by))
    assert {r[R.RUN] for r in spark.table(marts.rows_of(a)).collect()} == {"two"} and seen(spark, marts) == whole("new")
    with pytest.raises(ValueError):
        marts.refresh("three", {a: lambda of: spark.range(1)})


# What lies between two notes of the journal is cut by the one before it or after it; views are made without a note.
STEPS = [("_note", n, after) for n in range(4) for after in (False, True)] + [("_view", 1, False)]


@pytest.mark.parametrize("method,number,after", STEPS)
def test_a_cut_at_every_step(spark, marts, method, number, after, monkeypatch):
    marts.refresh("one", builds(spark, marts, "old"))
    original, calls = getattr(R.Releases, method), []

    def cut(self, *args):
        calls.append(args)
        if len(calls) != number + 1:
            return original(self, *args)
        if after:
            original(self, *args)
        raise RuntimeError("cut")

    monkeypatch.setattr(R.Releases, method, cut)
    with pytest.raises(RuntimeError):
        marts.refresh("two", builds(spark, marts, "new"))
    monkeypatch.undo()
    released = (method, number, after) == ("_note", 3, True)
    assert seen(spark, marts) == whole("new" if released else "old")
    # The next run goes on with the one that was cut, or begins where none is open.
    goes_on = marts.open_run() == "two"
    marts.refresh("three", builds(spark, marts, "new" if goes_on else "newest"))
    assert seen(spark, marts) == whole("new" if goes_on else "newest")
    assert marts.released == ("two" if goes_on else "three") and marts.open_run() is None


def test_filled_tables_are_not_built_again(spark, marts, monkeypatch):
    a, b = marts.partition_by
    built = []
    make = builds(spark, marts, "old")

    def failing(of):
        raise RuntimeError("cut")

    def once(of):
        built.append(a)
        return make[a](of)

    with pytest.raises(RuntimeError):
        marts.refresh("one", {a: once, b: failing})
    marts.refresh("one", {a: once, b: make[b]})
    assert built == [a] and seen(spark, marts) == whole("old")


def test_a_view_reads_its_run_only(spark, marts):
    for run in ("one", "two", "three"):
        marts.refresh(run, builds(spark, marts, run))
    a = next(iter(marts.partition_by))
    df = spark.table(a).filter("year = 2024")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("PushedFilters")[0]
    assert R.RUN in filters and "year" in filters
