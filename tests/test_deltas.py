"""Summaries kept up by signed contributions equal the summaries built anew."""

import json

import pytest

from cdcstrata.plans import deltas, refresh, silver, summary
from cdcstrata.sources import pending, writers

MEASURES = ("income_total", "residents_count", "tax_incentives")


def make(log):
    return silver.silver_reports(log, start_year=None, tombstones="after")


def version(id, day, year, income, op="r", status="signed", type="quarter1", request=1):
    data = json.dumps({m: income for m in MEASURES}) if op in ("r", "c") else None
    return {"id": id, "day": day, "year": year, "op": op, "status": status, "type": type, "request": request, "data": data}


FIRST = [
    version(1, 1, 2021, 10),
    version(2, 1, 2021, 20, type="quarter2"),
    version(3, 1, 2022, 40, request=2),
    version(4, 2, 2023, 80, request=3, status="draft"),
    version(5, 1, 2024, 160, request=4),
    version(6, 1, 2021, 320, request=5),
]
LATER = [
    version(1, 5, 2022, 11),  # moved to another year
    version(3, 6, 2022, None, op="d", request=2),  # the only row of its group goes
    version(4, 5, 2023, 81, request=3),  # a draft is signed
    version(6, 6, 2021, 321, request=None),  # moved to the group without a request
    version(7, 5, 2023, 7, request=3),
]


@pytest.fixture()
def names(spark, request):
    base = "d_" + request.node.name.split("[")[0].lower()
    names = [base, f"{base}_a", f"{base}_q", f"{base}_t"]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    yield names
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def specs(names):
    return {names[1]: deltas.annual(totals=names[3]), names[2]: deltas.QUARTER}


def state(df):
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def check(spark, names, log):
    rows = make(log)
    annual = summary.annual_summary(rows)
    assert state(spark.table(names[0])) == state(rows)
    assert state(spark.table(names[1])) == state(annual)
    assert state(spark.table(names[3])) == state(summary.annual_totals(annual))
    assert state(deltas.quarter_labels(spark.table(names[2]))) == state(summary.quarter_summary(rows))


def since(log, names, spark):
    refresh.refresh(
        spark, make, log, names[0], "incremental", since="2024-01-05", keys={"id": "report_id"}, summaries=specs(names)
    )


def test_moves_deletes_and_signatures(spark, log, names):
    refresh.refresh(spark, make, log(*FIRST), names[0], summaries=specs(names))
    check(spark, names, log(*FIRST))
    everything = log(*FIRST, *LATER)
    since(everything, names, spark)
    check(spark, names, everything)
    assert {r["service_request_id"] for r in spark.table(names[1]).collect()} == {1, 3, 4, None}
    since(everything, names, spark)  # the same changes again
    check(spark, names, everything)


def test_a_late_older_version_changes_nothing(spark, log, names):
    refresh.refresh(spark, make, log(*FIRST, *LATER), names[0], summaries=specs(names))
    late = version(1, 3, 2019, 99)
    everything = log(*FIRST, *LATER, late)
    since(everything, names, spark)
    check(spark, names, everything)


def test_years(spark, log, names):
    refresh.refresh(spark, make, log(*FIRST), names[0], summaries=specs(names))
    # One year is built anew from a log in which it lost its reports, another from one in which it gained some.
    changed = log(*[v for v in FIRST if v["year"] != 2022], version(9, 9, 2024, 5, request=4))
    refresh.refresh(spark, make, changed, names[0], "years", years=[2022, 2024], summaries=specs(names))
    check(spark, names, changed)


@pytest.mark.parametrize("cut", range(4))
def test_a_cut_run_is_finished_and_counts_once(spark, log, names, cut, monkeypatch):
    refresh.refresh(spark, make, log(*FIRST), names[0], summaries=specs(names))
    everything, swap, calls = log(*FIRST, *LATER), writers.swap_partitions, []

    def failing(*args):
        calls.append(args[1])
        if len(calls) == cut + 1:
            raise RuntimeError("cut")
        swap(*args)

    monkeypatch.setattr(writers, "swap_partitions", failing)
    with pytest.raises(RuntimeError):
        since(everything, names, spark)
    monkeypatch.undo()
    if cut == 2:  # the plan alone, without a new run
        assert pending.resume(spark, names[0])
        check(spark, names, everything)
    since(everything, names, spark)
    check(spark, names, everything)
    assert not pending.resume(spark, names[0])


def test_other_years_are_not_read(spark, log, names):
    refresh.refresh(spark, make, log(*FIRST), names[0], summaries=specs(names))
    spec = specs(names)[names[2]]
    old, new = make(log(version(5, 1, 2024, 160))), make(log(version(5, 1, 2024, 161)))
    delta = spec.delta(old, new)
    swap = deltas.swaps(spark, names[2], spec, delta)[0]
    stored = [f for f in swap.rows.inputFiles() if names[2] in f]
    assert stored and all("year=2024" in f for f in stored)
    plan = deltas.of_years(spark.table(names[2]), [2024])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_delta_of_nothing_touches_nothing(spark, log, names):
    refresh.refresh(spark, make, log(*FIRST), names[0], summaries=specs(names))
    rows = make(log(*FIRST))
    assert deltas.QUARTER.delta(rows, rows).count() == 0
