"""Loads by a stored mark: repeats and cuts leave what a single load leaves."""

import pytest

from cdcstrata.plans import crm
from cdcstrata.sources.load_state import LoadState

EVENTS = "id bigint, type string, entity_type string, entity_id bigint, created_at bigint"
DAY = 86_400
BEGIN = 1_704_067_200  # 2024-01-01


@pytest.fixture()
def place(spark, request):
    base = "l_" + request.node.name.split("[")[0].lower()
    names = [f"{base}_{n}" for n in ("state", "events", "leads", "users")]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    yield lambda name: f"{base}_{name}"
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def events(spark, *at):
    return spark.createDataFrame([(i, "note", "leads", i % 3, t) for i, t in at], EVENTS)


def ids(spark, place):
    return sorted(r["id"] for r in spark.table(place("events")).select("id").collect())


def test_marks(spark, place):
    state = LoadState(spark, place("state"))
    assert state.mark("events") is None and not state.is_done("events", "a")
    state.commit("events", 5, "a")
    state.commit("events", 3, "b")
    state.commit("leads", None, "a")
    assert state.mark("events") == 5 and state.mark("leads") is None and state.is_done("leads", "a")


def test_events_are_loaded_once(spark, place):
    state = LoadState(spark, place("state"))
    first = [(1, BEGIN), (2, BEGIN + 10), (2, BEGIN + 10), (3, BEGIN + DAY)]
    late = [(4, BEGIN + DAY - 5)]  # made visible after the first load, inside the overlap
    then = [(5, BEGIN + 2 * DAY)]
    crm.load_run(spark, {"events": events(spark, *first)}, place, state, "one")
    assert ids(spark, place) == [1, 2, 3] and state.mark("events") == BEGIN + DAY
    crm.load_run(spark, {"events": events(spark, *first, *late)}, place, state, "two")
    assert ids(spark, place) == [1, 2, 3, 4]
    crm.load_run(spark, {"events": events(spark, *first, *late, *then)}, place, state, "three")
    crm.load_run(spark, {"events": events(spark, *first, *late, *then)}, place, state, "three")  # done: nothing is read
    assert ids(spark, place) == [1, 2, 3, 4, 5] and state.mark("events") == BEGIN + 2 * DAY
    assert crm.crm_events_silver(spark.table(place("events"))).filter("year = 2024").count() == 5
    crm.load_run(spark, {"events": events(spark)}, place, state, "nothing new")
    assert state.mark("events") == BEGIN + 2 * DAY


@pytest.mark.parametrize("cut", ["before the data", "before the mark"])
def test_a_cut_load_is_repeated(spark, place, cut, monkeypatch):
    state = LoadState(spark, place("state"))
    crm.load_run(spark, {"events": events(spark, (1, BEGIN))}, place, state, "one")
    everything = events(spark, (1, BEGIN), (2, BEGIN + 50), (3, BEGIN + DAY))

    def fail(*args, **kwargs):
        raise RuntimeError("cut")

    if cut == "before the data":
        monkeypatch.setattr(crm, "append_events", fail)
    else:
        monkeypatch.setattr(LoadState, "commit", fail)
    with pytest.raises(RuntimeError):
        crm.load_run(spark, {"events": everything}, place, state, "two")
    assert state.mark("events") == BEGIN
    monkeypatch.undo()
    crm.load_run(spark, {"events": everything}, place, state, "two")
    assert ids(spark, place) == [1, 2, 3] and state.mark("events") == BEGIN + DAY


def test_entities_by_mark_and_order(spark, place):
    state, schema = LoadState(spark, place("state")), "id bigint, v string, updated_at bigint"
    users = spark.createDataFrame([(1, "u")], "id bigint, v string")
    leads = lambda *rows: spark.createDataFrame(list(rows), schema)
    crm.load_run(spark, {"leads": leads((1, "a", 100), (2, "b", 9000)), "users": users}, place, state, "one")
    assert state.is_done("users", "one") and state.mark("users") is None and state.mark("leads") == 9000
    # Beyond the overlap a change is not looked for again; the newer of two wins.
    crm.load_run(spark, {"leads": leads((1, "lost", 200), (2, "c", 9500), (2, "old", 8000), (3, "d", 9400))}, place, state, "two")
    got = {r["id"]: r["v"] for r in spark.table(place("leads")).collect()}
    assert got == {1: "a", 2: "c", 3: "d"} and state.mark("leads") == 9500


def test_only_recent_days_are_searched(spark, place):
    state = LoadState(spark, place("state"))
    rows = events(spark, *[(k, BEGIN + k * DAY) for k in range(30)])
    crm.load_run(spark, {"events": rows}, place, state, "one")
    there = spark.table(place("events")).filter("day >= to_date(timestamp_seconds(%d))" % (BEGIN + 28 * DAY))
    assert {f.split("day=")[1][:10] for f in there.inputFiles()} == {"2024-01-29", "2024-01-30"}
