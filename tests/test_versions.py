"""Latest version, tombstones, stitching, replays; results and plan shape."""

import pytest
from pyspark.sql import functions as F

from cdcstrata.functions.payload import UNAVAILABLE_PAYLOAD
from cdcstrata.operators import predicates as q
from cdcstrata.operators import versions as v


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tombstones(log):
    df = log(
        {"id": 1, "day": 1, "data": "{}"},
        {"id": 1, "day": 2, "op": "d"},
        {"id": 2, "day": 1, "data": "{}"},
        {"id": 2, "day": 3, "op": "u", "data": "{}"},
    )
    assert pairs(v.latest(df, ["id"]), "id", "op") == [(2, "u")]
    assert pairs(v.latest(df, ["id"], tombstones="before"), "id", "op") == [(1, "r"), (2, "u")]
    assert pairs(v.latest(df, ["id"], tombstones="keep"), "id", "op") == [(1, "d"), (2, "u")]
    with pytest.raises(ValueError):
        v.latest(df, ["id"], tombstones="never")


def test_ties_are_broken_the_same_way_every_time(log):
    rows = [{"id": i, "day": 1, "data": "{}"} for i in (3, 9, 5)]
    for order in (rows, rows[::-1]):
        assert pairs(v.latest(log(*order), ["service_request_id", "year"], ["updated_at"]), "id") == [(9,)]
    same_time = [{"id": 1, "day": 1, "op": "u", "data": "{}"}, {"id": 1, "day": 1, "op": "d"}]
    for order in (same_time, same_time[::-1]):
        assert pairs(v.latest(log(*order), ["id"], tombstones="keep"), "op") == [("d",)]


def test_payload_less_updates_can_be_passed_over_but_deletes_count(log):
    df = log(
        {"id": 1, "day": 1, "data": '{"a":1}'},
        {"id": 1, "day": 2, "op": "u", "data": UNAVAILABLE_PAYLOAD},
        {"id": 2, "day": 1, "data": '{"a":1}'},
        {"id": 2, "day": 2, "op": "d"},
    )
    assert pairs(v.latest(df, ["id"]), "id", "op") == [(1, "u")]
    assert pairs(v.latest(df, ["id"], require_payload=True), "id", "op") == [(1, "r")]


def test_latest_is_idempotent(log):
    df = log({"id": 1, "day": 1, "data": "a"}, {"id": 1, "day": 2, "data": "b"}, {"id": 2, "data": "c"})
    once = v.latest(df, ["id"])
    assert pairs(v.latest(once, ["id"]), "id", "data") == pairs(once, "id", "data")


@pytest.mark.parametrize("tombstones", ["before", "after", "keep"])
def test_ranking_reduces_before_its_only_exchange(spark, tmp_path, log, tombstones):
    log({"id": 1, "data": "a"}).write.parquet(str(tmp_path / "log"))
    text = plan(v.latest(spark.read.parquet(str(tmp_path / "log")), ["id"], tombstones=tombstones))
    assert text.count("Exchange") == 1
    final, partial = text.split("Exchange")
    assert "WindowGroupLimit" in final and "WindowGroupLimit" in partial


def test_hot_key(spark):
    """One key with nearly all rows: the newest still wins, and map tasks ship a row each."""
    n = 200_000
    df = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(-1).alias("key"),
        F.col("id").alias("updated_ts"),
        F.lit("u").alias("op"),
    )
    got = v.latest(df, ["key"])
    assert got.count() == n // 50 + 1
    assert got.filter("key = -1").first()["updated_ts"] == n - 1


def test_stitching(log):
    df = log(
        {"id": 1, "day": 1, "data": "old", "signature": "s1"},
        {"id": 1, "day": 2, "data": "new", "signature": "s2"},
        {"id": 1, "day": 3, "op": "u", "signature": "u1", "status": "rejected"},
        {"id": 1, "day": 4, "op": "u", "data": UNAVAILABLE_PAYLOAD, "signature": "u2"},
        {"id": 2, "op": "r", "data": "only snapshot"},
        {"id": 3, "op": "c", "data": "created"},
        {"id": 4, "op": "u", "data": None},
        {"id": 5, "op": "r", "data": UNAVAILABLE_PAYLOAD},
    )
    got = v.stitch_versions(df)
    assert pairs(got, "id", "snapshot.data", "update.signature") == [(1, "new", "u2"), (2, "only snapshot", None)]
    with_created = v.stitch_versions(df, snapshot_ops=("r", "c"))
    assert pairs(with_created, "id") == [(1,), (2,), (3,)]
    assert plan(got).count("Exchange") == 1


def test_replays_and_duplicates(log):
    df = log({"id": 1, "data": "a"}, {"id": 1, "data": "a"}, {"id": 1, "day": 2, "data": "b"}, {"id": 2, "data": "c"})
    assert v.drop_replays(df).count() == 3
    assert pairs(v.duplicate_groups(df, ["id"]), "id", "cnt") == [(1, 3)]
    assert pairs(v.distinct_keys(df, ["id"]), "id") == [(1,), (2,)]


def test_predicates(log):
    df = log(
        {"id": 1, "data": '{"f":"true"}', "year": 2018},
        {"id": 2, "data": '{"f":true}', "type": "yearly"},
        {"id": 3, "data": UNAVAILABLE_PAYLOAD, "status": "draft"},
        {"id": 4, "op": "d"},
        {"id": 5, "op": None, "data": "x"},
    )
    ids = lambda x: [r[0] for r in pairs(x, "id")]
    assert ids(q.not_deleted(df)) == [1, 2, 3]
    assert ids(q.signed(df)) == [1, 2, 4, 5]
    assert ids(q.in_years(df)) == [2, 3, 4, 5]
    assert ids(q.in_years(df, year=2018)) == [1]
    assert ids(q.quarters_only(df)) == [1, 3, 4, 5]
    assert ids(q.payload_available(df)) == [1, 2, 5]
    assert ids(q.flag_true(df, "f")) == [1, 2]
    assert ids(df.filter(q.report_filter())) == [2]
    assert ids(df.filter(q.report_filter(year=2018, report_type="quarter1"))) == [1]
    assert ids(q.changed_since(df, "2024-01-02")) == []
    assert len(ids(q.changed_since(df, "2024-01-01 00:00:00"))) == 5


def test_stitching_settles_equal_times(spark, log):
    """Whatever the order of the input, versions of one time give one outcome; a snapshot is not an update."""
    versions_ = [{"id": 1, "day": 3, "data": f'{{"v":{k}}}', "signature": f"s{k}"} for k in range(6)]
    versions_ += [{"id": 1, "day": 4, "op": "u", "signature": f"u{k}"} for k in range(6)]
    seen = set()
    for turn in range(4):
        df = log(*(versions_[turn:] + versions_[:turn])).repartition(3 + turn)
        row = v.stitch_versions(df).first()
        seen.add((row.snapshot.data, row.update.signature))
    assert len(seen) == 1


def test_stitching_tombstones(spark, log):
    df = log({"id": 1, "day": 1, "data": "{}"}, {"id": 1, "day": 5, "op": "d"}, {"id": 2, "day": 1, "op": "d"}, {"id": 2, "day": 2, "data": "{}"})
    assert [r.id for r in v.stitch_versions(df).orderBy("id").collect()] == [1, 2]
    assert [r.id for r in v.stitch_versions(df, tombstones="after").collect()] == [2]
    with pytest.raises(ValueError):
        v.stitch_versions(df, tombstones="keep")
