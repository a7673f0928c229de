"""The streamed state equals the batch result, whatever the order of arrival."""

from cdcstrata.operators.versions import latest
from cdcstrata.streaming import changes


def state(df):
    return sorted((r.id, r.op, str(r.updated_ts), r.data) for r in df.collect())


def run(spark, batches, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = changes.read_changes(spark, source, batch.schema, files_per_batch=1)
        changes.apply_cdc_stream(stream, target, progress).awaitTermination()
    return target


def test_late_versions_and_tombstones(spark, log, tmp_path):
    batches = [
        log({"id": 1, "day": 5, "data": "new"}, {"id": 2, "day": 1, "data": "a"}, {"id": 2, "day": 2, "data": "b"}),
        log({"id": 1, "day": 3, "op": "u", "data": "late"}, {"id": 2, "day": 6, "op": "d"}),
        log({"id": 2, "day": 4, "op": "u", "data": "late too"}, {"id": 3, "day": 1, "data": "c"}),
    ]
    target = run(spark, batches, tmp_path)
    everything = batches[0].union(batches[1]).union(batches[2])
    schema = batches[0].schema
    current = changes.current_rows(spark, target, schema)
    assert state(current) == state(latest(everything, ["id"]))
    assert [r[0] for r in state(current)] == [1, 3]
    wanted = state(current)
    changes.compact(spark, target, schema)
    kept = changes.read_change_table(spark, target, schema)
    assert state(changes.current_rows(spark, target, schema)) == wanted
    assert [r[:2] for r in state(kept)] == [(1, "r"), (2, "d"), (3, "r")]


def test_compactions_between_batches(spark, log, tmp_path):
    """A reader that planned before a compaction still finds its files; later ones read the fold and what came after."""
    days = [[{"id": i, "day": d, "data": f"{d}-{i}", "op": "d" if (i + d) % 5 == 0 else "u"} for i in range(d, d + 4)] for d in range(1, 6)]
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    everything, early = None, None
    for n, day in enumerate(days):
        batch = log(*day)
        everything = batch if everything is None else everything.union(batch)
        batch.coalesce(1).write.mode("append").parquet(source)
        changes.apply_cdc_stream(changes.read_changes(spark, source, batch.schema), target, progress).awaitTermination()
        if n in (1, 3):
            early = changes.current_rows(spark, target, batch.schema), state(latest(everything, ["id"]))
            changes.compact(spark, target, batch.schema)
            changes.compact(spark, target, batch.schema)  # nothing new: leaves it as it is
            assert state(early[0]) == early[1]
    assert state(changes.current_rows(spark, target, batch.schema)) == state(latest(everything, ["id"]))
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert "upto_batch=3" in folders and "batch=0" not in folders and "batch=4" in folders


def test_nothing_streamed_yet(spark, log, tmp_path):
    schema = log({"id": 1}).schema
    changes.compact(spark, str(tmp_path / "none"), schema)
    assert changes.current_rows(spark, str(tmp_path / "none"), schema).collect() == []


def test_a_repeated_batch_changes_nothing(spark, log, tmp_path):
    batch = log({"id": 1, "day": 1, "data": "a"})
    target = run(spark, [batch], tmp_path)
    before = state(changes.current_rows(spark, target, batch.schema))
    again = changes.read_changes(spark, str(tmp_path / "in"), batch.schema)
    changes.apply_cdc_stream(again, target, str(tmp_path / "second")).awaitTermination()
    assert state(changes.current_rows(spark, target, batch.schema)) == before


def test_replays_are_dropped_within_the_delay(spark, log, tmp_path):
    source = str(tmp_path / "in")
    df = log({"id": 1, "day": 1, "data": "a"}, {"id": 1, "day": 1, "data": "a"}, {"id": 1, "day": 2, "data": "b"})
    df.write.parquet(source)
    stream = changes.drop_replays_within(changes.read_changes(spark, source, df.schema), "10 days")
    query = stream.writeStream.format("memory").queryName("replays").trigger(availableNow=True).option(
        "checkpointLocation", str(tmp_path / "progress")
    ).start()
    query.awaitTermination()
    assert spark.table("replays").count() == 2


def deliver(spark, path, *rows):
    df = spark.createDataFrame([(i, f"2024-{day} 00:00:00", v) for i, day, v in rows], "id long, t string, v string")
    df.selectExpr("id", "CAST(t AS TIMESTAMP_NTZ) AS updated_ts", "'u' AS op", "v").coalesce(1).write.mode("append").parquet(path)


def test_replays_inside_and_beyond_the_watermark(spark, tmp_path):
    """Known again inside the delay and after a restart, late beyond it; a first delivery that is too late is late as well."""
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema, late = "id bigint, updated_ts timestamp_ntz, op string, v string", 0

    def run():
        query = changes.append_once(changes.read_changes(spark, source, schema, files_per_batch=1), target, progress, "10 days")
        query.awaitTermination()
        return changes.late_rows(query)

    deliver(spark, source, (1, "01-01", "a"), (1, "01-01", "a"), (2, "01-02", "b"))
    deliver(spark, source, (1, "01-01", "a"), (3, "01-09", "c"))  # again, inside the delay
    late += run()
    deliver(spark, source, (2, "01-02", "b"), (2, "01-20", "b2"))  # again, after a restart
    late += run()
    assert late == 0
    deliver(spark, source, (1, "01-01", "a"), (4, "01-03", "d"), (5, "01-25", "e"))  # both before the watermark
    late += run()
    assert late == 2
    got = sorted((r["id"], r["v"]) for r in spark.read.parquet(target).collect())
    assert got == [(1, "a"), (2, "b"), (2, "b2"), (3, "c"), (5, "e")]
