"""Readers, writers and refresh modes on catalog tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcstrata.plans import refresh, silver, summary
from cdcstrata.sources import readers, scratch, tables, writers


@pytest.fixture()
def name(spark, request):
    table = "t_" + request.node.name.split("[")[0].lower()
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    yield table
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def rows(spark, name, *columns):
    return sorted(tuple(r) for r in spark.table(name).select(*columns).collect())


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, year int")


def test_replace_append_overwrite(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2023)), name, partition_by=["year"])
    writers.append(frame(spark, (2, "b", 2024)), name, partition_by=["year"])
    assert rows(spark, name, "k", "year") == [(1, 2023), (2, 2024)]
    writers.overwrite(frame(spark, (3, "c", 2024)), name, partition_by=["year"])
    assert rows(spark, name, "k", "year") == [(3, 2024)]
    assert {r.name: r.partition for r in readers.describe(spark, name).collect()} == {"k": False, "v": False, "year": True}
    assert name in {r.name for r in readers.list_tables(spark).collect()}
    assert readers.read_table(spark, name).count() == 1


def test_partition_overwrite_leaves_the_others(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2023), (2, "b", 2024)), name, partition_by=["year"])
    fresh = spark.createDataFrame([(2024, "z", 9)], "year int, v string, k int")
    for _ in range(2):
        writers.overwrite_partitions(fresh, name)
    assert rows(spark, name, "k", "v", "year") == [(1, "a", 2023), (9, "z", 2024)]


def test_partition_filter_reaches_the_scan(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2023), (2, "b", 2024)), name, partition_by=["year"])
    plan = spark.table(name).filter("year = 2024").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<k:int>" in plan


def test_upsert_rewrites_touched_partitions(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2023), (1, "a", 2024), (2, "b", 2024)), name, partition_by=["year"])
    writers.upsert(spark, name, frame(spark, (2, "new", 2024), (3, "c", 2025)), ["k", "year"], ["year"])
    assert rows(spark, name, "k", "v", "year") == [(1, "a", 2023), (1, "a", 2024), (2, "new", 2024), (3, "c", 2025)]
    with pytest.raises(ValueError):
        writers.upsert(spark, name, frame(spark), ["k"], ["year"])


def test_upsert_keeps_the_newer_row(spark, name):
    schema = "id int, ts int, v string"
    writers.create_or_replace(spark.createDataFrame([(1, 5, "newer"), (2, 1, "x")], schema), name)
    writers.upsert(spark, name, spark.createDataFrame([(1, 4, "late"), (2, 1, "tie"), (3, 1, "new")], schema), ["id"], newer_by=["ts"])
    assert rows(spark, name, "id", "v") == [(1, "newer"), (2, "tie"), (3, "new")]


def test_delete_and_truncate(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2023), (2, None, 2024), (3, "c", 2024)), name, partition_by=["year"])
    writers.delete_where(spark, name, "v = 'c' OR year = 2023")
    assert rows(spark, name, "k") == [(2,)]
    writers.truncate(spark, name)
    assert rows(spark, name, "k") == []


def test_ddl_and_full_refresh(spark, name):
    schema = T.StructType(
        [
            T.StructField("year", T.IntegerType(), metadata={"comment": "report's year"}),
            T.StructField("cnt", T.LongType()),
        ]
    )
    spec = tables.TableSpec(name, schema, ("year",), "a comment", props={"note": "x"})
    tables.create_table(spark, spec)
    tables.create_table(spark, spec)
    data = spark.createDataFrame([(1, 2023), (2, 2024)], "cnt bigint, year int")
    writers.full_refresh(data, spec)
    writers.full_refresh(data.filter("year = 2024"), spec)
    assert rows(spark, name, "year", "cnt") == [(2024, 2)]
    comments = {r[0]: r[2] for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert comments["year"] == "report's year"
    assert tables.spec_of("x", schema).schema.names[-1] == "etl_loaded_at"


def build(log):
    return silver.silver_reports_natural_key(log)


def state(spark, name):
    return rows(spark, name, "report_id", "service_request_id", "year", "op", "income_total")


def test_years_backfill(spark, name, log):
    df = log(*[{"id": y, "year": y, "data": f'{{"income_total":{y}}}'} for y in (2022, 2023, 2024)])
    refresh.refresh(spark, build, df, name)
    later = df.withColumn("data", F.lit('{"income_total":1}'))
    refresh.refresh(spark, build, later, name, "years", years=[2023, 2024])
    assert [(r[2], r[4]) for r in state(spark, name)] == [(2022, 2022), (2023, 1), (2024, 1)]


def test_incremental_equals_full(spark, name, log):
    old = [
        {"id": 1, "request": 1, "day": 1, "data": '{"income_total":1}'},
        {"id": 2, "request": 2, "day": 5, "data": '{"income_total":2}'},
        {"id": 3, "request": 3, "day": 1, "year": 2023, "data": '{"income_total":3}'},
    ]
    new = [
        {"id": 1, "request": 1, "day": 10, "op": "u", "data": '{"income_total":11}'},
        {"id": 2, "request": 2, "day": 4, "op": "u", "data": '{"income_total":22}'},
        {"id": 3, "request": 3, "day": 11, "year": 2023, "op": "d"},
        {"id": 4, "request": 4, "day": 12, "data": '{"income_total":4}'},
    ]
    refresh.refresh(spark, build, log(*old), name)
    refresh.refresh(spark, build, log(*old, *new), name, "incremental", since="2024-01-04")
    incremental = state(spark, name)
    refresh.refresh(spark, build, log(*old, *new), name)
    assert incremental == state(spark, name)
    assert [r[0] for r in incremental] == [1, 2, 4]
    with pytest.raises(ValueError):
        refresh.refresh(spark, build, log(*old), name, "incremental")
    with pytest.raises(ValueError):
        refresh.refresh(spark, build, log(*old), name, "sometimes")


def test_backfill_empties_a_year_without_rows(spark, name, log):
    years = (2022, 2023, 2024)
    df = log(*[{"id": y, "year": y, "request": y, "data": '{"income_total":1}'} for y in years])
    refresh.refresh(spark, build, df, name)
    gone = df.unionByName(log({"id": 2023, "year": 2023, "request": 2023, "day": 9, "op": "d"}))
    refresh.refresh(spark, build, gone, name, "years", years=[2023, 2024])
    assert [r[2] for r in state(spark, name)] == [2022, 2024]
    refresh.refresh(spark, build, gone.filter("year = 2022"), name, "years")
    assert [r[2] for r in state(spark, name)] == [2022]


OLD = [
    {"id": 1, "request": 1, "type": "quarter1", "day": 1, "data": '{"income_total":1}'},
    {"id": 2, "request": None, "type": "quarter1", "day": 1, "data": '{"income_total":2}'},
    {"id": 3, "request": 3, "year": 2022, "day": 1, "data": '{"income_total":3}'},
    {"id": 4, "request": 4, "year": 2021, "day": 1, "data": '{"income_total":4}'},
    {"id": 5, "request": 5, "year": None, "day": 1, "data": '{"income_total":5}'},
    {"id": 6, "request": 6, "year": None, "day": 1, "data": '{"income_total":6}'},
    {"id": 7, "request": 7, "year": 2023, "day": 1, "data": '{"income_total":7}'},
]
NEW = [
    {"id": 1, "request": 1, "type": "quarter2", "day": 9, "op": "u"},  # another key
    {"id": 2, "request": None, "type": "quarter1", "day": 9, "data": '{"income_total":22}'},
    {"id": 3, "request": 3, "year": 2024, "day": 9, "data": '{"income_total":33}'},  # another year, its old one is empty
    {"id": 4, "request": 4, "year": 2021, "day": 9, "op": "d"},  # the last row of its year
    {"id": 5, "request": 5, "year": 2023, "day": 9, "data": '{"income_total":55}'},
    {"id": 8, "request": 1, "type": "quarter1", "day": 9, "data": '{"income_total":8}'},
]


@pytest.mark.parametrize(
    ("make", "keys"),
    [
        (lambda d: silver.silver_reports(d, start_year=None, tombstones="after"), {"id": "report_id"}),
        (lambda d: silver.silver_reports(d, "data_first", start_year=None, tombstones="after"), silver.NATURAL_KEY),
    ],
)
def test_incremental_equals_full_where_keys_move(spark, name, log, make, keys):
    refresh.refresh(spark, make, log(*OLD), name)
    refresh.refresh(spark, make, log(*OLD, *NEW), name, "incremental", since="2024-01-05", keys=keys)
    columns = ("report_id", "service_request_id", "year", "report_type", "op", "income_total")
    got = sorted(map(str, spark.table(name).select(*columns).collect()))
    assert got == sorted(map(str, make(log(*OLD, *NEW)).select(*columns).collect()))
    partitions = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    years = {r.year for r in make(log(*OLD, *NEW)).select("year").distinct().collect()}
    assert sorted(partitions) == sorted("year=" + ("__HIVE_DEFAULT_PARTITION__" if y is None else str(y)) for y in years)
    assert 2021 not in years


def test_full_refresh_keeps_the_old_table_on_failure(spark, name):
    spec = tables.TableSpec(name, T.StructType.fromDDL("k int, v string, year int"), ("year",))
    writers.full_refresh(frame(spark, (1, "a", 2023)), spec)
    bad = frame(spark, (2, "b", 2024)).withColumn("k", F.expr("raise_error('broken')").cast("int"))
    with pytest.raises(Exception, match="broken"):
        writers.full_refresh(bad, spec)
    assert rows(spark, name, "k", "year") == [(1, 2023)]
    # A frame that reads the very table.
    writers.full_refresh(spark.table(name).select((F.col("k") + 1).alias("k"), "v", "year"), spec)
    assert rows(spark, name, "k", "year") == [(2, 2023)]


def test_delete_rewrites_only_partitions_with_a_match(spark, name):
    writers.create_or_replace(frame(spark, (1, "a", 2022), (2, "b", 2023), (3, "c", 2023), (4, "d", 2024)), name, partition_by=["year"])
    before = {f for f in spark.table(name).filter("year = 2022").inputFiles()}
    writers.delete_where(spark, name, "k IN (2, 4)")
    assert rows(spark, name, "k") == [(1,), (3,)]
    assert {f for f in spark.table(name).filter("year = 2022").inputFiles()} == before
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == ["year=2022", "year=2023"]


def test_merged_summaries_equal_full(spark, log):
    quarters = [{"id": i, "request": i % 3, "type": f"quarter{1 + i // 3}", "data": f'{{"income_total":{i}}}'} for i in range(12)]
    full = summary.annual_summary(silver.silver_reports_basic(log(*quarters)))
    part = summary.annual_summary(silver.silver_reports_basic(log(*quarters[:6])))
    merged = writers.merged(part, full, ["service_request_id", "year"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, full.select(*merged.columns).collect()))


def test_csv(spark, tmp_path):
    df = frame(spark, (2, "b", 2024), (1, "ё", 2023))
    writers.export_csv(df, str(tmp_path / "out"), ["year"], files=1)
    files = list((tmp_path / "out").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text(encoding="utf-8").split() == ["k,v,year", "1,ё,2023", "2,b,2024"]
    assert writers.preview(df, 1).count() == 1
    assert "etl_loaded_at" in writers.with_load_time(df).columns


def test_jdbc_options():
    split = readers.JdbcPartitioning("id", 0, 100, 8)
    plain = readers.jdbc_options("jdbc:x", "SELECT 1", "d")
    parts = readers.jdbc_options("jdbc:x", "SELECT 1", "d", split)
    assert plain["query"] == "SELECT 1" and "dbtable" not in plain
    assert parts["dbtable"] == "(SELECT 1) q" and "query" not in parts
    assert (parts["numPartitions"], parts["lowerBound"], parts["upperBound"]) == ("8", "0", "100")


def test_bound_sql_rows(spark):
    readers.from_rows(spark, [(1, "x'y"), (2, "z")], "k int, v string").createOrReplaceTempView("bound_rows")
    assert readers.sql(spark, "SELECT k FROM bound_rows WHERE v = :v", v="x'y").collect()[0].k == 1


def test_scratch_is_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.scratch_path(spark, "x").startswith(root)
    kept = scratch.materialise(spark.range(5).withColumn("year", F.lit(2024)), "kept", ["year"])
    assert kept.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(root.lstrip("/"))
    assert kept.count() == 5


def test_refresh_writes_every_table_once(spark, log):
    saved = []

    def save(df, name):
        saved.append(name)
        return refresh.to_scratch(df, name)

    reqs = spark.createDataFrame([], "id bigint, service_id string, company_id bigint, bp_status string, data string, search_field string, updated_at timestamp, op string")
    df = log({"id": 1, "data": '{"company_tin":"1","income_international_current_quarter":[{"country":"A","current_sum":1}]}'})
    out = refresh.refresh_tables(refresh.Bronze(df, reqs), save)
    assert len(saved) == len(set(saved)) == 9
    assert {n: t.count() for n, t in out.items() if n != "silver_participants"} == dict.fromkeys(set(out) - {"silver_participants"}, 1)


def test_refresh_into_a_database(spark, log):
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    reqs = spark.createDataFrame([], "id bigint, service_id string, company_id bigint, bp_status string, data string, search_field string, updated_at timestamp, op string")
    df = log({"id": 1, "data": '{"company_tin":"1"}'})
    refresh.refresh_tables(refresh.Bronze(df, reqs), refresh.to_catalog("marts"), cert_fallback=3)
    got = spark.table("marts.general_indicators").first()
    assert got.bin == "1" and got.etl_loaded_at is not None
    spark.sql("DROP DATABASE marts CASCADE")


def test_upsert_where_the_key_lies(spark, name):
    """A key without the partition column: the old row goes wherever it was, other partitions are not touched."""
    rows_ = [(1, "a", 2021), (2, "b", 2022), (3, "c", 2023), (4, "d", 2024), (5, "e", None)]
    writers.create_or_replace(frame(spark, *rows_), name, partition_by=["year"])
    before = {f.rsplit("/", 1)[0]: f for f in spark.table(name).inputFiles()}
    writers.upsert(spark, name, frame(spark, (1, "moved", 2022), (3, "changed", 2023), (6, "new", 2025), (5, "named", 2025)), ["k"])
    assert rows(spark, name, "k", "v", "year") == [
        (1, "moved", 2022), (2, "b", 2022), (3, "changed", 2023), (4, "d", 2024), (5, "named", 2025), (6, "new", 2025)]
    after = {f.rsplit("/", 1)[0]: f for f in spark.table(name).inputFiles()}
    kept = [p for p in before if p.endswith("year=2024")]
    assert kept and all(after[p] == before[p] for p in kept)
    assert not [p for p in after if p.endswith("year=2021")]


def test_export_is_read_in_order(spark, tmp_path):
    df = spark.range(5000).selectExpr("id * 7 % 5000 AS k", "IF(id % 3 = 0, NULL, concat('v,', id)) AS v").repartition(6)
    for files in (None, 1):
        path = str(tmp_path / f"csv{files}")
        writers.export_csv(df, path, [F.desc("k")], files)
        lines = readers.read_csv_in_order(spark, path, df.schema).collect()
        assert [r["k"] for r in sorted(lines, key=lambda r: r["line"])] == list(range(4999, -1, -1))
        assert sorted(r["line"] for r in lines) == list(range(1, 5001))
