"""Bucketed tables, counts observed by writing jobs, and guarded lookups."""

import pytest
from pyspark.sql import types as T

from cdcstrata.operators import quality
from cdcstrata.plans import gold, refresh
from cdcstrata.sources import tables, writers
from cdcstrata.sources.scratch import materialise

REPORTS = (
    "service_request_id bigint, year int, report_type string, status string, op string, certificate_number string, "
    "company_tin string, company_name string, investor_country_company string, "
    + ", ".join(f"{c} string" if c == "activity_fields" else f"{c} bigint" for c in gold.INDICATORS.values())
)
LOOKUP = (
    "service_request_id bigint, p_number string, p_issue date, p_end date, p_tin string, p_name string, "
    "cert_number string, cert_issue_date date, cert_end_date date"
)


@pytest.fixture()
def names(spark):
    both = ["layout_reports", "layout_lookup"]
    for n in both:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    yield both
    for n in both:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_bucketed_tables_join_without_an_exchange(spark, names):
    wide = [f.name for f in T._parse_datatype_string(REPORTS).fields][1:]
    reports = spark.range(500).selectExpr(
        "id % 50 AS service_request_id",
        *[f"CAST('1' AS {f.dataType.simpleString()}) AS {f.name}" for f in T._parse_datatype_string(REPORTS).fields if f.name in wide],
    )
    lookup = spark.range(40).selectExpr(
        "id AS service_request_id",
        *[f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in T._parse_datatype_string(LOOKUP).fields[1:]],
    )
    for name, df in zip(names, (reports, lookup), strict=True):
        writers.write_bucketed(df, name, ["service_request_id"], 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, side = (spark.table(n) for n in names)
        mart = gold.general_indicators(gold.with_certificates(facts, side), signed_only=False)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 6 out of 6" in plan
        plain = gold.general_indicators(gold.with_certificates(materialise(reports, "plain"), side), signed_only=False)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, mart.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_definition(spark, names):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    spec = tables.TableSpec(names[0], schema, bucket_by=("k",), buckets=4)
    tables.create_table(spark, spec)
    writers.full_refresh(spark.range(20).selectExpr("id AS k", "string(id) AS v"), spec)
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {names[0]}").collect()}
    assert rows["Num Buckets"] == "4" and rows["Bucket Columns"] == "[`k`]"
    assert spark.table(names[0]).count() == 20


def test_rows_are_counted_by_the_job_that_writes(spark):
    rows = quality.WrittenRows()
    save = refresh.counted(refresh.to_scratch, rows)
    group = "observed"
    spark.sparkContext.setJobGroup(group, group)
    kept = save(spark.range(1000).selectExpr("id", "CAST(2020 + id % 3 AS INT) AS year").filter("id % 2 = 0"), "half")
    save(kept.filter("id < 0"), "none")
    tracker = spark.sparkContext.statusTracker()
    jobs = len(tracker.getJobIdsForGroup(group))
    counts = rows.counts(spark)
    assert {r["table_name"]: r["cnt"] for r in counts.collect()} == {"half": 500, "none": 0}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 4  # the writes themselves


def test_counts_of_catalog_tables(spark):
    rows = quality.WrittenRows()
    spark.sql("CREATE DATABASE IF NOT EXISTS layout_db")
    try:
        save = refresh.to_catalog("layout_db", counts=rows)
        save(spark.range(90).selectExpr("id", "CAST(2020 + id % 3 AS INT) AS year"), "t")
        assert [tuple(r) for r in rows.counts(spark).collect()] == [("t", 90)]
    finally:
        spark.sql("DROP DATABASE layout_db CASCADE")


def test_lookups_are_guarded(spark):
    schema = (
        "service_request_id bigint, certificate_number string, certificate_issue_date date, certificate_end_date date, "
        "company_tin string, company_name string"
    )
    once = spark.createDataFrame([(1, "a", None, None, "t", "n"), (2, "b", None, None, "t", "n")], schema)
    twice = once.unionByName(once.filter("service_request_id = 2"))
    reports = spark.createDataFrame([(1, None), (2, "own")], "service_request_id bigint, certificate_number string")
    good = gold.certificate_for(reports, once, check_unique=True)
    assert sorted(r["resolved_certificate"] for r in good.collect()) == ["a", "own"]
    with pytest.raises(Exception, match="not unique"):
        gold.certificate_for(reports, twice, check_unique=True).collect()
    assert gold.certificate_for(reports, twice).count() == 3  # what the guard is there for
