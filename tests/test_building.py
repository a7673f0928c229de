"""Building a query runs no job and writes nothing, but for those that are about writing or that select in rounds."""

import os

import pytest

from cdcstrata.checks import expected, oracle, registered
from cdcstrata.checks.bronze import tables
from cdcstrata.plans import gold
from cdcstrata.sources.scratch import scratch_root

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
WRITES = ("dq_numeric_profile", "silver_reports_variant", "bi_countries_merged", "gold_general_indicators_bucketed", "inc_upsert", "inc_refresh", "inc_summary", "stream_", "refresh_", "sink_", "crm_incremental", "crm_events", "visits_load")


def _reads_a_footer(tracker, job):
    """Opening a folder of the given tables looks up its columns in one file's footer."""
    return all("parquet at" in tracker.getStageInfo(s).name for s in tracker.getJobInfo(job).stageIds)


def test_building_runs_no_job(spark):
    t = tables(spark, FOLDER)
    t.report_cdc(), t.report_cdc(exports=True), t.request_cdc  # the shared logs are stored on first use
    tracker, root = spark.sparkContext.statusTracker(), scratch_root(spark).removeprefix("file:")
    spark.sparkContext.setJobGroup("building", "building")
    before = sorted(os.listdir(root))
    for name, query in registered.queries().items():
        if not name.startswith(WRITES):
            query(spark, FOLDER)
            assert not [j for j in tracker.getJobIdsForGroup("building") if not _reads_a_footer(tracker, j)], name
    assert sorted(os.listdir(root)) == before


def test_the_checks_state_the_columns_themselves(monkeypatch):
    """A swap in the code under test leaves the SQL as it is, so the row turns red."""
    assert "plans" not in open(oracle.__file__).read() and "plans" not in open(expected.__file__).read()
    before = oracle.oracle_sql()["gold_financing"]
    swapped = dict(zip(gold.FINANCING, reversed(gold.FINANCING.values()), strict=True))
    monkeypatch.setattr(gold, "FINANCING", swapped)
    assert oracle.oracle_sql()["gold_financing"] == before
