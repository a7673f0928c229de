"""Results have the declared columns and types; the derived logs have the declared bronze columns."""

import os

import pytest

from cdcstrata import schemas
from cdcstrata.checks.bronze import Tables
from cdcstrata.checks.registered import builds

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERY = {
    "silver_reports": "silver_reports_masked_first",
    "report_mart": "gold_report_mart",
    **{m: f"gold_{m}" for m in ("general_indicators", "financing", "tax_benefits", "employees", "exports", "export_by_country")},
}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def kinds(struct):
    """Column types; the test tables carry timestamps without a zone."""
    return {f.name: f.dataType.simpleString().replace("timestamp_ntz", "timestamp") for f in struct.fields}


@pytest.mark.parametrize("name", schemas.TABLES)
def test_tables(tables, name):
    got = builds()[QUERY.get(name, name)](tables)
    assert kinds(got.schema) == kinds(schemas.struct(schemas.TABLES[name]))


@pytest.mark.parametrize(
    "ddl, log",
    [
        (schemas.REPORT_CDC, lambda t: t.report_cdc()),
        (schemas.REQUEST_CDC, lambda t: t.request_cdc),
        (schemas.COMPANY_CDC, lambda t: t.company_cdc),
        (schemas.SERVICE_REPORT, lambda t: t.service_report()),
        (schemas.SERVICE_REQUEST, lambda t: t.service_request),
        (schemas.COMPANY, lambda t: t.company),
        (schemas.HUB_FORM, lambda t: t.hub_form),
        (schemas.VISIT_RESPONSES, lambda t: t.visit_responses),
        (schemas.CRM_LEADS, lambda t: t.crm_leads),
        (schemas.CRM_CONTACTS, lambda t: t.crm_contacts),
        (schemas.CRM_COMPANIES, lambda t: t.crm_companies),
        (schemas.CRM_TASKS, lambda t: t.crm_tasks),
        (schemas.CRM_PIPELINES, lambda t: t.crm_pipelines),
        (schemas.CRM_USERS, lambda t: t.crm_users),
    ],
)
def test_logs(tables, ddl, log):
    assert kinds(log(tables).schema) == kinds(schemas.struct(ddl))


def test_definitions_make_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS defs")
    for name in schemas.TABLES:
        spec = schemas.table_spec(name, "defs", note="v1")
        spark.sql(spec.ddl())
        assert spark.table(spec.name).columns[-1] in (*spec.partition_by, "etl_loaded_at")
    spark.sql("DROP DATABASE defs CASCADE")
