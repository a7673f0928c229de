"""Second-tier tables on hand-written rows."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdcstrata.plans import crm, visits


def response(spark, *days):
    rows = [(date(2024, 1, d), json.dumps(body)) for d, body in days]
    return spark.createDataFrame(rows, "visit_date date, raw_json string")


def test_attendance(spark):
    person = "000000000042"
    df = response(
        spark,
        (1, {person: [{"event": "exit", "time": "19:45:00"}, {"event": "entry", "time": "07:30:00"}, {"event": "entry", "time": "07:30:00"}], "12": [{"event": "entry", "time": "09:00:00"}]}),
        (2, {person: [{"event": "entry", "time": "10:00:00"}, {"event": "odd", "time": "11:00:00"}, {"event": "exit", "time": "25:00:00"}]}),
        (3, {person: []}),
    )
    bronze = visits.visits_bronze(df)
    assert bronze.count() == 7
    clean = visits.visits_silver(bronze)
    assert clean.count() == 3
    first, second = visits.daily_attendance(clean).orderBy("visit_date").collect()
    assert (first.total_entries, first.total_exits, first.hours_on_site) == (1, 1, Decimal("12.25"))
    assert (second.last_exit, second.hours_on_site) == (None, None)
    month = visits.monthly_attendance(visits.daily_attendance(clean)).collect()
    assert [(m.total_days_visited, m.avg_hours_per_day, m.total_hours) for m in month] == [(2, Decimal("12.25"), Decimal("12.25"))]
    assert visits.visits_of_days(df, "2024-01-02").count() == 1
    assert visits.visits_of_days(df, "2024-01-01", "2024-01-02").count() == 2
    people = spark.createDataFrame([(person, "777")], "iin string, bin string")
    assert {r.bin for r in visits.link_to_company(visits.daily_attendance(clean), people).collect()} == {"777"}


FIELDS = json.dumps([{"field_id": 1, "field_name": "БИН", "values": [{"value": "777"}]}, {"field_id": 2, "field_name": "Источник", "values": []}], ensure_ascii=False)
LEAD = (
    "id int, name string, price bigint, responsible_user_id int, status_id int, pipeline_id int, loss_reason_id int, created_at bigint, "
    "updated_at bigint, closed_at bigint, is_deleted boolean, custom_fields_values string, tags_json string, contacts_json string, companies_json string"
)
JAN, FEB = 1706745600 - 86400 * 20, 1706745600 + 86400


@pytest.fixture()
def sales(spark):
    def lead(id_, status, price, updated, closed=None, deleted=False, companies="[{\"id\":7}]"):
        return (id_, "L", price, 100, status, 33, None, JAN, updated, closed, deleted, FIELDS, '[{"id":1,"name":"VIP"}]', None, companies)

    leads = spark.createDataFrame(
        [
            lead(1, 10, 100, JAN),
            lead(1, 142, 100, FEB, FEB),
            lead(2, 143, 50, FEB, FEB),
            lead(3, 142, 70, JAN, JAN + 86400, deleted=True),
            lead(4, 99, 30, JAN, companies=None),
        ],
        LEAD,
    )
    statuses = json.dumps(
        [{"id": 10, "name": "New", "sort": 1}, {"id": 142, "name": crm.WON, "sort": 2}, {"id": 143, "name": crm.LOST, "sort": 3}],
        ensure_ascii=False,
    )
    pipelines = spark.createDataFrame([(33, "P", True, statuses)], "id int, name string, is_main boolean, statuses_json string")
    users = spark.createDataFrame([(100, "Manager")], "id int, name string")
    return leads, crm.crm_pipeline_statuses(pipelines), users


def test_leads(sales):
    got = {r.lead_id: r for r in crm.crm_leads_silver(*sales).collect()}
    assert len(got) == 4
    assert (got[1].is_won, got[1].status_name, got[1].cf_bin, got[1].cf_source) == (True, crm.WON, "777", None)
    assert (got[1].company_ids, got[1].tags, got[1].contact_ids) == ([7], ["VIP"], None)
    assert (got[4].status_name, got[4].is_won, got[4].is_lost) == (None, False, False)
    assert str(got[1].closed_at) == "2024-02-02 00:00:00"


def test_sales_marts(spark, sales):
    leads = crm.crm_leads_silver(*sales)
    funnel = {r.status_name: r for r in crm.sales_funnel(leads).collect()}
    assert (funnel[crm.WON].leads_count, funnel[crm.WON].avg_price, funnel[crm.WON].conversion_rate) == (1, 100, Decimal("100.00"))
    tasks = spark.createDataFrame([(1, 100, True, FEB), (2, 100, False, FEB), (3, 100, True, JAN)], "id int, responsible_user_id int, is_completed boolean, updated_at bigint")
    activity = {r.month: r for r in crm.manager_activity(leads, tasks, sales[2]).collect()}
    assert (activity[1].leads_created, activity[1].leads_closed_won, activity[1].tasks_completed) == (3, 0, 1)
    assert (activity[2].leads_closed_won, activity[2].leads_closed_lost, activity[2].total_revenue, activity[2].avg_deal_cycle_days) == (1, 1, 100, 21)
    assert activity[1].avg_deal_cycle_days is None
    companies = spark.createDataFrame([(7, "Co", "777")], "company_id int, company_name string, bin string")
    client = crm.client_analytics(leads, companies).collect()
    assert [(c.company_id, c.total_leads, c.won_leads, c.total_revenue, c.avg_deal_price, c.tags) for c in client] == [(7, 2, 1, 100, 75, "VIP")]


def test_masking(spark):
    df = spark.createDataFrame([("+77001234567", "ivanov@mail.kz"), ("123", None)], "p string, e string")
    got = df.select(crm.mask_tail(F.col("p"), 4), crm.mask_email(F.col("e"))).collect()
    assert [tuple(r) for r in got] == [("********4567", "i***@mail.kz"), ("***", None)]


def test_incremental_slice(sales):
    assert crm.entity_changes_since(sales[0], FEB).count() == 2


def test_entities_load_in_order_and_merge(sales):
    leads, saved = sales[0], []

    def save(df, name):
        saved.append(name)
        return df

    first = crm.load_entities({"leads": leads.filter(F.col("updated_at") == JAN), "users": leads.select("id", "name")}, save)
    assert saved == ["users", "leads"]
    second = crm.load_entities({"leads": leads}, save, first, since_epoch=FEB)
    got = {r.id: r.status_id for r in second["leads"].collect()}
    assert got == {1: 142, 2: 143, 3: 142, 4: 99}


def test_a_day_is_loaded_again(spark):
    from datetime import date

    from cdcstrata.plans import visits

    def responses(*events):
        rows = [(date(2024, 1, day), f'{{"{iin:012d}": [{{"event": "{event}", "time": "{time}"}}]}}') for day, iin, event, time in events]
        return spark.createDataFrame(rows, "visit_date date, raw_json string")

    def held():
        return sorted((r["visit_date"].day, int(r["iin"]), r["event"]) for r in spark.table("visits_again").collect())

    spark.sql("DROP TABLE IF EXISTS visits_again")
    try:
        first = responses((1, 5, "entry", "09:00:00"), (2, 5, "entry", "09:00:00"), (3, 6, "exit", "18:00:00"))
        visits.load_days(spark, first, "visits_again", "2024-01-01", "2024-01-03")
        assert held() == [(1, 5, "entry"), (2, 5, "entry"), (3, 6, "exit")]
        mended = responses((2, 5, "entry", "09:00:00"), (2, 5, "exit", "10:00:00"), (3, 9, "entry", "09:00:00"))
        for _ in range(2):
            visits.load_days(spark, mended, "visits_again", "2024-01-02")
            assert held() == [(1, 5, "entry"), (2, 5, "entry"), (2, 5, "exit"), (3, 6, "exit")]
        visits.load_days(spark, responses((9, 1, "entry", "09:00:00")), "visits_again", "2024-01-03")  # a day without events
        assert [d for d, _, _ in held()] == [1, 2, 2]
    finally:
        spark.sql("DROP TABLE IF EXISTS visits_again")
