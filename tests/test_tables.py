"""Silver tables, marts, summaries, registries and dashboards on hand-written rows."""

import json
import re

import pytest
from pyspark.sql import functions as F

from cdcstrata.operators import aggregates, quality
from cdcstrata.plans import bi, gold, registry, silver, summary

ENTRY = {"country": "A", "current_sum": 5}


def doc(**fields):
    return json.dumps(fields, ensure_ascii=False)


def signature(tin=None, name="S", plain=None):
    inner = (f"<tin>{tin}</tin>" if tin else "") + f"<name>{name}</name>"
    return doc(signed_xml=f"<d><company>{inner}</company><signer><tin>999</tin></signer></d>", tin=plain, full_name="F")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


REQUESTS = "id bigint, service_id string, company_id bigint, bp_status string, data string, search_field string, updated_at timestamp, op string"


@pytest.fixture()
def requests(spark):
    def build(*rows):
        from datetime import datetime

        full = [
            (
                r["id"],
                r.get("service", "techpark"),
                r["id"],
                r.get("status", "registered"),
                doc(activation_info={"certificate_number": r.get("cert"), "issue_date": r.get("issue")}),
                "n***i***m***777***c",
                datetime(2024, 1, r.get("day", 1)),
                r.get("op", "r"),
            )
            for r in rows
        ]
        return spark.createDataFrame(full, REQUESTS)

    return build


def test_identity_orders(log):
    df = log(
        {"id": 1, "data": doc(company_tin="1", company_name=""), "signature": signature("2", "old")},
        {"id": 1, "day": 2, "op": "u", "signature": signature("3", "masked", "4")},
    )
    stitched = one(silver.silver_reports(df))
    assert (stitched.company_tin, stitched.company_name, stitched.op) == ("3", "masked", "u")
    assert one(silver.silver_reports(df, attributes="snapshot")).op == "r"
    first = one(silver.silver_reports(df, "data_first"))
    assert (first.company_tin, first.company_name) == ("3", "masked")
    fields = one(silver.silver_reports(df, "signature_fields"))
    assert (fields.company_tin, fields.company_name) == ("4", "F")
    kept = one(silver.silver_reports(df, "data_first", require_payload=True))
    assert (kept.company_tin, kept.company_name) == ("1", "old")
    with pytest.raises(ValueError):
        silver.silver_reports(df, "guess")


def test_unmatched_signature_does_not_block_the_payload(log):
    df = log(
        {"id": 1, "data": doc(company_tin="1")},
        {"id": 1, "day": 2, "op": "u", "signature": signature(None, "m")},
    )
    assert one(silver.silver_reports(df)).company_tin == "1"
    assert one(silver.silver_reports(df, xml_mode="last")).company_tin == "999"


def test_column_counts(log):
    df = log({"id": 1, "data": doc(income_total="12.7")})
    assert len(silver.silver_reports_basic(df).columns) == 33
    assert len(silver.silver_reports_natural_key(df).columns) == 42
    assert len(silver.silver_reports(df).columns) == 41
    assert len(silver.silver_reports_by_id(df).columns) == 27
    assert len(gold.report_mart(df).columns) == 43
    assert one(silver.silver_reports(df)).income_total == 12


def test_bad_payloads_do_not_fail(log):
    texts = [None, "null", "{bad", "[]", doc(income_total="abc"), doc(income_total=10**30), doc(income_total=-12.7)]
    df = log(*[{"id": i, "request": i, "data": t} for i, t in enumerate(texts)])
    got = {r.report_id: r.income_total for r in silver.silver_reports_basic(df).collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: None, 5: None, 6: -12}


def test_export_shapes(log):
    shapes = [
        5,
        [],
        {"country": "A"},
        [1, "x", ENTRY],
        [{"current_sum": 1}, {"country": "", "current_sum": 2}, {"country": "None", "current_sum": 3}],
        [ENTRY, ENTRY],
    ]
    df = log(
        *[
            {"id": i, "request": i, "data": doc(income_international_current_quarter=s, company_tin=str(i))}
            for i, s in enumerate(shapes)
        ]
    )
    natural = gold.export_by_country_natural_key(df)
    assert sorted((r.bin, r.country, r.export_amount) for r in natural.collect()) == [("3", "A", 5), ("5", "A", 5), ("5", "A", 5)]
    canonical = gold.export_by_country(silver.silver_reports(df), df, cert_fallback=0)
    assert canonical.count() == 3
    columns = ("certificate_number", "income_international_current_quarter")
    stitched = gold.export_by_country_stitched(silver.silver_reports(df, columns=columns), cert_fallback=0)
    assert stitched.count() == 3
    details = silver.export_details(df)
    assert sorted((r.report_id, r.country) for r in details.collect()) == [(3, "A"), (4, ""), (4, "None"), (5, "A"), (5, "A")]
    assert gold.gold_export_details(silver.silver_reports_natural_key(df)).count() == 5


def test_both_export_periods(log):
    df = log(
        {
            "id": 1,
            "data": doc(
                income_international_current_quarter=[ENTRY],
                income_international_previous_quarter=[{"country": "B", "sum": "7.9"}],
            ),
        }
    )
    got = sorted((r.quarter_type, r.country, r.export_amount) for r in silver.export_details(df).collect())
    assert got == [("current", "A", 5), ("previous", "B", 7)]


CERTIFICATES = [("own", "p", "q", "own"), ("", "p", "q", "p"), (None, None, "q", "q"), (None, None, "-1", None), ("", None, "", "")]


@pytest.mark.parametrize("own, participant, request_, expected", CERTIFICATES)
def test_certificate_levels(spark, log, requests, own, participant, request_, expected):
    reports = silver.silver_reports(log({"id": 1, "data": doc(certificate_number=own)}))
    participants = spark.createDataFrame(
        [(1, participant, "t", "n")], "service_request_id bigint, certificate_number string, company_tin string, company_name string"
    ).selectExpr("*", "CAST(NULL AS DATE) AS certificate_issue_date", "CAST(NULL AS DATE) AS certificate_end_date")
    got = one(gold.general_indicators(reports, participants, requests({"id": 1, "cert": request_})))
    assert got.certificate_number == expected
    assert got.bin is None
    assert one(gold.employees(reports, participants, None, 2, identity_fallback=True)).bin == "t"
    assert one(gold.employees(reports, cert_fallback=0)).certificate_number == (own or None)


def test_request_versions(requests):
    df = requests(
        {"id": 1, "cert": "a", "issue": "2020-01-02"},
        {"id": 1, "day": 2, "op": "u", "cert": "b", "issue": "2024-02-31"},
        {"id": 1, "day": 3, "op": "d"},
        {"id": 2, "service": "other"},
        {"id": 3, "status": "draft", "cert": "c"},
    )
    got = one(silver.silver_participants(df))
    assert (got.service_request_id, got.certificate_number, got.certificate_issue_date, got.company_tin) == (1, "b", None, "777")
    levels = {r.id: r.cert_number for r in gold.latest_certificates(df).collect()}
    assert levels == {1: "b", 3: "c"}


def test_all_marts_have_one_row_per_signed_report(log, requests):
    df = log(
        {"id": 1, "data": doc(company_tin="1")},
        {"id": 2, "request": 2, "data": doc(company_tin="2")},
        {"id": 3, "status": "draft", "data": doc(company_tin="3")},
    )
    reqs = requests({"id": 1, "cert": "a"}, {"id": 2, "cert": "b"}, {"id": 2, "day": 2, "cert": "c"})
    reports, participants = silver.silver_reports(df), silver.silver_participants(reqs)
    resolved = gold.certificate_for(reports, participants, reqs)
    for mart in gold.MARTS.values():
        assert mart(reports, participants, reqs).count() == 2
        shared, own = mart(resolved), mart(reports, participants, reqs)
        assert sorted(map(str, shared.collect())) == sorted(map(str, own.collect()))
    sources = {r.source: r.cnt for r in gold.certificate_sources(reports, participants, reqs).collect()}
    assert sum(sources.values()) == 2


def test_yearly_is_not_added_to_quarters(log):
    kinds = ["quarter1", "quarter2", "quarter3", "quarter4", "yearly"]
    df = log(*[{"id": i, "type": k, "data": doc(income_total=10, tax_incentives=1)} for i, k in enumerate(kinds)])
    annual = one(summary.annual_summary(silver.silver_reports_basic(df)))
    assert (annual.signed_quarters, annual.income_total, annual.taxes_saved, annual.investor_amount) == (4, 40, 4, 0)
    totals = one(summary.annual_totals(summary.annual_summary(silver.silver_reports_basic(df))))
    assert (totals.companies_count, totals.total_income) == (1, 40)
    assert summary.period_summary(df).count() == 5


def test_sums_of_nothing(log):
    df = log({"id": 1, "data": "{}"})
    assert one(summary.period_summary(df)).total_income == 0
    assert one(summary.year_total(df, 2024)).income_total is None
    saved = log({"id": 1, "data": doc(total_tax_saved=3, tax_incentives=9)}, {"id": 2, "request": 2, "data": doc(tax_incentives=9)})
    got = summary.annual_summary(silver.silver_reports(saved), taxes="saved_first")
    assert sorted(r.taxes_saved for r in got.collect()) == [3, 9]


def test_dashboard_does_not_fan_out(log):
    df = log(
        *[
            {"id": i, "request": i % 2, "type": f"quarter{1 + i // 2}", "data": doc(company_tin=str(i % 2), total_tax_saved=1, residents_count=2, investments_total_current_quarter=5)}
            for i in range(8)
        ]
    )
    reports = silver.silver_reports(df)
    g, t, e = (gold.MARTS[m](reports, cert_fallback=0) for m in ("general_indicators", "tax_benefits", "employees"))
    got = one(bi.yearly_dashboard(g, t, e))
    assert (got.companies_count, got.total_investments, got.total_tax_saved, got.total_employees) == (2, 40, 8, 16)
    detail = one(bi.company_detail(g, t, e, tin="1"))
    assert (detail.total_funding, detail.total_tax_saved, detail.residents_count) == (20, 4, 8)


@pytest.fixture()
def registry_inputs(spark):
    report = spark.createDataFrame(
        [
            (1, 2024, "signed", "quarter1", doc(has_raised_investors_funds="true", raised_investors_funds=[{"country": "A", "invested_sum": "5.5"}, {"capital_amount": 7, "investor": {"x": 1}}]), "1", None, 10),
            (2, 2024, "signed", "quarter1", doc(has_raised_investors_funds="false", raised_investors_funds=[{"country": "Z"}]), "1", None, 10),
            (3, 2024, "signed", "quarter2", doc(has_raised_investors_funds="true", raised_investors_funds="text"), "1", None, 99),
            (4, 2024, "draft", "quarter1", doc(has_raised_investors_funds="true", raised_investors_funds=[{"country": "Y"}]), "1", None, 10),
        ],
        "id int, year int, status string, report_type string, data string, version string, signed_at timestamp, service_request_id int",
    )
    request = spark.createDataFrame([(10, "N", doc(activation_info={"certificate_number": "c"}), 20, 30)], "id int, number string, data string, company_id int, hub_form_id int")
    company = spark.createDataFrame([(20, "Co", "777")], "id int, name string, tin string")
    form = spark.createDataFrame([(30, doc(heads_full_name="Head"))], "id int, data string")
    return report, request, company, form


def test_registries(registry_inputs):
    got = registry.run_registry("raised_investors", *registry_inputs, 2024, "quarter1").collect()
    assert sorted((r.id, r.company_tin, r.country, r["sum"]) for r in got if r.country) == [(1, "777", "A", 5)]
    assert [(r["sum"], r.investor) for r in got if not r.country] == [(7, '{"x":1}')]
    unflagged = registry.run_registry("raised_investors", *registry_inputs, 2024, "quarter1", use_flag=False)
    assert unflagged.count() == 3
    residents = {r.id: r for r in registry.run_registry("residents", *registry_inputs).collect()}
    assert len(residents[1]) == 36
    assert (residents[1].certificate_number, residents[1].heads_full_name, residents[3].company_name) == ("c", "Head", None)
    total = registry.run_registry("summary", *registry_inputs, 2024)
    assert sorted((r.report_type, r.total, r.period) for r in total.collect()) == [("quarter1", 2, "1 кв. 2024 г."), ("quarter2", 1, "2 кв. 2024 г.")]
    with pytest.raises(ValueError):
        registry.run_registry("unknown", *registry_inputs)
    with pytest.raises(ValueError):
        registry.run_registry("summary", *registry_inputs)


def test_registry_key_can_be_renamed(spark):
    base = spark.createDataFrame([(1, "Co", "7", doc(nonresidents_family=[{"fullname_x": "H"}]))], "id int, company_name string, company_tin string, data string")
    spec = registry.REGISTRIES["nonresidents_family"]
    got = one(registry.unnest_registry(base, spec, rename_keys={registry.HOST_KEY: "fullname_x"}))
    assert got[registry.HOST_KEY] == "H" and len(got) == 13


def test_quality_audits(spark):
    mart = spark.createDataFrame([("7777771", "a", 2024), ("", None, 2024), (None, "", 2023), ("5", "b", 2023)], "bin string, certificate_number string, year int")
    masked = {r.bin_status: (r.cnt, r.percent) for r in quality.masking_coverage(mart).collect()}
    assert masked == {"MASKED": (1, 25.0), "REAL": (3, 75.0)}
    blank = {r.fill_status: r.cnt for r in quality.blank_audit(mart, "bin").collect()}
    assert blank == {"EMPTY": 2, "FILLED": 2}
    assert quality.blank_audit(mart, "bin", detail=True, columns=["year"]).count() == 2
    coverage = {r.year: (r.total, r.has_bin) for r in aggregates.field_coverage(mart, ["bin"]).collect()}
    assert coverage == {2024: (2, 2), 2023: (2, 1)}
    reduced = one(quality.row_reduction(mart, mart.limit(1)))
    assert tuple(reduced) == (4, 1, 3)


def test_unique_keys_guard(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert quality.assert_unique(df, ["k"]).count() == 2
    with pytest.raises(Exception, match="not unique"):
        quality.assert_unique(df.union(df), ["k"]).collect()


def test_share_needs_no_single_task_window(spark):
    df = spark.range(100).groupBy((F.col("id") % 3).alias("g")).agg(F.count(F.lit(1)).alias("cnt"))
    out = aggregates.with_percent(df)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert round(sum(r.percent for r in out.collect()), 6) == 100.0


def test_numeric_profile(spark):
    got = one(aggregates.numeric_profile(spark.range(1, 101).selectExpr("CAST(id AS INT) AS a"), ["a"]))
    assert (got["count"], got["mean"], got["min"], got.p25, got.p50, got.p75, got["max"]) == (100, 50.5, 1, 25.75, 50.5, 75.25, 100)


def _sorted_and_shipped(df):
    """Columns of the rows that the partial aggregate sorts, which holds what it ships."""
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1
    lines = text.splitlines()
    partial = next(k for k, line in enumerate(lines) if "partial_max_by" in line)
    project = next(line for line in lines[partial:] if "- Project [" in line)
    depth, items = 0, [""]
    for c in project[project.index("[") + 1 : project.rindex("]")]:
        depth += (c in "([") - (c in ")]")
        if c == "," and not depth:
            items.append("")
        else:
            items[-1] += c
    return {re.search(r"(\w+)#\d+L?$", item).group(1) for item in items}


def test_the_canonical_build_ships_only_what_is_asked_for(spark, log):
    """Neither payload nor signature is sorted or shuffled, and of the fields just those that are named."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.debug.maxToStringFields", "spark.sql.maxMetadataStringLength")}
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        df = log({"id": 1, "data": '{"company_tin":"1","residents_count":3}'})
        wide = _sorted_and_shipped(silver.silver_reports(df, columns=gold.NEEDED["employees"]))
        bare = _sorted_and_shipped(silver.silver_reports(df, columns=(), with_identity=False))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {"f_residents_count", "signed_tin", "doc_tin"} <= wide and not {"data", "signature"} & wide
    assert not {"data", "signature", "signed_tin"} & bare and not any(c.startswith("f_") for c in bare)


def test_arguments_that_do_not_apply_are_refused(spark, log):
    df = log({"id": 1, "data": "{}"}, {"id": 1, "day": 9, "op": "d"})
    with pytest.raises(ValueError):
        silver.silver_reports(df, require_payload=True)
    assert silver.silver_reports(df).count() == 1
    assert silver.silver_reports(df, tombstones="after").count() == 0
    resolved = gold.certificate_for(silver.silver_reports(df))
    with pytest.raises(ValueError):
        gold.financing(resolved, cert_fallback=2)
