"""Steps that the large queries spend their time in are made once a row, and only where there is something to do."""

import re
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cdcstrata.checks import rules as r
from cdcstrata.checks.bronze import Tables
from cdcstrata.functions.payload import UNAVAILABLE_PAYLOAD, parse_payload, parse_variant
from cdcstrata.functions.scalars import text_to_bigint, to_bigint
from cdcstrata.plans import crm, gold
from cdcstrata.sources.scratch import TEXT, materialise, store


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_report_documents_are_those_of_the_json_writer(spark, tmp_path):
    some = spark.range(1, 400).selectExpr(
        "id AS o_orderkey", "if(id % 9 = 0, NULL, id * 7) AS o_custkey", "if(id % 10 = 0, NULL, substr('FPO', 1 + id % 3, 1)) AS o_orderstatus",
        "if(id % 8 = 0, NULL, CAST(id * 771.3 AS DOUBLE)) AS o_totalprice",
        "if(id % 7 = 1, NULL, TIMESTAMP_NTZ'1996-03-01 00:00:00' + make_interval(0, 0, 0, CAST(id * 5 AS INT))) AS o_orderdate",
    )
    some.write.parquet(f"{tmp_path}/orders.parquet")
    tables = Tables(spark, str(tmp_path))
    flags = dict(re.findall(r'"(has_\w+)":"(true|false)"', tables._report_log().filter("data LIKE '{%'").first()["data"]))
    base = tables.order_base.selectExpr("*", "0 AS lag")
    names = {**r.TEXT_RULES, **r.NUMBER_RULES}
    written = base.selectExpr("k", "to_json(named_struct(" + ", ".join(f"'{n}', {rule}" for n, rule in names.items()) + ")) AS document")
    made = tables._report_log().filter("data LIKE '{%'").selectExpr("id AS k", "data")
    rows = made.join(written, "k").collect()
    assert len(rows) == made.count() > 300 and len(flags) == 3
    assert all(row["data"].startswith(row["document"].removesuffix("}") + ',"has_') for row in rows)
    assert "to_json" not in optimized(made.select("data"))


def test_copies_have_no_dictionaries(spark):
    path = store(spark.range(100).selectExpr("id % 3 AS id", "string(id % 2) AS text"), "copy", **TEXT).removeprefix("file:")
    for file in glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            assert not any(meta.row_group(g).column(c).has_dictionary_page for c in range(meta.num_columns))


def test_a_placeholder_is_not_parsed(spark):
    log = spark.createDataFrame([(1, '{"a":"x"}'), (2, UNAVAILABLE_PAYLOAD), (3, None), (4, "{broken")], "id int, data string")
    parsed = parse_payload(log, ["a"])
    assert {row["id"]: row["a"] for row in parsed.select("id", "doc.a").collect()} == {1: "x", 2: None, 3: None, 4: None}
    assert UNAVAILABLE_PAYLOAD in optimized(parsed)


def test_text_is_read_as_the_decimal_way_reads_it(spark):
    odd = [chr(i) for i in (*range(1, 0x100), 0x661, 0x1680, 0x2028, 0x3000)]
    texts = [x for c in odd for x in (c, f"{c}12", f"12{c}", f"1{c}2", f"-12{c}")]
    texts += ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "1e3", "12.7", "-12.7", ".5", "", " ", "007", "abc", "9" * 21, None]
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    seen = rows.select("c", text_to_bigint("c").alias("a"), to_bigint("c").alias("b")).filter("NOT a <=> b").collect()
    assert seen == []


def test_an_export_array_is_cut_out_once(spark, log):
    array, number = '{"income_international_current_quarter":[{"country":"EGYPT","current_sum":5}]}', '{"income_international_current_quarter":7}'
    cdc = log({"id": 1, "data": array}, {"id": 2, "data": number}, {"id": 3, "data": "{}"}, {"id": 4, "data": None})
    silver = spark.createDataFrame(
        [(i, i, 2024, "quarter1", "signed", "r", "c", "t", "n") for i in range(1, 5)],
        "report_id bigint, service_request_id bigint, year int, report_type string, status string, op string, certificate_number string, company_tin string, company_name string",
    )
    out = gold.export_by_country(silver, cdc, cert_fallback=0)
    assert [(row["country"], row["export_income"]) for row in out.collect()] == [("EGYPT", 5)]
    assert optimized(out).count("get_json_object") == 1


def test_variant_fields_are_taken_in_one_pass(spark):
    log = spark.createDataFrame(
        [(1, '{"a":"x","b":{"c":[1,null]},"n":1.50}'), (2, '{"a":null,"b":7}'), (3, UNAVAILABLE_PAYLOAD), (4, "{broken"), (5, "[1]"), (6, "true"), (7, None)],
        "id int, data string",
    )
    stored = materialise(parse_variant(log), "variant", **TEXT)
    names = ["a", "b", "n", "none"]
    one = parse_payload(stored, names).select("id", *[F.col(f"doc.{n}").alias(n) for n in names])
    each = stored.select("id", *[F.try_variant_get("data", f"$.{n}", "string").alias(n) for n in names])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, each.collect()))
    assert parse_payload(stored, names).select("doc")._jdf.queryExecution().analyzed().toString().count("variant_get") == 1


@pytest.mark.parametrize("entity", ["leads", "companies"])
def test_custom_fields_are_parsed_once(spark, entity):
    fields = '[{"field_id":1,"field_name":"БИН","values":[{"value":"12"}]},{"field_id":2,"field_name":"Источник","values":[{"value":"web"}]}]'
    rows = spark.createDataFrame(
        [(1, "n", 5, 3, 10, 1, None, 0, 1, None, False, fields, "[]", "[]", "[]")],
        "id bigint, name string, price bigint, responsible_user_id int, status_id int, pipeline_id int, loss_reason_id int, created_at bigint, updated_at bigint, "
        "closed_at bigint, is_deleted boolean, custom_fields_values string, tags_json string, contacts_json string, companies_json string",
    )
    users = spark.createDataFrame([(3, "u")], "id int, name string")
    statuses = spark.createDataFrame([(1, "p", True, 10, "New", 1, "#")], "pipeline_id int, pipeline_name string, is_main_pipeline boolean, status_id int, status_name string, status_sort int, status_color string")
    out = crm.crm_leads_silver(rows, statuses, users) if entity == "leads" else crm.crm_companies_silver(rows, users)
    assert out.first()["cf_bin" if entity == "leads" else "bin"] == "12"
    assert len(re.findall(r"\), custom_fields_values#", optimized(out))) == 1
