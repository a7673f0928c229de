"""XML that is parsed and payloads that are stored parsed."""

import json

import pytest
from pyspark.sql import functions as F

from cdcstrata.functions.payload import parse_payload, parse_variant, xml_child, xml_tag
from cdcstrata.functions.payload import UNAVAILABLE_PAYLOAD as UNAVAILABLE
from cdcstrata.operators.predicates import has_payload
from cdcstrata.plans import silver

DOCUMENTS = {
    "<doc><company><tin>123</tin><name>A &amp; B</name></company></doc>": ("123", "A & B"),
    '<doc><company id="7" x="&lt;"><tin>123</tin><name>A</name></company></doc>': ("123", "A"),
    '<doc><company><tin kind="x">123</tin><name lang="kk">Ә &#65;</name></company></doc>': ("123", "Ә A"),
    '<?xml version="1.0"?><doc>\n <company>\n  <tin>\n5</tin><name> A  B </name></company></doc>': ("5", "A  B"),
    "<doc><signer><tin>9</tin></signer><company><name>A</name></company></doc>": (None, "A"),
    "<doc><company><tin>1</tin><tin>2</tin><name>A</name></company><company><tin>3</tin></company></doc>": ("1", "A"),
    "<doc><company><tin>12a</tin><name></name></company></doc>": (None, None),
    "<doc><company><name><![CDATA[x < y]]></name></company></doc>": (None, "x < y"),
    "<doc><signer/></doc>": (None, None),
    "<doc><company><tin>1</tin>": (None, None),
    "no xml at all": (None, None),
    "": (None, None),
}


@pytest.mark.parametrize("text", list(DOCUMENTS))
def test_xml_is_parsed(spark, text):
    df = spark.createDataFrame([(text,), (None,)], "x string")
    tags = [xml_tag("x", "company", "tin", "[0-9]+", "parsed"), xml_tag("x", "company", "name", mode="parsed")]
    got = df.select(*[t.alias(n) for t, n in zip(tags, ("tin", "name"), strict=True)]).collect()
    assert tuple(got[0]) == DOCUMENTS[text] and tuple(got[1]) == (None, None)


def test_parsed_and_matched_agree_on_plain_documents(spark):
    df = spark.range(50).selectExpr("concat('<doc><company><tin>', id, '</tin><name>N ', id, '</name></company></doc>') AS x")
    for tag, content in (("tin", "[0-9]+"), ("name", "[^<]+")):
        both = df.select(xml_tag("x", "company", tag, content).alias("a"), xml_tag("x", "company", tag, content, "parsed").alias("b"))
        assert both.filter("a IS NOT NULL AND a = b").count() == 50
    with pytest.raises(ValueError):
        xml_tag("x", "company", "tin", mode="other")
    assert df.select(xml_child("x", "company", "none").alias("n")).filter("n IS NOT NULL").count() == 0


PAYLOADS = [
    json.dumps({"company_tin": "1", "income_total": 12.7, "residents_count": 3, "activity_fields": ["a", "b"]}),
    json.dumps({"income_total": "  44 ", "residents_count": None, "company_name": ""}),
    '{"income_total": 1e3, "company_tin": true}',
    '{"company_tin": "cut o',
    "[1, 2]",
    '"text"',
    "{}",
    "",
    UNAVAILABLE,
    None,
]
FIELDS = ("company_tin", "company_name", "income_total", "residents_count", "activity_fields")


def test_variant_fields_are_those_of_the_text(spark, tmp_path):
    df = spark.createDataFrame([(k, p) for k, p in enumerate(PAYLOADS)], "k int, data string")
    parse_variant(df).write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    assert dict(stored.dtypes)["data"] == "variant"

    def fields(rows):
        parsed = parse_payload(rows, FIELDS)
        out = parsed.select("k", F.coalesce(has_payload("data"), F.lit(False)).alias("there"), *[F.col(f"doc.{f}") for f in FIELDS])
        return {r["k"]: r.asDict() for r in out.collect()}

    text, variant = fields(df), fields(stored)
    for k in text:
        numbers = {"income_total"}
        assert {f: v for f, v in text[k].items() if f not in numbers} == {f: v for f, v in variant[k].items() if f not in numbers}, k
    assert [float(variant[k]["income_total"]) for k in (0, 1, 2)] == [float(text[k]["income_total"]) for k in (0, 1, 2)]
    assert [variant[k]["there"] for k in range(len(PAYLOADS))] == [True] * 8 + [False] * 2


def test_silver_from_either(spark, log):
    versions = [{"id": k, "day": 1 + k % 3, "data": p, "op": "ru"[k % 2], "type": f"quarter{k % 4 + 1}"} for k, p in enumerate(PAYLOADS * 2)]
    rows = log(*versions)
    state = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    for build in (silver.silver_reports, silver.silver_reports_basic, silver.silver_reports_natural_key, silver.silver_preview):
        assert state(build(parse_variant(rows))) == state(build(rows))


def test_variant_is_not_parsed_again_nor_shuffled(spark, log, tmp_path):
    parse_variant(log({"id": 1, "data": PAYLOADS[0]})).write.parquet(str(tmp_path / "log"))
    plan = silver.silver_reports(spark.read.parquet(str(tmp_path / "log")))._jdf.queryExecution().executedPlan().toString()
    shipped = plan[plan.index("Exchange") :].split("FileScan")[0]
    assert "from_json" not in plan and "parse_json" not in plan
    exchange = next(line for line in plan.splitlines() if "partial_max_by" in line)
    assert "try_variant_get" not in exchange.split("partial_max_by")[0] and shipped
