"""Lenient scalars under ANSI mode, which Spark 4 has on by default."""

import pytest
from pyspark.sql import functions as F

from cdcstrata import functions as fn
from cdcstrata.operators.aggregates import numeric_profile


def values(spark, column, inputs, type_="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"n int, x {type_}")
    return [row[0] for row in df.orderBy("n").select(column).collect()]


NUMBERS = {
    "12": 12,
    " 12 ": 12,
    "12.7": 12,
    "-12.7": -12,
    "12.9999999": 12,
    "1e3": 1000,
    "1.2345678901E10": 12345678901,
    "9223372036854775807": 9223372036854775807,
    "9223372036854775808": None,
    "9" * 40: None,
    "": None,
    "abc": None,
    "[1]": None,
    None: None,
}


def test_numbers_from_text(spark):
    assert values(spark, fn.to_bigint("x"), NUMBERS) == list(NUMBERS.values())
    assert values(spark, fn.to_bigint(F.col("x")), NUMBERS) == list(NUMBERS.values())
    assert values(spark, fn.to_int("x"), ["7.9", "3000000000", "x"]) == [7, None, None]


def test_dates_from_text(spark):
    got = values(spark, fn.to_date("x").cast("string"), ["2024-02-29", "2024-02-31", "", None, "x"])
    assert got == ["2024-02-29", None, None, None, None]


def test_blanks(spark):
    assert values(spark, fn.blank_to_null("x", "-1"), ["a", "", "-1", None]) == ["a", None, None, None]
    assert values(spark, fn.is_blank("x"), ["a", "", None]) == [False, True, True]
    assert values(spark, fn.first_non_blank("x", F.lit(""), F.lit("z")), ["a", "", None]) == ["a", "z", "z"]


@pytest.mark.parametrize(
    "text, expected",
    [("a***b***c***d***e", "d"), ("a***b***c***d", "d"), ("a***b", None), ("", None), ("a***b***c******e", None), (None, None)],
)
def test_fourth_token(spark, text, expected):
    assert values(spark, fn.nth_token("x", 4), [text]) == [expected]


def test_labelled_digits(spark):
    got = values(spark, fn.labelled_digits("x", "БИН"), ["имя БИН: 123 x", "БИН:9", "none", None])
    assert got == ["123", "9", None, None]


XML = {
    "<company><tin>111</tin><name>N</name></company><signer><tin>222</tin></signer>": ("111", "222"),
    "<company>\n<tin>111</tin>\n</company>": ("111", "111"),
    "<company><name>N</name></company><signer><tin>222</tin></signer>": (None, "222"),
    "<other><tin>5</tin></other>": (None, None),
    "": (None, None),
    None: (None, None),
}


def test_xml_first_and_last(spark):
    first = values(spark, fn.xml_tag("x", "company", "tin", "[0-9]+"), XML)
    last = values(spark, fn.xml_tag("x", "company", "tin", "[0-9]+", mode="last"), XML)
    assert list(zip(first, last)) == list(XML.values())
    with pytest.raises(ValueError):
        fn.xml_tag("x", "company", "tin", mode="middle")


def test_period_labels(spark):
    kinds = ["quarter1", "quarter4", "yearly", "odd"]
    assert values(spark, fn.period_label("x", 2024), kinds) == ["Q1 2024", "Q4 2024", "Year 2024", "Year 2024"]
    assert values(spark, fn.period_label("x", 2024, "ru"), kinds)[:3] == ["1 кв. 2024", "4 кв. 2024", "Итого 2024"]
    assert values(spark, fn.period_label("x", 2024, "ru_long"), kinds)[0] == "1 кв. 2024 г."
    assert values(spark, fn.period_label("x", 2024, "ru_short"), kinds) == ["1кв.2024г.", "4кв.2024г.", "итого.2024г.", "odd"]


def test_previous_quarter_and_cutoff(spark):
    days = ["2024-01-15", "2024-03-31", "2024-04-01", "2024-12-31"]
    year, name = fn.previous_quarter(F.col("x").cast("date"))
    assert values(spark, F.concat_ws("-", year.cast("string"), name), days) == [
        "2023-quarter4",
        "2023-quarter4",
        "2024-quarter1",
        "2024-quarter3",
    ]
    assert values(spark, fn.days_before(F.lit("2024-03-01 10:00:00").cast("timestamp"), 1).cast("string"), ["a"]) == ["2024-02-29"]


def test_residency_masks_percent(spark):
    assert values(spark, fn.is_resident("x"), ["Казахстан", "", None, "Italy"]) == [True, True, True, False]
    assert values(spark, fn.is_masked("x"), ["777777123", "123", None]) == [True, False, False]
    assert values(spark, fn.percent("x", F.lit(8)), [1, 0, None], "bigint") == [12.5, 0.0, None]
    assert values(spark, fn.percent(F.lit(1), "x"), [0], "bigint") == [None]
    assert values(spark, fn.null_safe_sum("x", F.lit(2)), [1, None], "bigint") == [3, 2]


def test_certificate_source(spark):
    rows = [("a", "b", "c"), ("", "b", "c"), (None, None, "c"), (None, None, "-1"), ("", None, None)]
    df = spark.createDataFrame(rows, "r string, p string, q string")
    got = [x[0] for x in df.select(fn.certificate_source("r", "p", "q")).collect()]
    assert got == ["from_report", "from_participants", "from_servicerequest", "missing", "missing"]


def test_payload_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a":"1","b":{"c":2},"d":[1,"x"],"e":12345678901.0}',), ("{bad",), (None,)], "data string")
    parsed = fn.parse_payload(df, ["a", "b", "d", "e"])
    plan = parsed.select("doc.a", "doc.b", fn.to_bigint("doc.e"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    rows = parsed.select("doc.*").collect()
    assert tuple(rows[0])[:3] == ("1", '{"c":2}', '[1,"x"]')
    assert [x[0] for x in parsed.select(fn.to_bigint("doc.e")).collect()] == [12345678901, None, None]
    assert fn.json_str("data", "b.c") is not None
    assert df.select(fn.json_str("data", "b.c")).first()[0] == "2"


def test_array_guard(spark):
    texts = ["[]", "[1]", "5", "{}", None]
    assert values(spark, fn.is_json_array("x"), texts) == [True, True, False, False, None]
    assert values(spark, fn.json_items("x"), ['[1,{"a":2}]', "5", "[]"]) == [["1", '{"a":2}'], None, []]
    assert values(spark, fn.has_item_country("x"), ["A", "", "None", None]) == [True, False, False, False]


def test_percent_and_profile_of_fractions(spark):
    df = spark.createDataFrame([(0.4, 0.8), (1.0, 3.0), (2.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(fn.percent("a", "b")).collect()] == [50.0, 33.33, None]
    values = spark.createDataFrame([(1.5, 1), (2.5, 2), (3.25, 3), (None, 5)], "x double, n int")
    row = numeric_profile(values, ["x"]).first()
    assert (row["min"], row["p25"], row["p50"], row["p75"], row["max"], row["count"]) == (1.5, 2.0, 2.5, 2.875, 3.25, 3)
    whole = numeric_profile(values, ["n"]).first()
    assert (whole["min"], whole["p25"], whole["max"]) == (1, 1.75, 5)
    assert dict(numeric_profile(values, ["n"]).dtypes)["min"] == "bigint"
    assert numeric_profile(values, ["n"], accuracy=100).first()["p50"] == 2.0
