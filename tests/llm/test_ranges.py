"""Stored order and ranks."""

from cdcstrata.llm.ranges import lower_ascii, ranged, ranked


def test_order_and_ranks(spark):
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', IF(id % 7 = 0, NULL, string(id % 5))) AS g", "7 AS one", "id % 100 AS v")
    got = ranked(rows, "g", ["v"], "test").collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r["g"], []).append(r)
    assert len(got) == 5000
    for some in by_group.values():
        some.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in some] == list(range(len(some))) and {r["n"] for r in some} == {len(some)}
        assert [r["v"] for r in some] == sorted(r["v"] for r in some)


def test_one_value_fills_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ranged(spark.range(4000).selectExpr("1 AS same"), ["same"], "test").groupBy("part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(placed) == 8 and max(r["count"] for r in placed) < 1000


def test_lower_ascii(spark):
    row = spark.sql("SELECT 'AbZ' AS a, 'ÀBÉz' AS b, CAST(NULL AS STRING) AS c")
    assert tuple(row.select(*[lower_ascii(row[c]) for c in "abc"]).first()) == ("abz", "ÀbÉz", None)
