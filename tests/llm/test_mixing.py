"""The mix against a plain water-filling loop, and its draws against the quotas' laws."""

import re

import pytest
from conftest import SCHEMA, prose

from cdcstrata.llm import mixing as M


def poured(sizes: dict, weights=(3, 1, 2), share=1.5, limit=2):
    """By weight, what is above the limit shared again, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(limit * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        over = [s for s in rest if level * weight[s] > limit * sizes[s]]
        if not over:
            return {s: limit * sizes[s] if s in full else level * weight[s] for s in names}
        full |= set(over)


def words(text):
    return len(re.findall(M.WORD, text or ""))


@pytest.fixture(scope="module")
def corpus(spark):
    texts = [(k, prose(k, 3 + k % 50), ["b", "a", None, "b", "b", "c", "é"][k % 7]) for k in range(1500)]
    texts += [(1500, None, "a"), (1501, "", "zero"), (1502, " \x0b", "zero"), (1503, "x", "b"), (1503, "x", "b")]
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def test_taken_words_meet_targets(spark, corpus):
    found = M.taken(frame(spark, corpus).selectExpr("*", "1 AS size", "'y' AS block").repartition(6)).collect()
    assert len(found) == len(corpus)
    sizes = {}
    for _, t, s in corpus:
        sizes[s] = sizes.get(s, 0) + words(t)
    goal, got = poured(sizes), {}
    source = {i: s for i, _, s in corpus}
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[s] = got.get(s, 0) + r["taken"]
    assert all(abs(got[s] - goal[s]) <= 0.5 for s in goal)
    again = M.taken(frame(spark, corpus).repartition(2)).collect()
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, found)) == sorted(map(key, again))


def test_rows_that_differ_in_one_column(spark):
    """Rows equal but for a column that the mix does not read are all drawn, each with its own columns."""
    rows = [(1, "one two three", lang, "a", n) for lang, n in (("en", 1), ("de", 1), (None, 1), ("en", None))] * 2
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "map('k', lang) AS m")
    mixed = M.mix(docs, share=1.0).collect()
    drawn = sorted((str(r["lang"]), str(r["n_chars"])) for r in mixed)
    assert drawn == sorted((str(x), str(n)) for _, _, x, _, n in rows)
    taken = M.taken(docs).collect()
    assert sum(r["taken"] for r in taken) == 36


def test_shards_come_from_the_tree(spark, corpus):
    docs = frame(spark, corpus)
    by_shards = {}
    for shards in (2, 8):
        rows = M.taken(docs, shards=shards).collect()
        named = [int(s) for r in rows for s in r["shards"].split(",") if s]
        assert set(named) == set(range(shards))
        assert all(bool(r["shards"]) == (r["taken"] > 0) for r in rows)
        by_shards[shards] = sorted((r["doc_id"], r["size"], r["shards"]) for r in rows)
    assert by_shards[2] != by_shards[8]


def test_water_level_in_sql(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 30, "d": 500}, {"a": 5}, {"a": 1, "b": 1, "c": 10**6}, {"a": 0, "b": 7}):
        df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
        got = {r["source"]: r["target"] for r in M.targets(df).collect()}
        assert got == pytest.approx(poured(sizes))


def test_mix_rows(spark, corpus):
    rows = M.mix(frame(spark, corpus), shards=5).collect()
    taken = {}
    for r in M.taken(frame(spark, corpus), shards=5).collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + r["taken"]
    got = {}
    for r in rows:
        assert words(r["text"]) == r["words"] and 0 <= r["shard"] < 5
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["words"]
    assert got == {i: n for i, n in taken.items() if n}
    shards = [sum(r["words"] for r in rows if r["shard"] == k) for k in range(5)]
    assert min(shards) > 0


def test_tree_has_exact_quotas(spark):
    counts = spark.createDataFrame([("a", 4000), ("b", 37), (None, 1), ("c", 900)], "source string, blocks bigint")
    rows = M.split_tree(counts, 8).collect()
    by_source, by_shard = {}, {}
    for r in rows:
        assert r["quota"] >= 0
        by_source[r["source"]] = by_source.get(r["source"], 0) + r["quota"]
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["quota"]
    assert by_source == {"a": 4000, "b": 37, None: 1, "c": 900}
    assert sorted(by_shard) == list(range(8)) and max(by_shard.values()) - min(by_shard.values()) <= 3
    # A fair draw: 500 of source a a shard, give or take five standard deviations.
    assert all(abs(r["quota"] - 500) < 70 for r in rows if r["source"] == "a")


@pytest.mark.parametrize(("total", "marked", "drawn"), [(10, 4, 5), (1, 1, 0), (7, 0, 3), (9, 9, 4), (10**7, 10**5, 10**6)])
def test_hypergeometric_law(spark, total, marked, drawn):
    expr = M.hypergeometric("t", "m", "d", "u")
    df = spark.range(2000).selectExpr(f"{total}D t", f"{marked}D m", f"{drawn}D d", "(id + 0.5D) / 2000 u").selectExpr(f"{expr} k")
    got = [r["k"] for r in df.collect()]
    assert got == sorted(got)  # the inverse of a distribution function
    assert min(got) >= max(0, drawn + marked - total) and max(got) <= min(drawn, marked)
    mean = drawn * marked / total
    deviation = (mean * (1 - marked / total) * (total - drawn) / max(1, total - 1)) ** 0.5
    assert abs(sum(got) / len(got) - mean) <= 0.01 + 0.02 * deviation
    spread = (sum((x - mean) ** 2 for x in got) / len(got)) ** 0.5
    assert spread == pytest.approx(deviation, rel=0.03, abs=0.02)


def test_empty_and_wordless(spark):
    assert M.taken(frame(spark, [])).collect() == []
    rows = M.taken(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_plan_is_native(spark, corpus):
    plan = M.taken(frame(spark, corpus))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
