"""Stages against brute force, each on its own input."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from conftest import SCHEMA, prose
from test_near_texts import brute
from test_secrets import checked

from cdcstrata.llm import registry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs, labels = [], []
    for k in range(240):
        text = prose(k, 30 + k % 60)
        toxic = int(k % 6 == 1)
        if toxic:
            text += " vile nasty horrid"
        docs.append((k, text, "en", "abc"[k % 3], len(text)))
        labels.append((k, 1, toxic))
    docs += [(300 + k, docs[k][1], "en", "d", docs[k][4]) for k in range(0, 60, 6)]  # exact copies
    docs += [(400 + k, docs[k][1] + " end", "en", None, 0) for k in range(0, 60, 6)]  # near copies
    docs += [(500, f"call {checked()} now", "en", "a", 0), (501, None, None, None, None), (502, "", "en", "b", 0)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_copies", "secrets", "mixing", "pieces"]
    step = {name: {} for name in stages}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs.selectExpr("*"), folder)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        step[name] = (before.collect(), rows, docs.columns)
    names = list(corpus_pipeline.COLUMNS)
    assert all(step[s][2] == names for s in list(stages)[:-1])

    before, after, _ = step["toxicity"]
    assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {k for k in range(240) if k % 6 == 1}

    before, after, _ = step["near_copies"]
    want = brute([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(k for k, (root, _) in want.items() if root == k)

    before, after, _ = step["secrets"]
    assert len(before) == len(after)
    changed = {r["doc_id"] for r in before} - {a["doc_id"] for a in after for b in before if a["doc_id"] == b["doc_id"] and a["text"] == b["text"]}
    assert changed == {500}
    assert next(r["text"] for r in after if r["doc_id"] == 500) == "call [checked removed] now"

    before, after, _ = step["mixing"]
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in before}
    taken = {}
    for r in after:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert all(taken[k] <= 2 * sizes[k] for k in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 5

    before, after, _ = step["pieces"]
    assert len(before) == len(after) and all(r["round_trip"] for r in after)


def test_run_equals_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)


def test_repeated_and_nameless_rows(spark, folder):
    text = prose(1, 40)
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, "en", "a", 1), (None, text, "en", "a", 1), (None, text, "en", "a", 1)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "None", "None"]


def test_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []
        docs = spark.createDataFrame([], SCHEMA)


def test_registered(spark):
    names = set(registry.queries())
    assert names <= set(entry.queries()) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


def test_rows_that_share_an_id_are_rows(spark, folder):
    """Different texts of one id are not united, by themselves or by way of the groups that each is in."""
    a, b, c = (prose(k, 40) for k in (1, 2, 3))
    rows = [(1, a, "en", "a", 1), (1, b, "de", "a", 1), (0, a + " end", "en", "a", 1), (5, b, "en", "a", 1), (6, c, "en", "a", 1), (6, c, "xx", "b", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS __row", "2 AS class_id", "'x' AS `order`")
    for parts in (1, 5):
        kept = corpus_pipeline.drop_near_copies(spark, docs.repartition(parts), folder).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(0, a + " end"), (1, b), (6, c)])


def test_stages_take_extra_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(40)
    extra = docs.selectExpr("*", "1 AS shard", "'t' AS terms", "2 AS words", "map('a', 1) AS label", "3 AS class_id", "'i' AS ids")
    for name, stage in corpus_pipeline.STAGES:
        both = [stage(spark, df, folder) for df in (docs, extra)]
        assert both[0].columns == both[1].columns and both[0].count() == both[1].count(), name
