"""Line dedup against a plain reading of its rule."""

import hashlib
import random

import pytest
from conftest import SCHEMA

from cdcstrata.llm import line_dedup as L

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def plain(rows, min_docs=5):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key(line), set())
            largest = max((x for x in ids if x is not None), default=None)
            if len(ids) < min_docs or doc_id == largest:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def table(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return docs.selectExpr("*", "1 AS kept", "2 AS `position`", "'h' AS hash", "3 AS n_lines", "4 AS __id").repartition(7)


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_plain_reading(spark, seed):
    r = random.Random(seed)
    shared = [f"Shared Line number {k} that is long enough to count É{'x' * (k % 5)}" for k in range(30)]
    short = ["short", "", "   ", "a" * 39, "\t" + "b" * 39 + " " * 9, "é" * 40, "日本" * 20]
    rows = []
    for k in range(300):
        lines = []
        for _ in range(r.randint(0, 12)):
            line = r.choice(shared + short) if r.random() < 0.7 else f"own line {k} {r.random()} " * 3
            lines.append(r.choice(["", " ", "\r", "\x0b\t"]) + (line.upper() if r.random() < 0.2 else line) + r.choice(["", "\r", "\f "]))
        rows.append((k if r.random() < 0.95 else None, None if k % 37 == 5 else "\n".join(lines)))
    rows += [(rows[7][0], "another text of the same id\n" + shared[1]), *rows[:20]]  # shared ids and repeated rows
    got = [tuple(x) for x in L.digest(table(spark, rows)).collect()]
    assert order(got) == order(plain(rows))


def test_a_hot_line_over_many_ranges(spark):
    """One line in every document fills most ranges; it stays in the last document only."""
    hot = "this very common licence line stands in every document of the table"
    rows = [(k, f"{hot}\n{hot} \nown line of document number {k:05d} which no other document has at all") for k in range(2000)]
    docs = table(spark, rows)
    got = {r["doc_id"]: r for r in L.digest(docs).collect()}
    assert [r["n_dropped"] for r in got.values() if r["doc_id"] < 1999] == [2] * 1999 and got[1999]["n_dropped"] == 0
    bits = {r["doc_id"]: [tuple(x) for x in r["kept"]] for r in L.keep_bitmaps(docs).collect()}
    assert len(bits) == 1999 and set(map(tuple, bits.values())) == {((2, 2),)}


def test_bitmaps_are_runs(spark):
    line = "line {} that stands in each of these documents, and it is long enough"
    texts = ["\n".join(["a", line.format(1), line.format(2), "b", "c", line.format(3)])] * 6
    rows = L.keep_bitmaps(table(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"] for r in rows} == {0, 1, 2, 3, 4}
    assert all([tuple(x) for x in r["kept"]] == [(0, 0), (3, 4)] and r["n_dropped"] == 3 for r in rows)


def test_limits_and_empty_tables(spark):
    line = "exactly five documents have to hold this line for it to go away"
    assert sum(r["n_dropped"] for r in L.digest(table(spark, [(k, line) for k in range(4)])).collect()) == 0
    assert sum(r["n_dropped"] for r in L.digest(table(spark, [(k, line) for k in range(5)])).collect()) == 4
    assert sum(r["n_dropped"] for r in L.digest(table(spark, [(1, "\n".join([line] * 9))] * 8)).collect()) == 0
    empty = table(spark, [(1, "x")]).filter("doc_id > 1")
    assert L.digest(empty).count() == 0


def test_no_python_and_own_columns(spark):
    docs = table(spark, [(1, "x\ny"), (2, None)])
    rows = L.deduped(docs)
    assert "__id" not in rows.columns and {"kept", "position", "hash"} <= set(rows.columns)
    assert {r["doc_id"]: (r["n_lines"], r["kept_text"]) for r in rows.collect()} == {1: (2, "x\ny"), 2: (1, "")}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
