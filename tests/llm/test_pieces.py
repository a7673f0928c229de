"""The max-plus scan against the library's encoding of whole texts."""

import random

import pytest
from conftest import prose

from cdcstrata.llm import pieces as P
from cdcstrata.llm.vocabularies import vocabulary

MODEL = vocabulary("piece_bpe_32k.model")
PARTS = ["the quick ", "aaaa", "ab", "  ", "   ", "\n", "日本語", "é", "😀", "\t", "function()", " return ", "==", "x", "12", "ing", "▁"]


@pytest.fixture(scope="module")
def model():
    return P.Pieces(MODEL)


def scanned(model, text, size):
    windows = P.cut(model, text, size)
    if not windows:
        return []
    known = P.scan([P.transfer(model, *w) for w in windows])
    return [i for w, (a, b) in zip(windows, known, strict=True) for i in P.trace(model, *w, a, b)]


@pytest.mark.parametrize("size", [5, 17, 40, 200])
def test_scan_equals_library(model, size):
    r, library = random.Random(size), P._library(MODEL)
    for _ in range(150):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(0, 60)))
        assert scanned(model, text, size) == library.encode(text), text


def test_products_are_associative(model):
    windows = P.cut(model, prose(1, 200), 100)
    a, b, c = (P.transfer(model, *w) for w in windows[:3])
    left, right = P.product(P.product(a, b), c), P.product(a, P.product(b, c))
    assert left[:2] == right[:2] and (left[2] == right[2]).all()


def test_spark_path(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts, ["1 AS key", "2 AS chunk", "3 AS ids"])
    library = P._library(MODEL)
    rows = P.encode(docs, MODEL, giant=1500, chunk=400).collect()
    assert len(rows) == len(odd_texts)
    for r in rows:
        text = odd_texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode(text) and r["n_ids"] == len(r["ids"]) and r["n_chars"] == len(text)
        assert r["round_trip"] == ("▁" not in text)
    back = P.decode(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in rows], "doc_id bigint, ids array<int>"), MODEL)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {k: x or "" for k, x in enumerate(odd_texts)}


def test_repeated_giants_and_empty_table(spark, make_docs):
    long = prose(3, 600)
    rows = P.encode(make_docs([(4, long), (4, long), (None, long)]), MODEL, giant=1000, chunk=300).collect()
    assert len(rows) == 3 and len({tuple(r["ids"]) for r in rows}) == 1
    assert P.encode(make_docs([]), MODEL).collect() == []
