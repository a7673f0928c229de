"""The chosen-path join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import prose

from cdcstrata.llm import near_texts as N
from cdcstrata.llm.components import connected_components
from cdcstrata.llm.shingles import shingle_sets


def sets_of(texts):
    out = {}
    for k, t in texts:
        w = (t or "").lower().split()
        out[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute(texts):
    sets = sets_of(texts)
    ids = list(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    root = {k: k for k in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {k: (root[k], sum(k in pair for pair in links)) for k in ids}


def edited(text, n, seed):
    r, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(odd_texts):
    line = prose(99, 60)  # stands in many texts
    texts = list(odd_texts)
    for k in range(25):
        base = prose(1000 + k, 40 + 10 * k)
        texts += [base, base.upper(), edited(base, 1, k), edited(base, 1 + k // 12, k + 50), base + " and one more end"]
    texts += [prose(2000 + k, 60) + " " + line for k in range(90)]
    base = prose(3000, 400)
    texts += [edited(base, 3, 4000 + k) for k in range(130)]  # more than a small bucket of near copies
    return list(enumerate(texts))


def test_equals_all_pairs(spark, make_docs, corpus):
    rows = N.jaccard_join(make_docs(corpus, ["1 AS n", "'k' AS set_key", "2 AS bucket"]).repartition(5)).collect()
    want = brute(corpus)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == want
    assert len({r["class_id"] for r in rows}) < len(rows) - 150


@pytest.mark.parametrize("medium", [9, 60, 4096])
def test_blocks_of_big_groups(spark, make_docs, corpus, monkeypatch, medium):
    """Groups in several blocks, and buckets that no level splits."""
    monkeypatch.setattr(N, "BLOCK", 20)
    monkeypatch.setattr(N, "SMALL", 8)
    monkeypatch.setattr(N, "SKETCH_BLOCK", 30)
    monkeypatch.setattr(N, "MEDIUM", medium)
    some = corpus[-150:]
    rows = N.jaccard_join(make_docs(some)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == brute(some)


def test_edges(spark, make_docs):
    assert N.jaccard_join(make_docs([])).collect() == []
    long = prose(5, 50)
    rows = N.jaccard_join(make_docs([(3, long), (3, long), (9, edited(long, 1, 1)), (None, long), (4, None), (5, ""), (3, "other text")])).collect()
    got = sorted((str(r["doc_id"]), r["class_id"], r["n_links"]) for r in rows)
    # Rows of one doc_id are united; the nameless row is compared with nothing.
    assert got == [("3", 3, 0), ("3", 3, 2), ("3", 3, 2), ("4", 4, 0), ("5", 5, 0), ("9", 3, 2), ("None", None, 0)]


def test_exact_links_and_sides():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 40, 30).astype(np.uint64)) for _ in range(60)]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60)
            if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(*map(list, N.exact_links(sets)), strict=True)) == want
    sides = np.arange(60) % 2
    assert set(zip(*map(list, N.exact_links(sets, sides)), strict=True)) == {(i, j) for i, j in want if (i + j) % 2}


def test_sketches_estimate():
    r = np.random.default_rng(5)
    for share in (0.3, 0.8, 1.0):
        a = r.integers(0, 2**63, 3000).astype(np.uint64)
        b = a.copy()
        keep = int(2 * share / (1 + share) * len(a))
        b[keep:] = r.integers(0, 2**63, len(a) - keep).astype(np.uint64)
        assert abs(N.estimates(N.sketch(a), N.sketch(b)) - share) < 0.25
    assert N.runs(0.999) == 2


def test_choices_agree_as_often_as_sets():
    r = np.random.default_rng(7)
    pairs = []
    for _ in range(400):
        a = np.unique(r.integers(0, 2**63, 90).astype(np.uint64))
        b = np.unique(np.concatenate([a[:80], r.integers(0, 2**63, 10).astype(np.uint64)]))
        pairs += [a, b]
    taken = N.choices([*pairs, np.empty(0, np.uint64)], 2)
    assert taken.shape == (801, 2 * N.LEVELS * N.BRANCHES)
    assert abs((taken[0:800:2] == taken[1:800:2]).mean() - 0.8) < 0.02


def test_shingles():
    sets = shingle_sets(pa.array(["a b c d e f", " A  b c d e\tF ", "a b", None, "", "b a"]))
    assert (sets[0] == sets[1]).all() and len(sets[0]) == 2
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 1] and sets[2][0] != sets[5][0]


def test_components(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(100 + r.randrange(80), 100 + r.randrange(80)) for _ in range(70)]
    links += [(500, 200 + k) for k in range(90)] + [(7, 7)]
    root = {}
    for a, b in links:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    got = {row["node"]: row["component"] for row in connected_components(df).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k in linked}
