"""Held-out accuracy, exactness of the index, and what scores may depend on."""

import math
import random
import zlib

import numpy as np
import pytest
from conftest import SCHEMA, prose

from cdcstrata.llm import quality as Q
from cdcstrata.llm import toxicity as T
from cdcstrata.llm.labelled import labelled_sample

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=700):
    r, docs, labels = random.Random(8), [], []
    for k in range(n):
        text, quality, toxic = prose(k, r.randint(20, 200)), 1, 0
        if k % 4 == 0:
            text, quality = " | ".join(w + "!!" for w in text.upper().split()), 0
        elif k % 5 == 0:
            words = text.split(" ")
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["vile", "nasty", "horrid", "awful", "beastly"]))
            text, toxic = " ".join(words), 1
        docs.append((k, text, "en", "s", len(text)))
        labels.append((k, quality, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    odd = [(9000, None), (9001, ""), (9002, "é" * 70_000), (9003, "vile nasty"), (9003, "vile nasty"), (None, "plain")]
    docs += [(i, t, None, None, 0) for i, t in odd]
    labels += [(5, 0, 1), (6, None, None), (None, 1, 1)]  # contradicting, empty and nameless ones teach nothing
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS)
    return frames[0].selectExpr("*", "1 AS score", "2 AS label"), frames[1].repartition(3)


def checked(rows, n, modulus, remainder):
    assert len(rows) == n
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder
        assert r["held_out"] == held and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_quality(spark, data):
    rows = Q.classify(*data).collect()
    checked(rows, 706, 5, 0)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 700]
    right = [r["predicted"] == int(r["doc_id"] % 4 != 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    assert len({r["score"] for r in rows if r["doc_id"] == 9003}) == 1
    again = {r["doc_id"]: r["score"] for r in Q.classify(data[0].repartition(4), data[1].repartition(1)).collect()}
    assert all(again[r["doc_id"]] == pytest.approx(r["score"], abs=1e-5) for r in rows)


def test_network_sees_the_whole_text(data):
    network = Q.train(([" | ".join(["BAD!!"] * 80) for _ in range(40)], [prose(k, 100) for k in range(40)]))
    clean = prose(1, 4000)
    late = clean + " " + " | ".join(["BAD!!"] * 300)
    assert network.score([late])[0] < network.score([clean])[0]
    alone = network.score([clean])[0]
    assert network.score([late, clean, None, ""])[1] == pytest.approx(alone, abs=1e-6)


def test_toxicity(spark, data):
    rows = T.score(*data).collect()
    checked(rows, 706, 4, 2)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 700]
    truth = [int(r["doc_id"] % 5 == 0 and r["doc_id"] % 4 != 0) for r in held]
    assert len(held) > 100 and np.mean([r["predicted"] == t for r, t in zip(held, truth, strict=True)]) > 0.97
    shown = [r for r in rows if r["doc_id"] == 9003]
    assert all(r["predicted"] == 1 and r["evidence"] and r["evidence"][0]["toxic"] == 1 for r in shown)
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in (9000, 9001, None))


def test_without_toxic(spark, data):
    docs, labels = data
    kept = T.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    gone = {r["doc_id"] for r in T.score(docs, labels).filter("predicted = 1").collect()}
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(
        r["doc_id"] or -1 for r in docs.collect() if r["doc_id"] not in gone
    )


@pytest.mark.parametrize("module", [Q.classify, T.score])
def test_nothing_to_learn_from(spark, data, module):
    docs, labels = data
    assert {r["score"] for r in module(docs, labels.limit(0)).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 0) for k in range(60)], LABELS)
    scores = {r["score"] for r in module(docs, one).collect()}
    assert len(scores) == 1 and (scores.pop() > 0.9) == (module is Q.classify)
    assert module(docs.limit(0), labels).collect() == []


def test_samples_keep_held_out_rows_away(spark, data):
    docs, labels = data
    sample = labelled_sample(docs, labels, "toxic", 4, 2, 50, 20_000)
    ids = [i for some in sample.ids for i in some]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids) and 5 not in ids
    assert all(len(some) <= 50 for some in sample.texts)


def test_index_is_exact():
    r = random.Random(5)
    vectors = []
    for _ in range(900):
        raw = {r.randrange(60): r.random() + 0.1 for _ in range(r.randint(0, 6))}
        length = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append(tuple(sorted((t, w / length) for t, w in raw.items())))
    index = T.BlockMaxIndex(vectors)
    for query in vectors[:150]:
        q = dict(query)
        every = sorted(((-sum(q.get(t, 0) * w for t, w in v), k) for k, v in enumerate(vectors)))
        want = [(-c, k) for c, k in every if c < 0][:7]
        got = index.nearest(query, 7)
        assert [c for c, _ in got] == pytest.approx([c for c, _ in want])
        assert T.BlockMaxIndex([]).nearest(query, 7) == []


def test_only_long_lists_have_bounds(monkeypatch):
    """A bound of a short list costs what its postings cost; long, short and common terms together stay exact."""
    r = random.Random(6)
    vectors = []
    for k in range(900):
        # Terms 0 to 9 are common, 10 to 39 have some 30 postings, most of them close together, the others a few.
        some = {r.randrange(10), 10 + (k // 30 + r.randrange(2)) % 30, *(r.randrange(40, 400) for _ in range(r.randint(0, 5)))}
        raw = {t: r.random() + 0.1 for t in some}
        length = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append(tuple(sorted((t, w / length) for t, w in raw.items())))
    held = np.bincount([t for v in vectors for t, _ in v])
    for long, lists in ((25, int(((held >= 25) & (held * T.COMMON < 900)).sum())), (10_000, 0)):
        monkeypatch.setattr(T, "LONG", long)
        index = T.BlockMaxIndex(vectors)
        assert index.most.shape == (lists, 15) and (lists > 20 or long > 900) and index.columns >= 10
        for query in vectors[::9]:
            every = sorted(((-sum(dict(query).get(t, 0) * w for t, w in v), k) for k, v in enumerate(vectors)))
            want = [(-c, k) for c, k in every if c < 0][:5]
            assert [c for c, _ in index.nearest(query, 5)] == pytest.approx([c for c, _ in want])
        together = index.nearest_all(vectors[::9], 5)
        assert together == [index.nearest(query, 5) for query in vectors[::9]]


def test_look_ups_take_no_table_of_all_terms(monkeypatch):
    """Known terms are looked up among the words of a text: its few words make the table, once for each portion."""
    sizes, look_up = [], T.pc.index_in
    monkeypatch.setattr(T.pc, "index_in", lambda asked, value_set: sizes.append(len(value_set)) or look_up(asked, value_set=value_set))
    names = sorted({f"{a}{b}{c}{d}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in ("", "xyz")})
    number = {t: k for k, t in enumerate([*names, "abcxy*"])}
    found, counts = T.Finder(T.Known(number)).columns(["abc abcxyz abc nothing", None])
    assert [dict(zip(t, c, strict=True)) for t, c in zip(found.to_pylist(), counts.to_pylist(), strict=True)] == [
        {number["abc"]: 2, number["abcxyz"]: 1, number["abcxy*"]: 1},
        {},
    ]
    assert sizes and max(sizes) <= 4


def test_workers_hold_one_model(data, monkeypatch):
    """The model goes to the tasks as a broadcast, not within a function, and is read when the worker has given back the rest."""
    sent, shipped = [], type(data[0]).mapInArrow
    monkeypatch.setattr(type(data[0]), "mapInArrow", lambda df, f, *a, **b: sent.append(f) or shipped(df, f, *a, **b))
    T.score(*data)
    T.without_toxic(*data)
    held = [c.cell_contents for f in sent for c in f.__closure__ or ()]
    assert not any(isinstance(x, T.Judge | T.Model) for x in held)
    models = [x for x in held if isinstance(x, T.Broadcast)]
    assert len(models) == 2 and all(isinstance(x.value, T.Judge) for x in models)
    steps = []
    monkeypatch.setattr(T, "give_back", lambda: steps.append("given back"))
    monkeypatch.setattr(T.Judge, "scorer", lambda self: steps.append("scorer"))
    assert list(sent[-1](iter(()))) == [] and steps == ["given back", "scorer", "given back"]


def test_rare_terms_find_their_neighbour(spark, data):
    """Words of one example alone go with no label by any ratio, yet they are what its nearest text has in common."""
    docs, labels = corpus()
    rare = "quorvix zemblat frondule wexhampt gribbolt snurvane plockett druvimor"
    taught = next(i for i in range(9100, 9200) if zlib.crc32(str(i).encode()) % 4 != 2)
    docs += [(taught, rare, None, None, 0), (9300, f"{rare} {prose(1, 3)}", None, None, 0)]
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([*labels, (taught, 1, 1)], LABELS)
    row = T.score(*frames).filter("doc_id = 9300").first()
    assert row["evidence"][0]["doc_id"] == taught and row["evidence"][0]["cosine"] > 0.8 and row["predicted"] == 1
    assert 9300 not in {r["doc_id"] for r in T.without_toxic(*frames).collect()}


def test_terms_of_many_texts_are_those_of_each(odd_texts):
    texts = [*odd_texts, "²½ ab² İstanbul ΣΑΣ 日本語 a_b1c Straße", "one " * 50, "x1y2z3", "*"]
    number = {t: k for k, t in enumerate(sorted({t for x in texts[::2] for t in T.terms(x)}))}
    for chars in (10, 4_000_000):
        finder = T.Finder(T.Known(number))
        finder.CHARS = chars
        found, counts = finder.columns(texts)
        each = [dict(zip(t.as_py(), c.as_py(), strict=True)) for t, c in zip(found, counts, strict=True)]
        assert each == [T.hits(number, x) for x in texts]
    none, _ = T.Finder(T.Known({})).columns([None, "a"])
    assert none.to_pylist() == [[], []] and T.Finder(T.Known(number)).columns([])[0].to_pylist() == []


def test_a_sample_has_one_text_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, "other")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 0, 0)], LABELS)
    found = labelled_sample(docs, labels, "toxic", 4, 9, 50, 20_000)
    assert found.texts == (["other"], ["text 0"]) and found.ids == ([2], [1])
