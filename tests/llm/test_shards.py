"""Differencing against brute force, and the laws of the shards."""

import itertools
import random
import zlib

from conftest import prose

from cdcstrata.llm import shards as S


def test_differencing_is_near_the_best():
    r = random.Random(4)
    for _ in range(30):
        sizes = {f"i{k}": r.randint(1, 99) for k in range(9)}
        found = S.karmarkar_karp(sizes, 3)
        sums = [sum(v for k, v in sizes.items() if found[k] == s) for s in range(3)]
        best = min(
            max(sum(v for v, s in zip(sizes.values(), way, strict=True) if s == k) for k in range(3))
            for way in itertools.product(range(3), repeat=9)
        )
        assert sorted(found) == sorted(sizes) and max(sums) <= 1.15 * best


def test_differencing_combines_opposite_orders():
    # 8, 7, 6, 5, 4 in two parts: the differences are 1, then 6 - 1 - ..., and end at 2, as by hand.
    found = S.karmarkar_karp({"a": 8, "b": 7, "c": 6, "d": 5, "e": 4}, 2)
    sums = [sum(v for k, v in {"a": 8, "b": 7, "c": 6, "d": 5, "e": 4}.items() if found[k] == s) for s in (0, 1)]
    assert sorted(sums) == [14, 16]
    assert S.karmarkar_karp({}, 4) == {} and set(S.karmarkar_karp({"a": 3}, 4).values()) == {3}


def test_balance_and_groups(spark, make_docs, odd_texts):
    texts = [*odd_texts, *[prose(k, 40) for k in range(400)], *["same text"] * 50]
    rows = S.assign(make_docs(texts, ["1 AS shard", "2 AS slot", "'g' AS `group`", "3 AS bin"]).repartition(7)).collect()
    assert len(rows) == len(texts)
    sums, slots, homes = [0] * 8, {}, {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sums[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault(raw, set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(raw) + 1 for raw in homes)
    # The long text fills most of a shard; the others share the rest evenly.
    assert max(sums) - min(sums) <= max(600, largest - (sum(sums) - largest) // 7 + 600)


def test_a_third_in_one_group(spark, make_docs):
    texts = ["copy " * 100] * 150 + [prose(k, 60) for k in range(399)]  # 57 for each of the other seven
    rows = S.assign(make_docs(texts)).collect()
    sums = [0] * 8
    for r in rows:
        sums[r["shard"]] += r["size"]
    top = sorted(sums)
    assert top[-1] == 150 * 501  # the group alone, as nothing can be taken from it
    assert top[-2] - top[0] < 50


def test_repeats_and_empty(spark, make_docs):
    assert S.assign(make_docs([])).collect() == []
    rows = S.assign(make_docs([(1, "a"), (1, "a"), (None, None), (None, "")])).collect()
    assert sorted(r["size"] for r in rows) == [1, 1, 2, 2]
    assert len({r["shard"] for r in rows if r["size"] == 1}) == 1
    assert sorted(r["slot"] for r in rows if r["size"] == 1) == [0, 1]


def test_written_shards(spark, make_docs, odd_texts, tmp_path):
    path = S.write_shards(make_docs(odd_texts), str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(path).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in back) == [(k, x or "") for k, x in enumerate(odd_texts)]
