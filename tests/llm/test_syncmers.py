"""Closed syncmers against a direct reading of their definition."""

import hashlib

from conftest import prose

from cdcstrata.llm import syncmers


def compared(df):
    return {r["doc_id"]: r for r in syncmers.compared(df).collect()}


def test_edited_texts_and_order(spark, make_docs, odd_texts):
    docs = make_docs(odd_texts)
    found = compared(docs.repartition(5))
    texts = [x or "" for x in odd_texts]
    assert sorted(found) == list(range(len(texts)))
    for k, text in enumerate(texts):
        after, half = texts[(k + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert found[k]["n_chars"] == len(text)
        assert found[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[k]["near_edited"] <= 1 and 0 <= found[k]["near_next"] <= 1
    assert found[5]["fingerprint"] == found[6]["fingerprint"] != found[8]["fingerprint"]
    assert found[0]["fingerprint"] == found[1]["fingerprint"] == ""
    assert found[5]["near_next"] == 1.0 and found[6]["near_next"] > 0.7 and found[7]["near_next"] < 0.1


def test_anchors_are_closed_syncmers(spark, make_docs):
    """Whatever the hash, k-mers are chosen by themselves: a passage has its anchors in any surroundings."""
    passage = prose(3, 80)
    docs = make_docs([passage, prose(4, 33) + " " + passage + " " + prose(5, 50)])
    rows = syncmers.anchor_positions(docs).collect()
    alone = {(r["hash"], r["position"]) for r in rows if r["doc_id"] == 0}
    inside = {(r["hash"], r["position"] - 33) for r in rows if r["doc_id"] == 1}
    assert alone and alone <= inside
    # Of four inner hashes the least is the first or last one for half of all k-mers.
    assert 0.3 < len(alone) / 76 < 0.7
    # In any four k-mers in a row one is chosen.
    places = sorted(p for _, p in alone)
    assert all(b - a <= syncmers.K - syncmers.S + 1 for a, b in zip(places, places[1:], strict=False))


def test_sketch_estimates_jaccard(spark, make_docs):
    words = prose(6, 2000).split(" ")
    docs = make_docs([" ".join(words), " ".join(words[:1000] + prose(7, 1000).split(" "))])
    found = compared(docs)
    assert abs(found[0]["near_next"] - 1 / 3) < 0.2


def test_edges(spark, make_docs):
    assert syncmers.compared(make_docs([])).collect() == []
    one = compared(make_docs(["alpha beta gamma delta epsilon zeta"]))[0]
    assert one["near_next"] == 1.0
    twice = make_docs([(1, "a b c d e f"), (1, "a b c d e f"), (None, "x y"), (7, None)], ["1 AS key", "'z' AS kept", "2 AS home"])
    rows = syncmers.compared(twice).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "1", "7", "None"]
    assert {r["near_next"] for r in rows if r["doc_id"] == 1} == {1.0, 0.0}


def test_plan_is_native_and_shuffles_texts_once(spark, make_docs, odd_texts):
    plan = syncmers.compared(make_docs(odd_texts))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange ") == 1  # of either kind


def _hash(values, seed=42):
    """Spark's xxhash64: each value hashed with the hash before it as seed; text as UTF-8, numbers as eight bytes, int as four."""
    import struct

    import xxhash

    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed % 2**64)
    return seed - 2**64 if seed >= 2**63 else seed


def plain(text):
    """Anchors of a text by the definition: (distinct hashes, anchors with their place)."""
    import re

    pieces = re.findall(r"[\u4e00-\u9fff\u3040-\u30ff]|[^\s\u4e00-\u9fff\u3040-\u30ff]{1,24}", text or "")
    hashes = [_hash([p]) for p in pieces]
    if not pieces:
        return set(), set()
    inner = [_hash(hashes[i : i + 2]) for i in range(len(hashes) - 1)]
    found = []
    for i in range(len(pieces) - 4):
        four = inner[i : i + 4]
        if min(four) in (four[0], four[3]):  # the least inner substring lies at an edge
            found.append((i, (_hash([inner[i], inner[i + 2], hashes[i + 4]]) % 2**64) >> 32))
    if not found:
        return {(_hash(hashes) % 2**64) >> 32}, set()
    return {h for _, h in found}, set(found)


def test_against_the_definition(spark, make_docs, odd_texts):
    texts = [*odd_texts, "a b c d e f g h " * 30, "日本 語テキスト one two three four five six seven"]
    rows = {r["doc_id"]: r for r in syncmers.compared(make_docs(texts)).collect()}
    n = len(texts)
    for k in range(n):
        own, following = texts[k] or "", texts[(k + 1) % n] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        (a, at), (b, bt), (c, _) = plain(own), plain(edited), plain(following)

        def near(x, y):
            if not x and not y:
                return 1.0
            x, y = set(sorted(x)[:64]), set(sorted(y)[:64])
            least = set(sorted(x | y)[:64])
            return len(x & y & least) / len(least)

        r = rows[k]
        assert r["fingerprint"] == "".join(f"{h:08x}" for h in sorted(a)[:64])
        assert r["edited_fingerprint"] == "".join(f"{h:08x}" for h in sorted(b)[:64])
        assert (r["near_edited"], r["near_next"]) == (near(a, b), near(a, c))
        assert (r["n_anchors"], r["placed_edited"]) == (len(a), len(at & bt))
