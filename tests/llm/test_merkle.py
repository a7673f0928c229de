"""The manifest against a plain climb over lists, and tampering."""

import hashlib
import random
import zlib

import pytest
from conftest import SCHEMA, prose

from cdcstrata.llm import merkle as M


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Levels of digests, from the leaves to the one that is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        here = levels[-1]
        levels.append([H("".join(here[i : i + 16])) for i in range(0, len(here), 16)])
    return levels


def siblings(levels, at):
    """(left, right) of each level up to the root."""
    out = []
    for level in levels[:-1]:
        run = at // 16 * 16
        out.append((level[run:at], level[at + 1 : run + 16]))
        at //= 16
    return out


def plain(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(by_source[s], key=lambda x: x[:3]),) for s in names}
    for s in names:
        trees[s] += (climb([x[2] for x in trees[s][0]]),)
    top = climb([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        ordered, levels = trees[s]
        for at, (_, _, leaf, r) in enumerate(ordered):
            path = siblings(levels, at) + siblings(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf_of(r, r[1].translate(lower)) if hit and r[1] is not None else leaf
            for left, right in path:
                h = H("".join([*left, h, *right]))
            proof = H("".join(x for left, right in path for x in [*left, *right]))
            out.append((r[0], leaf, levels[-1][0], top[-1][0], proof, h, h == top[-1][0]))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 700])
def test_equals_a_plain_climb(spark, n):
    r = random.Random(n)
    rows = [
        (k if k % 50 else None, r.choice([None, "", "A b C", prose(k, 30).title(), "Ünï" * 9]), "en", "hot" if k % 3 else None, k)
        for k in range(n)
    ]
    rows += rows[:3] * 2  # repeated rows
    rows += [(10**12 + k, "Solo", None, f"s{k:02d}ü", None) for k in range(min(n, 40))]  # more sources than a run
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "'x' AS path", "2 AS rank").repartition(5)
    got = [tuple(x) for x in M.verified(docs).collect()]
    assert sorted(got, key=key) == sorted(plain(rows), key=key)


def test_a_tree_of_more_than_one_round(spark, make_docs):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('Text ', id) AS text", "'en' AS lang", "'one' AS source", "id AS n_chars")
    rows = M.verified(docs).collect()
    assert len(rows) == 9000 and len({r["root"] for r in rows}) == 1
    levels = climb([r["leaf"] for r in sorted(rows, key=lambda r: r["doc_id"])])
    assert len(levels) == 5 and levels[-1][0] == rows[0]["root"] == rows[0]["subroot"]
    changed = {r["doc_id"] for r in rows if not r["verified"]}
    assert changed == {k for k in range(9000) if zlib.crc32(str(k).encode()) % 5 == 0}


def test_blocks_stay_small(spark):
    """A row nests at most 256 leaves, however many a source has."""
    nodes = spark.range(3000).selectExpr("'one' AS tree", "id AS rank", "3000L AS n", "sha2(string(id), 256) AS hash", "id AS item")
    sizes = M._rolled(nodes).selectExpr("aggregate(kids, 0, (a, k) -> a + size(k.kids)) AS n").collect()
    assert sum(r["n"] for r in sizes) == 3000 and max(r["n"] for r in sizes) == M.BLOCK
