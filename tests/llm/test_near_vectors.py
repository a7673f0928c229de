"""Graph search against all pairs."""

import numpy as np
import pytest

from cdcstrata.llm import near_vectors as N
from cdcstrata.llm.hnsw import Graph


def clustered(n, d=16, seed=1, spread=0.15):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 12), d))
    return centres[r.integers(0, len(centres), n)] + spread * r.normal(size=(n, d))


def brute(rows):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if label is None or v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok[k] = (label, N._unit(np.array([v], float))[0])
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= N.LEAST]
    root = {k: rows[k][0] for k in range(len(rows))}
    for _ in range(12):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return [(rows[k][0], sum(k in p for p in links), root[k], root[k] == rows[k][0]) for k in range(len(rows))]


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 AS key", "2 AS shard")
    return sorted(tuple(r) for r in N.near_duplicates(df.repartition(3)).collect())


@pytest.fixture(scope="module")
def rows():
    made = [(k, v.tolist(), k % 3) for k, v in enumerate(clustered(600))]
    made += [(1000 + k, made[5][1], 2) for k in range(30)]  # copies
    made += [(1100, [2 * x for x in made[5][1]], 2), (1101, [1e200 * x for x in made[5][1]], 2)]
    made += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] + [1.0] * 15, 1)]
    made += [(2005, [float("inf")] + [1.0] * 15, 1), (2006, made[4][1], None), (2007, made[4][1][:8], 1), (2008, made[4][1][:8], 1)]
    return made


def test_equals_all_pairs(spark, rows):
    assert result(spark, rows) == sorted(brute(rows))


def test_every_shard_is_queried(spark, rows, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 60)
    assert result(spark, rows) == sorted(brute(rows))


def test_recall_of_graph():
    vectors = N._unit(clustered(3000, seed=4))
    graph = Graph.build(vectors)
    sought = vectors @ vectors.T >= N.LEAST
    hit = sum(len(graph.within(v, N.LEAST, N.BEAM)) for v in vectors)
    assert hit <= sought.sum() and hit / sought.sum() >= 0.99
    again = Graph.of(*graph.parts().values())
    assert sorted(again.within(vectors[7], N.LEAST, 32)) == sorted(graph.within(vectors[7], N.LEAST, 32))


def test_audit_widens_to_brute_force():
    """Where the graph finds too little, here as its links are gone, the beam grows until all is compared."""
    vectors = N._unit(clustered(300, seed=6))
    graph = Graph.build(vectors)
    graph.layers = [np.full_like(layer, -1) for layer in graph.layers]
    found, beam = N.audited_links(graph, graph)
    assert found == N._brute(graph, graph) and beam >= 300


def test_audit_sees_beside_a_hot_group():
    """A third of the vectors is one group; all pairs beside it are out of the graph's reach and must be found all the same."""
    r = np.random.default_rng(3)
    hot = r.normal(size=24) + 0.1 * r.normal(size=(1000, 24))
    pairs = np.repeat(r.normal(size=(1000, 24)), 2, axis=0) + 0.05 * r.normal(size=(2000, 24))
    vectors = N._unit(np.concatenate([hot, pairs]))
    built = Graph.build(vectors[:1000])
    layers = [np.concatenate([x, np.full((2000, x.shape[1]), -1, x.dtype)]) for x in built.layers]
    graph = Graph(vectors, layers, built.entry)
    sampled = vectors[np.linspace(0, len(vectors) - 1, 96).astype(int)]
    pooled = sum(len(graph.within(q, N.LEAST, N.BEAM)) for q in sampled) / (sampled @ vectors.T >= N.LEAST).sum()
    assert pooled >= N.AUDIT  # what a figure over all links would say
    found, beam = N.audited_links(graph, graph)
    assert found == N._brute(graph, graph) and beam > N.BEAM


def test_repeats_and_empty(spark):
    v = [1.0, 2.0]
    assert result(spark, [(1, v, 0), (1, v, 0), (1, None, 0), (2, [2.0, 4.0], 0)]) == [
        (1, 0, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert result(spark, []) == []


def test_a_shard_of_near_vectors_fits(monkeypatch):
    """All pairs of 4,096 distinct vectors around one centre are linked; they are held as bits."""
    import resource

    r = np.random.default_rng(5)
    vectors = N._unit(r.normal(size=16) + 0.01 * r.normal(size=(4096, 16)))
    graph = Graph(vectors, [np.full((4096, 8), -1)], 0)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = N._brute(graph, graph)
    found.without_self()
    ones = np.ones(4096, np.int64)
    rows, columns = found.counts(ones, ones)
    assert (rows == 4095).all() and (columns == 4095).all()
    x, y = found.forest(True)
    assert len(x) == 4095 and len(set(y.tolist()) | {0}) == 4096
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # kB


@pytest.mark.parametrize("same", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_forest_connects_what_the_links_connect(same, seed):
    r = np.random.default_rng(seed)
    n, m = (60, 60) if same else (60, 45)
    dense = r.random((n, m)) < 0.02
    if same:
        dense = dense | dense.T
        np.fill_diagonal(dense, False)
    links = N.Links(n, m)
    for k in range(n):
        links.add(k, np.flatnonzero(dense[k]))
    assert (links.rows(slice(0, n)) == dense).all()

    def parts(pairs):
        label = {(s, k): (s, k) for s, size in ((0, n), (1 - same, m)) for k in range(size)}
        for _ in range(n + m):
            for x, y in pairs:
                a, b = (0, x), (1 - same, y)
                label[a] = label[b] = min(label[a], label[b])
        return label

    x, y = links.forest(same)
    assert all(dense[a, b] for a, b in zip(x, y, strict=True))
    assert parts(list(zip(x.tolist(), y.tolist(), strict=True))) == parts(list(zip(*map(lambda v: v.tolist(), np.nonzero(dense)), strict=True)))


def test_labels_of_other_types(spark):
    rows = [(1, [1.0, 0.1], "a"), (2, [1.0, 0.1001], "a"), (3, [1.0, 0.1], "b"), (4, [1.0, 0.1], None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    assert {r["vec_id"]: r["component_id"] for r in N.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
