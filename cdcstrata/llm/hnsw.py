"""A hierarchical navigable small-world graph over unit vectors, in numpy.

A search keeps a beam of the best vectors seen and opens, round by round, all of the beam that is not opened yet;
their unseen neighbours are compared in one product. It ends when the whole beam is opened.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LINKS = 12  # per vector on the upper layers, twice as many on the lowest
BUILD_BEAM = 48


@dataclass
class Graph:
    vectors: np.ndarray  # (n, d), rows of length one
    layers: list[np.ndarray] = field(default_factory=list)  # per layer (n, width): neighbours, -1 where there is none
    entry: int = -1

    def __post_init__(self) -> None:
        self._seen = np.zeros(len(self.vectors) + 1, np.int64)  # the last place takes the -1s
        self._turn = 0

    # --- search ---------------------------------------------------------------------------------

    def _fresh(self, nodes: np.ndarray) -> np.ndarray:
        """Those of the nodes that this turn has not seen yet, now seen."""
        nodes = nodes[self._seen[nodes] != self._turn]
        if len(nodes) > 1:
            nodes = np.unique(nodes)
        self._seen[nodes] = self._turn
        return nodes

    def _begin(self, nodes: np.ndarray) -> None:
        self._turn += 1
        self._seen[-1] = self._turn
        self._seen[nodes] = self._turn

    def _beam(self, query: np.ndarray, start: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes that the beam comes to, and their cosines, best first."""
        links = self.layers[layer]
        self._begin(start)
        nodes, cosines = start, self.vectors[start] @ query
        opened = np.zeros(len(nodes), bool)
        while not opened.all():
            new = self._fresh(links[nodes[~opened]].ravel())
            opened[:] = True
            if not len(new):
                break
            nodes = np.concatenate([nodes, new])
            cosines = np.concatenate([cosines, self.vectors[new] @ query])
            opened = np.concatenate([opened, np.zeros(len(new), bool)])
            if len(nodes) > beam:
                best = np.argpartition(-cosines, beam - 1)[:beam]
                nodes, cosines, opened = nodes[best], cosines[best], opened[best]
        order = np.argsort(-cosines, kind="stable")
        return nodes[order], cosines[order]

    def search(self, query: np.ndarray, beam: int, bottom: int = 0) -> tuple[np.ndarray, np.ndarray]:
        start = np.array([self.entry])
        for layer in range(len(self.layers) - 1, bottom, -1):
            start = self._beam(query, start, layer, 1)[0][:1]
        return self._beam(query, start, bottom, beam)

    def within(self, query: np.ndarray, least: float, beam: int, slack: float = 0.03) -> np.ndarray:
        """Nodes whose cosine is at least ``least``: from the beam's end, the graph is flooded as far as it stays near."""
        nodes, cosines = self.search(query, beam)
        self._begin(nodes)
        found = [nodes[cosines >= least]]
        front = nodes[cosines >= least - slack]
        while len(front):
            front = self._fresh(self.layers[0][front].ravel())
            cosines = self.vectors[front] @ query
            found.append(front[cosines >= least])
            front = front[cosines >= least - slack]
        return np.concatenate(found)

    # --- construction ---------------------------------------------------------------------------

    def _chosen(self, node_vector: np.ndarray, nodes: np.ndarray, cosines: np.ndarray, most: int) -> np.ndarray:
        """Neighbours that are nearer to the node than to each other, filled up with the nearest rest."""
        if len(nodes) <= most:
            return nodes
        nodes, cosines = nodes[: 3 * most], cosines[: 3 * most]
        mutual = self.vectors[nodes] @ self.vectors[nodes].T
        kept: list[int] = []
        nearest = np.full(len(nodes), -2.0)
        for k in range(len(nodes)):
            if nearest[k] < cosines[k]:
                kept.append(k)
                if len(kept) == most:
                    break
                np.maximum(nearest, mutual[k], out=nearest)
        rest = [k for k in range(len(nodes)) if k not in set(kept)][: most - len(kept)]
        return nodes[kept + rest]

    def _link(self, layer: int, node: int, to: np.ndarray) -> None:
        links = self.layers[layer]
        width = links.shape[1]
        links[node, : len(to)] = to
        for other in to.tolist():
            own = links[other]
            used = int((own >= 0).sum())
            if used < width:
                own[used] = node
                continue
            known = np.append(own, node)
            cosines = self.vectors[known] @ self.vectors[other]
            order = np.argsort(-cosines, kind="stable")
            chosen = self._chosen(self.vectors[other], known[order], cosines[order], width)
            own[:] = -1
            own[: len(chosen)] = chosen

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 5) -> Graph:
        graph = cls(vectors)
        n = len(vectors)
        heights = (-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        top = -1
        for node in range(n):
            height = int(heights[node])
            while len(graph.layers) <= height:
                width = LINKS if graph.layers else 2 * LINKS
                graph.layers.append(np.full((n, width), -1, np.int32))
            if graph.entry >= 0:
                query = vectors[node]
                start = np.array([graph.entry])
                for layer in range(top, -1, -1):
                    nodes, cosines = graph._beam(query, start, layer, BUILD_BEAM if layer <= height else 1)
                    if layer <= height:
                        graph._link(layer, node, graph._chosen(query, nodes, cosines, LINKS))
                    start = nodes[:1]
            if height > top:
                graph.entry, top = node, height
        return graph

    # --- as bytes -------------------------------------------------------------------------------

    def parts(self) -> dict[str, bytes | int]:
        return {
            "n": len(self.vectors),
            "entry": self.entry,
            "vectors": self.vectors.astype("<f8").tobytes(),
            "layers": [layer.astype("<i4").tobytes() for layer in self.layers],
        }

    @classmethod
    def of(cls, n: int, entry: int, vectors: bytes, layers: list[bytes]) -> Graph:
        read = [np.frombuffer(x, "<i4").reshape(n, -1) for x in layers]
        return cls(np.frombuffer(vectors, "<f8").reshape(n, -1), read, entry)
