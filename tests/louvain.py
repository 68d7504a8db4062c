"""Louvain communities of a small graph, without Spark: what the library's communities are held against."""

import numpy as np


def modularity(edges: list[tuple[int, int, float]], label: list[int], resolution: float = 1.0) -> float:
    total = sum(w for _, _, w in edges)
    inside: dict[int, float] = {}
    degree: dict[int, float] = {}
    for a, b, w in edges:
        degree[label[a]] = degree.get(label[a], 0) + w
        degree[label[b]] = degree.get(label[b], 0) + w
        if label[a] == label[b]:
            inside[label[a]] = inside.get(label[a], 0) + w
    return sum(inside.get(c, 0) / total - resolution * (d / (2 * total)) ** 2 for c, d in degree.items()) if total else 0.0


def louvain(n: int, edges: list[tuple[int, int, float]], resolution: float = 1.0, seed: int = 42) -> list[int]:
    """Community of each of n nodes: local moves that raise modularity, then the same on the graph of communities."""
    rng = np.random.default_rng(seed)
    own = list(range(n))
    graph: list[dict[int, float]] = [{} for _ in range(n)]
    loops = [0.0] * n
    for a, b, w in edges:
        graph[a][b] = graph[a].get(b, 0) + w
        graph[b][a] = graph[b].get(a, 0) + w
    total = sum(w for _, _, w in edges)
    while total:
        size = len(graph)
        degree = [sum(g.values()) + 2 * x for g, x in zip(graph, loops, strict=True)]
        community, weight = list(range(size)), degree[:]
        moved = any_move = True
        any_move = False
        while moved:
            moved = False
            for v in rng.permutation(size).tolist():
                near: dict[int, float] = {}
                for u, w in graph[v].items():
                    near[community[u]] = near.get(community[u], 0) + w
                old = community[v]
                weight[old] -= degree[v]
                gain = lambda c: near.get(c, 0) - resolution * weight[c] * degree[v] / (2 * total)  # noqa: B023, E731
                best = max(sorted(near), key=gain, default=old)
                if gain(best) <= gain(old) + 1e-12:
                    best = old
                weight[best] += degree[v]
                if best != old:
                    community[v], moved, any_move = best, True, True
        if not any_move:
            break
        names = {c: k for k, c in enumerate(sorted(set(community)))}
        merged: list[dict[int, float]] = [{} for _ in names]
        inner = [0.0] * len(names)
        for v in range(size):
            c = names[community[v]]
            inner[c] += loops[v]
            for u, w in graph[v].items():
                if u > v:
                    d = names[community[u]]
                    if c == d:
                        inner[c] += w
                    else:
                        merged[c][d] = merged[c].get(d, 0) + w
                        merged[d][c] = merged[d].get(c, 0) + w
        own = [names[community[c]] for c in own]
        graph, loops = merged, inner
    return own
