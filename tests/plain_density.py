"""HDBSCAN by a plain program over all distances: what the distributed one is tested against."""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np

MIN_SIZE, MIN_SAMPLES, METHOD = 15, 5, "eom"


def _core(points: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
    """Distance of each point to its k-th nearest of the others."""
    out = np.empty(len(points))
    for a in range(0, len(points), 512):
        d = np.sqrt(np.maximum(0, ((points[a : a + 512, None, :] - others[None, :, :]) ** 2).sum(-1)))
        out[a : a + 512] = np.partition(d, min(k, len(others)) - 1, axis=1)[:, min(k, len(others)) - 1]
    return out


def spanning_tree(points: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    """Edges of a least spanning tree under mutual reachability, shortest first (Prim, memory in proportion to points)."""
    n = len(points)
    reach, parent, open_ = np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    now, edges = 0, []
    for _ in range(n - 1):
        open_[now] = False
        d = np.maximum(np.sqrt(((points - points[now]) ** 2).sum(1)), np.maximum(core, core[now]))
        closer = open_ & (d < reach)
        reach[closer], parent[closer] = d[closer], now
        now = int(np.argmin(np.where(open_, reach, np.inf)))
        edges.append((float(reach[now]), int(parent[now]), now))
    return sorted(edges)


def condensed(edges: list[tuple[float, int, int]], n: int, min_size: int) -> tuple[dict[int, list], dict[int, float]]:
    """Children of each cluster, (child, lambda, size) with points below n, and the lambda at which each cluster is born."""
    root_of, left, right, height, size = list(range(2 * n - 1)), {}, {}, {}, [1] * n + [0] * (n - 1)

    def find(x: int) -> int:
        while root_of[x] != x:
            root_of[x] = root_of[root_of[x]]
            x = root_of[x]
        return x

    for i, (d, a, b) in enumerate(edges):
        node, x, y = n + i, find(a), find(b)
        left[node], right[node], height[node] = x, y, d
        size[node] = size[x] + size[y]
        root_of[x] = root_of[y] = node

    def leaves(node: int) -> Iterator[int]:
        todo = [node]
        while todo:
            x = todo.pop()
            if x < n:
                yield x
            else:
                todo += [left[x], right[x]]

    children: dict[int, list] = defaultdict(list)
    born, following = {n: 0.0}, n + 1
    todo = [(2 * n - 2, n)]
    while todo:
        node, cluster = todo.pop()
        if node < n:
            continue
        lam = 1 / height[node] if height[node] > 0 else np.inf
        parts = [left[node], right[node]]
        large = [x for x in parts if size[x] >= min_size]
        for x in parts:
            if len(large) == 2:
                born[following] = lam
                children[cluster].append((following, lam, size[x]))
                todo.append((x, following))
                following += 1
            elif x in large:
                todo.append((x, cluster))
            else:
                children[cluster] += [(p, lam, 1) for p in leaves(x)]
    return children, born


def hdbscan(points: np.ndarray, min_size: int = MIN_SIZE, min_samples: int | None = MIN_SAMPLES, method: str = METHOD) -> tuple[np.ndarray, np.ndarray]:
    """Label (-1 is noise) and membership of each point."""
    n = len(points)
    labels, strength = np.full(n, -1), np.zeros(n)
    if n < max(2, min_size):
        return labels, strength
    core = _core(points, points, min_samples or min_size)
    children, born = condensed(spanning_tree(points, core), n, min_size)
    finite = max([lam for kids in children.values() for _, lam, _ in kids if np.isfinite(lam)], default=1.0)
    cap = lambda lam: min(lam, finite)
    stability = {c: sum((cap(lam) - cap(born[c])) * k for _, lam, k in children[c]) for c in born}
    chosen: set[int] = set()
    inner = {c: [x for x, _, _ in children[c] if x >= n] for c in born}
    best: dict[int, float] = {}
    for c in sorted(born, reverse=True):  # children have larger numbers
        below = sum(best[x] for x in inner[c])
        if c == n:
            best[c] = below  # the root is no cluster
        elif method == "leaf":
            best[c] = stability[c]
            if not inner[c]:
                chosen.add(c)
        elif stability[c] >= below or not inner[c]:
            best[c] = stability[c]
            todo = list(inner[c])
            while todo:
                x = todo.pop()
                chosen.discard(x)
                todo += inner[x]
            chosen.add(c)
        else:
            best[c] = below
    for number, c in enumerate(sorted(chosen)):
        members: list[tuple[int, float]] = []
        todo = [c]
        while todo:
            for x, lam, _ in children[todo.pop()]:
                if x < n:
                    members.append((x, cap(lam)))
                else:
                    todo.append(x)
        most = max(lam for _, lam in members)
        for x, lam in members:
            labels[x], strength[x] = number, lam / most if most > 0 else 1.0
    order = sorted(set(labels[labels >= 0].tolist()), key=lambda k: (-int((labels == k).sum()), k))
    rank = {old: new for new, old in enumerate(order)}
    return np.array([rank.get(int(x), -1) for x in labels]), strength
