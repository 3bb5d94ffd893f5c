"""A hierarchical navigable small-world graph over one shard of unit vectors, in flat arrays.

Nodes are in random order, and layer ``l`` holds the first ``n / M ** l`` of them, so a layer
is one array ``links[l]`` with a row of neighbours for each of its nodes, filled up with -1, and
node 0 is the entry to all layers.  Nodes enter a layer in lots, and all searches of a lot
advance together, one node each at a time; members of a lot see each other by their product.
"""

from __future__ import annotations

import numpy as np

#: Neighbours that a node chooses (the lowest layer keeps twice as many), and width of the search for them.
M, WIDTH = 16, 80
#: Nodes of a lot, and the nearest members of its own lot that a node considers.
LOT, OWN = 256, 16


def build(vectors: np.ndarray) -> list[np.ndarray]:
    """The layers over unit vectors in random order, the lowest first."""
    counts = [len(vectors)]
    while counts[-1] > 2 * M:
        counts.append(-(-counts[-1] // M))
    layers: list[np.ndarray] = []
    for depth, count in reversed([*enumerate(counts)]):
        links = np.full((count, M if depth else 2 * M), -1, np.int32)
        start = 0
        while start < count:
            end = min(count, start + min(LOT, max(2 * M, start)))
            # Nodes of the layer above are in this one first, and are found from node 0.
            above = layers if layers and start >= len(layers[-1]) else []
            _enter(links, vectors, np.arange(start, end), above)
            start = end
        layers.append(links)
    return layers[::-1]


def search(layers: list[np.ndarray], vectors: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that a search of some width ends with, for each query: nodes (-1: none) and cosines."""
    return _beam(layers[0], vectors, queries, _descend(layers[:0:-1], vectors, queries), width)


def _descend(layers: list[np.ndarray], vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """The node nearest to each query that greedy walks find, the uppermost layer first."""
    at = np.zeros(len(queries), np.int32)
    for links in layers:
        at = _beam(links, vectors, queries, at, 1)[0][:, 0]
    return at


def _beam(links: np.ndarray, vectors: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(queries)
    ids = np.full((n, width), -1, np.int32)
    near = np.full((n, width), -np.inf, np.float32)
    todo = np.zeros((n, width), bool)
    seen = np.zeros((n, len(links)), bool)
    rows = np.arange(n)
    ids[:, 0], todo[:, 0], seen[rows, entries] = entries, True, True
    near[:, 0] = np.einsum("ij,ij->i", vectors[entries], queries)
    while True:
        rows = rows[todo[rows].any(axis=1)]
        if not len(rows):
            return ids, near
        best = np.where(todo[rows], near[rows], -np.inf).argmax(axis=1)
        todo[rows, best] = False
        found = links[ids[rows, best]]
        r, c = np.nonzero((found >= 0) & ~seen[rows[:, None], found])
        seen[rows[r], found[r, c]] = True
        cosine = np.full(found.shape, -np.inf, np.float32)
        cosine[r, c] = np.einsum("ij,ij->i", vectors[found[r, c]], queries[rows[r]])
        all_near = np.concatenate([near[rows], cosine], axis=1)
        kept = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[rows] = np.take_along_axis(all_near, kept, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], found], axis=1), kept, axis=1)
        opened = np.concatenate([todo[rows], cosine > -np.inf], axis=1)
        todo[rows] = np.take_along_axis(opened, kept, axis=1)


def _enter(links: np.ndarray, vectors: np.ndarray, lot: np.ndarray, above: list[np.ndarray]) -> None:
    """Give the nodes of a lot neighbours, and those neighbours the nodes."""
    own = vectors[lot]
    product = own @ own.T
    np.fill_diagonal(product, -np.inf)
    k = min(OWN, len(lot) - 1) if lot[0] else len(lot) - 1
    mates = np.argsort(-product, axis=1)[:, :k]
    ids, near = lot[mates].astype(np.int32), np.take_along_axis(product, mates, axis=1)
    if lot[0]:
        found, cosine = _beam(links[: lot[0]], vectors, own, _descend(above, vectors, own), min(WIDTH, lot[0]))
        found[cosine == -np.inf] = -1
        ids, near = np.concatenate([ids, found], axis=1), np.concatenate([near, cosine], axis=1)
    if not ids.shape[1]:
        return
    chosen = _spread(vectors, ids, near, M)
    links[lot, : chosen.shape[1]] = chosen
    _answer(links, vectors, lot, chosen)


def _spread(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates, those that are nearer to it than to one chosen before, the
    nearest first, and then the nearest of the others until there are ``most``."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
    near = np.where(ids < 0, -np.inf, near)
    n, count = ids.shape
    points = vectors[ids]
    between = points @ points.transpose(0, 2, 1)
    closest = np.full((n, count), -np.inf, np.float32)
    taken = np.zeros((n, count), bool)
    for j in range(count):
        take = near[:, j] > closest[:, j]
        taken[:, j] = take
        np.maximum(closest, between[:, j], out=closest, where=take[:, None])
    first = np.argsort(np.where(ids < 0, 2, ~taken), axis=1, kind="stable")[:, :most]
    return np.take_along_axis(ids, first, axis=1)


def _answer(links: np.ndarray, vectors: np.ndarray, lot: np.ndarray, chosen: np.ndarray) -> None:
    """Link the chosen neighbours back; a full list is chosen anew."""
    row, column = np.nonzero(chosen >= 0)
    to, back = chosen[row, column], lot[row]
    fresh = (links[to] != back[:, None]).all(axis=1)
    to, back = to[fresh], back[fresh]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    room = links.shape[1]
    while len(to):
        # As many as a node chooses at a time: a hub gets the others in the next rounds.
        turn = np.arange(len(to)) - np.searchsorted(to, to)
        now = turn < M
        nodes, at = np.unique(to[now], return_inverse=True)
        ids = np.full((len(nodes), room + M), -1, np.int32)
        ids[:, :room] = links[nodes]
        ids[at, room + turn[now]] = back[now]
        full = (ids >= 0).sum(axis=1) > room
        easy = ids[~full]
        links[nodes[~full]] = np.take_along_axis(easy, np.argsort(easy < 0, axis=1, kind="stable")[:, :room], axis=1)
        hard, ids = nodes[full], ids[full]
        for i in range(0, len(hard), LOT):
            node, some = hard[i : i + LOT], ids[i : i + LOT]
            cosine = np.einsum("ijk,ik->ij", vectors[some], vectors[node])
            links[node] = _spread(vectors, some, cosine, room)
        to, back = to[~now], back[~now]
