"""Suppression, linkage, PCA, k-means and density clustering of one group's points."""

from __future__ import annotations

from collections import defaultdict
from itertools import product

import numpy as np


def suppress(points: np.ndarray, scores: np.ndarray, distance: float) -> np.ndarray:
    """Indices kept by greedy suppression, best score first (first of ties), inclusive radius; all if distance <= 0."""
    if distance <= 0:
        return np.arange(len(points))
    grid: dict[tuple, list[int]] = defaultdict(list)
    kept = []
    for i in np.lexsort((np.arange(len(scores)), -scores)):
        cell = tuple(np.floor(points[i] / distance).astype(int))
        near = (j for step in product((-1, 0, 1), repeat=points.shape[1]) for j in grid.get(tuple(np.add(cell, step)), ()))
        if all(((points[i] - points[j]) ** 2).sum() > distance**2 for j in near):
            grid[cell].append(i)
            kept.append(i)
    return np.sort(np.array(kept, dtype=int))


def surely_kept(tile: np.ndarray, cell: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray, more: np.ndarray, wide: int, reach: int, distance: float) -> np.ndarray:
    """Which rows greedy suppression keeps, as far as these rows tell; rows come tile by tile, best first.

    cell: numbers from 0 up to wide, along each axis of the tile; rows that are near enough are reach cells apart at most. low, high: the box around
    all rows of the cell; more: whether some of them, worse than those here, are missing. Outside of a tile there may be others.
    So a row is kept if none that may be kept before it is near; where that is open, its cell is in doubt from then on, and with it what is near the cell's box.
    """
    n, axes = points.shape
    steps = (wide + 2 * reach) ** np.arange(axes)[::-1]
    numbers, first, own = np.unique(tile * (wide + 2 * reach) ** axes + (cell + reach) @ steps, return_index=True, return_inverse=True)
    around = np.array(list(product(range(-reach, reach + 1), repeat=axes))) @ steps
    ordered = np.argsort(own, kind="stable")
    counts = np.bincount(own)
    place = np.empty(n, dtype=np.int64)
    place[ordered] = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    # the rows of a cell side by side
    grid = np.full((axes, len(numbers), counts.max()), np.nan)
    grid[:, own, place] = points.T
    low, high, last = low[first].T, high[first].T, np.where(more[first], counts - 1, -1)
    rim = ((cell[first] < reach) | (cell[first] >= wide - reach)).any(axis=1)
    gone, unsure = np.zeros((2, *grid.shape[1:]), dtype=bool)
    covered, doubted = np.zeros((2, len(numbers)), dtype=bool)
    kept = np.zeros(n, dtype=bool)

    def near(c: int) -> np.ndarray:
        wanted = numbers[c] + around
        found = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
        return found[numbers[found] == wanted]

    def doubt(c: int) -> None:
        doubted[c] = True
        cells = near(c)
        gaps = (np.maximum(np.maximum(low[a, c] - grid[a, cells], grid[a, cells] - high[a, c]), 0) for a in range(axes))
        unsure[cells] |= sum(g * g for g in gaps) <= distance * distance

    for k, (c, p) in enumerate(zip(own.tolist(), place.tolist(), strict=True)):
        if not gone[c, p]:
            if not rim[c] and not unsure[c, p]:
                kept[k] = True
                cells = near(c)
                gone[cells] |= sum(d * d for d in (grid[a, cells] - points[k, a] for a in range(axes))) <= distance * distance
                furthest = (np.maximum(np.abs(low[a, cells] - points[k, a]), np.abs(high[a, cells] - points[k, a])) for a in range(axes))
                covered[cells] |= sum(d * d for d in furthest) <= distance * distance
            elif not doubted[c]:
                doubt(c)
        if p == last[c] and not covered[c] and not doubted[c]:
            doubt(c)
    return kept


#: Distances that are held at once.
HELD = 1 << 20


class _Around:
    """Places by grid cells of a side, and those in a cell and the ones around it."""

    def __init__(self, places: np.ndarray, side: float):
        self.cell = np.floor(places / side).astype(np.int64)
        order = np.lexsort(self.cell.T[::-1])
        names, starts = np.unique(self.cell[order], axis=0, return_index=True)
        self.own = dict(zip(map(tuple, names.tolist()), np.split(order, starts[1:]), strict=True))
        self.steps = np.array(list(product((-1, 0, 1), repeat=places.shape[1])))

    def of(self, place: int) -> np.ndarray:
        found = (self.own.get(c) for c in map(tuple, (self.cell[place] + self.steps).tolist()))
        return np.concatenate([x for x in found if x is not None])


def complete_linkage(points: np.ndarray, threshold: float) -> np.ndarray:
    """Labels (a group's first row) of groups whose diameter stays strictly below the threshold, merged nearest first.

    Chains of nearest neighbours give the same groups as a matrix of all distances, ties aside, as merging never brings a group
    nearer to another one. A group's partners lie in the grid cells around its first member, so what is held are the
    distances of one group to the places around it. Cells are narrow first, and as wide as the threshold only for groups whose partners
    are that far; of large groups, members furthest out along some ways bound the distances, and only groups that may be the
    nearest are compared as a whole. So the work doesn't grow with the square of the rows. Equal places are one from the start.
    """
    n = len(points)
    if n < 2 or threshold <= 0:
        return np.arange(n)
    places, of = np.unique(points, axis=0, return_inverse=True)
    of, m, most = of.ravel(), len(places), threshold * threshold
    members, label, size = [np.array([i]) for i in range(m)], np.arange(m), np.ones(m, dtype=np.int64)
    sides = [threshold]
    while len(sides) < 24 and len(np.unique(np.floor(places / sides[-1]), axis=0)) < m / 2:
        sides.append(sides[-1] / 2)
    sides = sides[::-1]
    around, level = [_Around(places, side) for side in sides], np.zeros(m, dtype=np.int64)
    ways = np.array([w for w in product((-1, 0, 1), repeat=places.shape[1]) if any(w)], float)

    def furthest(own: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Of each place of near, the square of how far the furthest of own is."""
        far = np.zeros(len(near))
        for k in range(0, len(own), max(1, HELD // len(near))):
            some = places[own[k : k + max(1, HELD // len(near))]]
            far = np.maximum(far, ((some[:, None] - places[near][None]) ** 2).sum(axis=2).max(axis=0))
        return far

    def within(group: int, before: int, near: np.ndarray, most: float) -> tuple[int, float]:
        """The group of near whose furthest member is nearest, and below the most."""
        own = members[group]
        some = own if len(own) <= len(ways) else own[np.unique((places[own] @ ways.T).argmax(axis=0))]
        far, names = furthest(some, near), label[near]
        order = np.argsort(names, kind="stable")
        starts = np.flatnonzero(np.diff(names[order], prepend=-1))
        names, worst, count = names[order][starts], np.maximum.reduceat(far[order], starts), np.diff(starts, append=len(near))
        fits = (names != group) & (count == size[names]) & (worst < most)
        names, worst = names[fits], worst[fits]
        if len(some) < len(own):  # then these are the least they can be
            least = most
            for k in np.argsort(worst, kind="stable"):
                if worst[k] > least:
                    worst[k] = np.inf
                    continue
                worst[k] = furthest(own, members[names[k]]).max()
                least = min(least, worst[k])
            fits = worst < most
            names, worst = names[fits], worst[fits]
        if not len(names):
            return -1, np.inf
        least = worst.min()
        equal = names[worst == least]
        return (before if before in equal else int(equal.min())), float(least)

    def nearest(group: int, before: int) -> tuple[int, float]:
        """The group whose furthest member is nearest, `before` among equals; -1 if none is near enough.

        Merging never brings a group nearer, so the cells that had none before need no other look.
        """
        for k in range(level[group], len(sides)):
            level[group] = k
            found = within(group, before, around[k].of(members[group][0]), min(most, sides[k] * sides[k]))
            if found[0] >= 0:
                return found
        return -1, np.inf

    for start in range(m):
        chain = [start] if label[start] == start else []
        while chain:
            top = chain[-1]
            other, _ = nearest(top, chain[-2] if len(chain) > 1 else -1)
            if other < 0:
                chain.pop()  # it stays as it is
            elif len(chain) > 1 and other == chain[-2]:
                del chain[-2:]
                kept, gone = min(top, other), max(top, other)
                label[members[gone]], level[kept] = kept, max(level[kept], level[gone])
                members[kept] = np.concatenate([members[kept], members[gone]])
                members[gone], size[kept], size[gone] = members[gone][:0], size[kept] + size[gone], 0
                if not chain:
                    chain.append(kept)
            else:
                chain.append(other)
    groups = label[of]
    first = np.full(m, n)
    np.minimum.at(first, groups, np.arange(n))
    return first[groups]


def pca(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores, components and shares of variance; each component's largest loading is positive."""
    k = min(k, len(rows) - 1, rows.shape[1])
    if k < 2:
        raise ValueError("two components at least need three rows")
    centred = rows - rows.mean(axis=0)
    _, s, v = np.linalg.svd(centred, full_matrices=False)
    v = v[:k] * np.sign(v[np.arange(k), np.abs(v[:k]).argmax(axis=1)])[:, None]
    return centred @ v.T, v, (s**2 / max((s**2).sum(), 1e-300))[:k]


def apart(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the rows, each drawn by its square distance from those before; equal rows can't give more than they are."""
    out = [rows[rng.integers(len(rows))]]
    far = ((rows - out[0]) ** 2).sum(axis=1)
    while len(out) < k:
        at = rng.choice(len(rows), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(rows))
        out.append(rows[at])
        far = np.minimum(far, ((rows - rows[at]) ** 2).sum(axis=1))
    return np.array(out)


def settled(rows: np.ndarray, centres: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Centres moved to the means of the rows nearest to them until none moves; a centre without rows stays."""
    for _ in range(rounds):
        own = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([rows[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        if np.allclose(moved, centres):
            return moved
        centres = moved
    return centres


def density_clusters(rows: np.ndarray, least_size: int) -> np.ndarray:
    """Labels of density clusters of a few rows, with all their distances at hand; -1 is noise."""
    n = len(rows)
    if n < least_size:
        raise ValueError("fewer rows than the least cluster size")
    d = np.sqrt(np.maximum(((rows[:, None] - rows[None]) ** 2).sum(axis=2), 0))
    core = np.sort(d, axis=1)[:, min(max(least_size - 1, 1), n - 1)]
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))
    seen, link, far = np.zeros(n, bool), np.zeros(n, int), np.full(n, np.inf)
    edges, at = [], 0
    for _ in range(n - 1):
        seen[at] = True
        closer = ~seen & (reach[at] < far)
        far[closer], link[closer] = reach[at][closer], at
        at = int(np.argmin(np.where(seen, np.inf, far)))
        edges.append((far[at], link[at], at))
    return tree_clusters(n, edges, least_size)


def tree_clusters(n: int, edges: list[tuple[float, int, int]], least_size: int) -> np.ndarray:
    """Clusters by excess of mass from a spanning tree of n rows by mutual reachability (distance, row, row); -1 is noise.

    The tree is condensed to splits into parts of least_size or more; of all sets of clusters, the one with the greatest
    stability. Labels go by the clusters' first rows. Memory: a few numbers a row.
    """
    parent, size, first = list(range(n)), [1] * n, list(range(n))
    children: dict[int, tuple[int, int]] = {}
    height: dict[int, float] = {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for w, a, b in sorted(edges):
        ra, rb = root(a), root(b)
        new = len(parent)
        parent.append(new)
        parent[ra] = parent[rb] = new
        size.append(size[ra] + size[rb])
        first.append(min(first[ra], first[rb]))
        children[new], height[new] = (ra, rb), w
    top = len(parent) - 1
    stability: dict[int, float] = {}
    splits: dict[int, list[int]] = {}
    order: list[int] = []
    stack = [(top, 0.0)]
    while stack:
        cluster, birth = stack.pop()
        order.append(cluster)
        node, total = cluster, 0.0
        while node in children:
            lam = 1 / height[node] if height[node] > 0 else 1e12
            big = [c for c in children[node] if size[c] >= least_size]
            if len(big) == 2:
                total += size[node] * (lam - birth)
                splits[cluster] = big
                stack += [(c, lam) for c in big]
                break
            total += (size[node] - sum(size[c] for c in big)) * (lam - birth)
            if not big:
                break
            node = big[0]
        stability[cluster] = total
    chosen: dict[int, list[int]] = {}
    for cluster in reversed(order):
        below = splits.get(cluster, [])
        under = sum(stability[c] for c in below)
        if below and (cluster == top or under > stability[cluster]):
            stability[cluster], chosen[cluster] = under, [x for c in below for x in chosen.pop(c)]
        else:
            chosen[cluster] = [] if cluster == top else [cluster]
    labels = np.full(n, -1)
    for k, c in enumerate(sorted(chosen[top], key=first.__getitem__)):
        leaves = [c]
        while leaves:
            node = leaves.pop()
            if node in children:
                leaves += children[node]
            else:
                labels[node] = k
    return labels


def greedy_match(pairs: list[tuple[float, int, int]]) -> dict[int, int]:
    """One-to-one b -> a by rising (distance, b, a)."""
    out: dict[int, int] = {}
    taken: set[int] = set()
    for _, b, a in sorted(pairs):
        if b not in out and a not in taken:
            out[b] = a
            taken.add(a)
    return out
