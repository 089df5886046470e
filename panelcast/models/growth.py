"""Growing histogram trees from sums per (node, feature, bin): what tasks and driver work out, without Spark."""

from __future__ import annotations

import heapq
import math

import numpy as np

#: Rows that go down a tree together; their places stay in the processor's cache.
CHUNK = 1 << 14
#: Numbers up to which the sums of all nodes of a level of a tree are held together: 32 MB.
SIDE_BY_SIDE = 1 << 22
FIELDS = ("feature", "bin", "missing_left", "left", "right", "value")


class Tree:
    """Nodes as arrays; ``feature`` is -1 in leaves. Rows whose bin is at most ``bin`` go left."""

    def __init__(self):
        self.nodes = {name: [] for name in FIELDS}

    def add(self, value: float) -> int:
        for name, v in zip(FIELDS, (-1, 0, False, -1, -1, value)):
            self.nodes[name].append(v)
        return len(self.nodes["value"]) - 1

    def split(self, node: int, feature: int, at: int, missing_left: bool, left: float, right: float) -> tuple[int, int]:
        children = self.add(left), self.add(right)
        for name, v in zip(FIELDS, (feature, at, missing_left, *children)):
            self.nodes[name][node] = v
        return children

    def arrays(self) -> dict[str, np.ndarray]:
        kinds = (np.int32, np.int32, bool, np.int32, np.int32, np.float64)
        return {name: np.array(self.nodes[name], kind) for name, kind in zip(FIELDS, kinds)}


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bins (features x rows) of values; 0 is for missing ones."""
    out = np.empty(x.shape, np.uint8)
    for i, value in enumerate(x):
        out[i] = np.where(np.isnan(value), 0, 1 + np.searchsorted(edges[i], value, "left"))
    return out


def both_ways(x: np.ndarray) -> np.ndarray:
    """For :func:`leaf_of`: the bins with missing values below all others, then above all."""
    return np.concatenate([x, x - np.uint8(1)])


def leaf_of(tree: dict[str, np.ndarray], twice: np.ndarray) -> np.ndarray:
    """The node each row of a block ends in."""
    features, total = len(twice) // 2, twice.shape[1]
    after = ~tree["missing_left"]
    start, limit = (np.maximum(tree["feature"], 0) + features * after) * total, tree["bin"] - after
    child, inner = np.stack([tree["left"], tree["right"]], 1).ravel().astype(np.int64), tree["feature"] >= 0
    flat, out = twice.ravel(), np.zeros(total, np.int64)
    for begin in range(0, total if inner[0] else 0, CHUNK):
        rows = np.arange(begin, min(begin + CHUNK, total))
        at = np.zeros(len(rows), np.int64)
        while len(rows):
            at = child.take(2 * at + (flat.take(start.take(at) + rows) > limit.take(at)))
            down = inner.take(at)
            if not down.all():
                out[rows[~down]] = at[~down]
                rows, at = rows[down], at[down]
    return out


def drawn_rows(margin: np.ndarray, s: np.ndarray, n: np.ndarray, grid: float, share: float, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(sums of gradients, numbers of rows) of the packed rows; below a share of 1, of those drawn."""
    gradient = n * np.rint(margin * grid) - s
    if share >= 1.0:
        return gradient, n
    rng = np.random.default_rng(seed)
    if n.max(initial=1.0) == 1.0:
        weight = (rng.random(len(n)) < share).astype(np.float64)
        return gradient * weight, weight
    weight = rng.binomial(n.astype(np.int64), share).astype(np.float64)
    return gradient / n * weight, weight


def bagged_rows(s: np.ndarray, n: np.ndarray, p: dict, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(sums of targets, numbers of rows) of the packed rows; of a bootstrap, those drawn."""
    if not p.get("bootstrap"):
        return s, n
    weight = np.random.default_rng(seed).poisson(n).astype(np.float64)
    return s / n * weight, weight


def node_sums(x: np.ndarray, rows: np.ndarray, sums: np.ndarray, weight: np.ndarray, slot: np.ndarray, slots: int, features: np.ndarray, bins: int) -> np.ndarray:
    """(slots, features, bins, 2): the sums and the numbers of the rows. ``sums``, ``weight`` and ``slot`` are those of ``rows``."""
    out = np.empty((slots, len(features), bins, 2))
    base, single = slot * bins, weight.max(initial=1.0) == 1.0
    for i, f in enumerate(features):
        at = base + x[f].take(rows)
        out[:, i, :, 0] = np.bincount(at, sums, slots * bins).reshape(slots, bins)
        out[:, i, :, 1] = np.bincount(at, None if single else weight, slots * bins).reshape(slots, bins)
    return out


def level_sums(blocks: list[tuple], tree: dict[str, np.ndarray], nodes: list[int], drawn, features: int, bins: int):
    """(node, its sums) of some nodes that have rows; ``blocks`` are (x, both ways), ``drawn(k)`` (sums, numbers of rows) of block k.

    Few nodes have their sums over all blocks side by side; where those would take more than SIDE_BY_SIDE numbers, one node of
    one block comes at a time, and a node comes several times.
    """
    slots, every = np.full(len(tree["value"]), -1, np.int64), np.arange(features)
    slots[nodes] = np.arange(len(nodes))
    dense = len(nodes) * features * bins * 2 <= SIDE_BY_SIDE
    total = np.zeros((len(nodes), features, bins, 2)) if dense else None
    for k, (x, twice) in enumerate(blocks):
        target, weight = drawn(k)
        slot = slots[leaf_of(tree, twice)]
        if dense:
            rows = np.flatnonzero((slot >= 0) & (weight > 0))
            total += node_sums(x, rows, target[rows], weight[rows], slot[rows], len(nodes), every, bins)
            continue
        slot[weight == 0] = -1
        order = np.argsort(slot, kind="stable")
        limits = np.searchsorted(slot[order], np.arange(len(nodes) + 1))
        for i in np.flatnonzero(np.diff(limits)):
            rows = order[limits[i] : limits[i + 1]]
            yield nodes[i], node_sums(x, rows, target[rows], weight[rows], np.zeros(len(rows), np.int64), 1, every, bins)[0]
    if dense:
        for i in np.flatnonzero(total[:, 0, :, 1].sum(1)):
            yield nodes[i], total[i]


def best_split(sums: np.ndarray, total: np.ndarray, l2: float, least: int):
    """(gain, feature, bin, whether missing goes left, left sums) of a node's best split, or None.

    ``sums`` (features, bins, 2) and ``total`` hold gradients and rows.
    """
    return best_splits(sums[None], total[None], l2, least)[0]


def best_splits(sums: np.ndarray, totals: np.ndarray, l2: float, least: int) -> list:
    """The same of several nodes."""
    running = np.cumsum(sums[:, :, 1:], axis=2)  # the last place parts missing values from all others
    sides = np.stack([running, running + sums[:, :, :1]], axis=1)  # missing values right, left
    whole = totals[:, None, None, None]
    rest = whole - sides

    def score(s):
        return s[..., 0] ** 2 / np.maximum(s[..., 1] + l2, 1e-12)

    gain = score(sides) + score(rest) - score(whole)
    gain[(sides[..., 1] < least) | (rest[..., 1] < least)] = -np.inf
    out = []
    for k, total in enumerate(totals):
        if not gain[k].size or gain[k].max() <= 1e-9 * max(1.0, abs(score(total))):
            out.append(None)
            continue
        side, feature, at = np.unravel_index(int(np.argmax(gain[k])), gain[k].shape)
        left = sides[k, side, feature, at]
        # without missing values in the node they follow the larger child
        missing_left = bool(side) if sums[k, feature, 0, 1] else bool(2 * left[1] >= total[1])
        out.append((float(gain[k, side, feature, at]), int(feature), int(at) + 1, missing_left, left.copy()))
    return out


class Held:
    """Sums of a table that one task holds: the rows of every node are kept in a list, so a split costs its node's rows."""

    def __init__(self, x: np.ndarray, s: np.ndarray, n: np.ndarray, bins: int, p: dict, grid: float):
        self.x, self.s, self.n, self.bins, self.p, self.grid = x, s, n, bins, p, grid
        self.twice, self.margin = both_ways(x), np.zeros(len(s))

    def begin(self, number: int) -> None:
        self.draw(number)
        self.rows = {0: np.flatnonzero(self.weight > 0)}

    def draw(self, number: int) -> None:
        self.gradient, self.weight = drawn_rows(self.margin, self.s, self.n, self.grid, self.p.get("rows", 1.0), [self.p["seed"], number, 0, 0])

    def sums(self, tree: dict, split: list[int], nodes: list[int], features: np.ndarray) -> np.ndarray:
        for n in split:
            rows = self.rows.pop(n)
            bins = self.x[tree["feature"][n]].take(rows)
            left = bins <= tree["bin"][n]
            if not tree["missing_left"][n]:
                left &= bins > 0
            self.rows[int(tree["left"][n])], self.rows[int(tree["right"][n])] = rows[left], rows[~left]
        rows = np.concatenate([self.rows[n] for n in nodes])
        slot = np.repeat(np.arange(len(nodes)), [len(self.rows[n]) for n in nodes])
        return node_sums(self.x, rows, self.gradient.take(rows), self.weight.take(rows), slot, len(nodes), features, self.bins)

    def end(self, tree: dict, place: np.ndarray) -> None:
        for node, rows in self.rows.items():
            self.margin[rows] += tree["value"][place[node]]
        out = np.flatnonzero(self.weight == 0)  # the others' leaves are known
        self.margin[out] += tree["value"][leaf_of(tree, self.twice[:, out])]


class Shared(Held):
    """A task's part of a table that several tasks hold: all add up their sums, and so grow the same trees."""

    def __init__(self, *table, gang):
        super().__init__(*table)
        self.gang, self.many = gang, np.flatnonzero(self.n > 1)

    def draw(self, number: int) -> None:
        share = self.p.get("rows", 1.0)
        if share >= 1.0:
            return super().draw(number)
        rng = np.random.default_rng([self.p["seed"], number, self.gang.rank, 0])
        self.weight = (rng.random(len(self.n)) < share).astype(np.float64)
        self.weight[self.many] = rng.binomial(self.n[self.many].astype(np.int64), share)
        self.gradient = (np.rint(self.margin * self.grid) - self.s / self.n) * self.weight

    def sums(self, tree: dict, split: list[int], nodes: list[int], features: np.ndarray) -> np.ndarray:
        return self.gang.total(super().sums(tree, split, nodes, features))


def boost(source, features: int) -> list[dict[str, np.ndarray]]:
    """The trees of squared loss, one after the other."""
    trees = []
    for number in range(source.p["trees"]):
        source.begin(number)
        tree, place = grow(source, number, features)
        source.end(tree, place)
        trees.append(tree)
    return trees


def grow(source, number: int, n_features: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """One tree, best gain first up to ``leaves``, or level by level down to ``depth``; and the nodes of it that grown ones are in."""
    p, tree = source.p, Tree()
    rng = np.random.default_rng([p["seed"], number])
    features = np.sort(rng.choice(n_features, max(1, round(p.get("cols", 1.0) * n_features)), replace=False))
    l2, least, rate = p.get("l2", 0.0), p.get("leaf", 1), p["rate"]
    depth_limit, budget = p.get("depth") or math.inf, p.get("leaves") or math.inf

    def value(total):
        return float(-rate * total[0] / source.grid / max(total[1] + l2, 1e-12))

    def look(sums: list, depths: list[int]) -> list[tuple]:
        """(sums, totals, depth, best split) of some nodes"""
        exact, out = np.array([1.0 / source.grid, 1.0]), []
        for at in range(0, len(sums), 16):
            part, depth = np.stack(sums[at : at + 16]), depths[at : at + 16]
            totals = part[:, 0].sum(1)
            best = [None] * len(part) if min(depth) >= depth_limit else best_splits(part * exact, totals * exact, l2, least)
            out += [(own, total, d, None if d >= depth_limit else b) for own, total, d, b in zip(part, totals, depth, best)]
        return out

    tree.add(0.0)
    known = dict(enumerate(look([source.sums(tree.arrays(), [], [0], features)[0]], [0])))
    tree.nodes["value"][0] = value(known[0][1])
    ready: dict[int, tuple[int, int]] = {}
    while True:
        # Follow the order of gains as far as the sums are known.
        chosen, front = [], [(-known[0][3][0], 0)] if known[0][3] else []
        while front and len(chosen) + 1 < budget:
            _, best = front[0]
            if best not in ready:
                break
            heapq.heappop(front)
            chosen.append(best)
            for child in ready[best]:
                if known[child][3]:
                    heapq.heappush(front, (-known[child][3][0], child))
        room = budget - 1 - len(chosen)
        if not front or room <= 0:
            return pruned(tree.arrays(), set(chosen))
        # Go on as if no unknown gain were larger: the nodes that would be split next are asked for together.
        asked, smaller = [], []
        while front and room > 0:
            _, best = heapq.heappop(front)
            room -= 1
            if best not in ready:
                asked.append(best)
                continue
            for child in ready[best]:
                if known[child][3]:
                    heapq.heappush(front, (-known[child][3][0], child))
        for n in asked:
            total, (_, f, at, missing_left, _) = known[n][1], known[n][3]
            left = known[n][0][f, 1 : at + 1].sum(0) + (known[n][0][f, 0] if missing_left else 0.0)
            ready[n] = tree.split(n, int(features[f]), at, missing_left, value(left), value(total - left))
            smaller.append(ready[n][0] if 2 * left[1] <= total[1] else ready[n][1])
        sums, depths = source.sums(tree.arrays(), asked, smaller, features), [known[n][2] + 1 for n in asked]
        known.update(zip(smaller, look(list(sums), depths)))
        others = [sum(ready[n]) - child for n, child in zip(asked, smaller)]
        known.update(zip(others, look([known[n][0] - own for n, own in zip(asked, sums)], depths)))
        for n in asked:
            known[n] = (None, *known[n][1:])  # its sums are its children's now


def pruned(tree: dict[str, np.ndarray], inner: set[int]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The tree in which only some nodes stay split, and the node of it that each one of the old is in."""
    order = [0]
    for n in order:
        if n in inner:
            order += [int(tree["left"][n]), int(tree["right"][n])]
    place = np.full(len(tree["value"]), -1)
    place[order] = np.arange(len(order))
    out = {name: tree[name][order].copy() for name in FIELDS}
    for i, n in enumerate(order):
        if n in inner:
            out["left"][i], out["right"][i] = place[tree["left"][n]], place[tree["right"][n]]
        else:
            for name, v in zip(FIELDS, (-1, 0, False, -1, -1)):
                out[name][i] = v
    for n in np.flatnonzero(tree["feature"] >= 0):  # children come after their parents
        for child in (tree["left"][n], tree["right"][n]):
            if place[child] < 0:
                place[child] = place[n]
    return out, place


def drawn_split(sums: np.ndarray, edges: list[np.ndarray], least: int, seed: list[int]):
    """The best of one random threshold per feature: (feature, bin, whether missing goes left), or None."""
    rng, best, total = np.random.default_rng(seed), None, sums[0].sum(0)
    for f, e in enumerate(edges):
        filled = np.flatnonzero(sums[f, 1:, 1])
        u = rng.random()
        if len(filled) < 2:
            continue
        low, high = filled[0], filled[-1]  # bins start at 1, so bin b ends at edge b - 1: places are edges
        limit = e[low] + u * (e[min(high, len(e) - 1)] - e[low])
        at = int(np.clip(np.searchsorted(e, limit, "left"), low, high - 1))
        left = sums[f, 1 : at + 2].sum(0)
        larger = bool(2 * left[1] >= total[1] - sums[f, 0, 1])  # missing values follow the larger child
        left = left + sums[f, 0] if larger else left
        right = total - left
        if min(left[1], right[1]) < max(least, 1):
            continue
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - total[0] ** 2 / total[1]
        if best is None or gain > best[0]:
            best = (gain, f, at + 1, larger)
    return None if best is None or best[0] <= 1e-9 * max(1.0, total[0] ** 2 / total[1]) else best[1:]


def forest_split(sums: np.ndarray, edges: list[np.ndarray], p: dict, seed: list[int]):
    """(feature, bin, whether missing goes left) of a node: the best split in a bootstrap, else the best one drawn; or None."""
    if not p.get("bootstrap"):
        return drawn_split(sums, edges, p.get("leaf", 1), seed)
    best = best_split(sums, sums[0].sum(0), 0.0, max(p.get("leaf", 1), 1))
    return best and best[1:4]


def one_random_tree(x: np.ndarray, s: np.ndarray, n: np.ndarray, edges: list[np.ndarray], p: dict, bins: int, base: float, grid: float, number: int) -> dict:
    """A tree of a table that one task holds, by the same sums and draws as :func:`spread_random_trees`."""
    every, tree = np.arange(len(edges)), Tree()
    target, weight = bagged_rows(s, n, p, [p["seed"], number, 0, 0])
    level = [(tree.add(0.0), np.flatnonzero(weight > 0))]
    for depth in range(p["depth"] + 1):
        below = []
        for node, rows in level:
            part, count = target[rows], weight[rows]
            total = np.array([part.sum(), count.sum()])
            tree.nodes["value"][node] = base + total[0] / grid / total[1]
            if depth == p["depth"] or total[1] < 2 * p.get("leaf", 1):
                continue
            sums = node_sums(x, rows, part, count, np.zeros(len(rows), np.int64), 1, every, bins)[0]
            split = forest_split(sums / [grid, 1.0], edges, p, [p["seed"], number, node])
            if split:
                f, at, larger_left = split
                left = x[f][rows]
                left = np.where(left == 0, larger_left, left <= at)
                a, b = tree.split(node, f, at, larger_left, 0.0, 0.0)
                below += [(a, rows[left]), (b, rows[~left])]
        level = below
    return tree.arrays()
