"""Cover trees over blocks of whole-number points, and Lloyd's assignment of whole subtrees.

Each tree is a simplified cover tree: a node has a covering distance, every point below it is
within that distance of its centre, its children halve the distance, lie within it and are
farther apart than half of it, and one of them has the same centre. Levels at which nothing
would be split are left out. Points are stored in the order of the leaves, so that a subtree
is a range, and running sums over that order give the sum of any subtree by one subtraction.

Distances are compared as whole numbers, but for the triangle test, which compares square
roots: there a margin far above their rounding makes sure that a subtree is assigned whole
only if every point in it has that nearest entry.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

LEAF = 8  # a node with so few points is not split further
MARGIN = 1e-9
AT_ONCE = 1 << 16  # points or nodes compared with all entries at once


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return np.einsum("...i,...i->...", gap, gap)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places in the ranges, one after another, and the number of the range of each."""
    sizes = ends - starts
    which = np.repeat(np.arange(len(starts)), sizes)
    within = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[which] + within, which


def _split(points: np.ndarray, group: np.ndarray, centre: np.ndarray, reach: np.ndarray) -> tuple:
    """The child of every point and the centres of the children, per group: a point goes to the
    first centre within reach; the first point that has none becomes the next one."""
    child = np.zeros(len(points), dtype=np.int64)
    centres = [centre]
    of_group = [np.arange(len(centre))]
    left = np.flatnonzero(squared(points, points[centre][group]) > reach[group])
    child_of = np.full(len(points), -1, dtype=np.int64)
    child_of[np.setdiff1d(np.arange(len(points)), left, assume_unique=True)] = 0
    number = 0
    while len(left):
        number += 1
        groups, first = np.unique(group[left], return_index=True)
        new = np.full(len(centre), -1, dtype=np.int64)
        new[groups] = left[first]
        near = squared(points[left], points[new[group[left]]]) <= reach[group[left]]
        child_of[left[near]] = number
        centres.append(new[groups])
        of_group.append(groups)
        left = left[~near]
    child[:] = child_of
    return child, centres, of_group


@dataclass
class Forest:
    """A tree for each part of the vectors of a block; arrays over the nodes, level by level."""

    order: np.ndarray  # (parts, n): which vector stands at each place of each part's leaves
    centre: np.ndarray  # (nodes, d)
    radius: np.ndarray  # squared distance of the farthest point below
    start: np.ndarray  # places in the leaves, over all parts
    end: np.ndarray
    first_child: np.ndarray  # -1 for a leaf
    children: np.ndarray
    points: np.ndarray  # (parts * n, d) in the order of the leaves

    @property
    def shape(self) -> tuple[int, int]:
        return self.order.shape

    def packed(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **{name: _narrow(value) for name, value in vars(self).items()})
        return file.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Forest:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{name: held[name].astype(np.int64) for name in held})

    def sums(self) -> np.ndarray:
        """Running sums of the points, from nothing on."""
        zero = np.zeros((1, self.points.shape[1]), dtype=np.int64)
        return np.concatenate((zero, np.cumsum(self.points, axis=0)))


def _narrow(values: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16, np.int32):
        bounds = np.iinfo(kind)
        if values.size == 0 or (values.min() >= bounds.min and values.max() <= bounds.max):
            return values.astype(kind)
    return values


def plant(vectors: np.ndarray, parts: int) -> Forest:
    """Cover trees over the parts of a block of vectors, all split side by side."""
    n, width = vectors.shape
    points = np.ascontiguousarray(vectors.reshape(n, parts, width // parts).transpose(1, 0, 2)).reshape(parts * n, -1)
    order = np.arange(parts * n)  # the point at each place
    start, end = np.arange(parts) * n, np.arange(1, parts + 1) * n
    centre = start.copy()
    nodes: dict[str, list[np.ndarray]] = {k: [] for k in ("centre", "radius", "start", "end", "first_child", "children")}
    made = 0
    while len(start):
        place, group = _ranges(start, end)
        held = order[place]
        apart = squared(points[held], points[centre][group])
        radius = np.maximum.reduceat(apart, np.cumsum(end - start) - (end - start))
        open_ = (radius > 0) & (end - start > LEAF)
        first_child, children = np.full(len(start), -1), np.zeros(len(start), dtype=np.int64)
        made += len(start)
        next_ = (np.zeros(0, np.int64),) * 3
        if open_.any():
            # Half the least power of two that covers the node, squared.
            level = np.ceil(np.log2(radius[open_].astype(np.float64)) / 2)
            reach = np.floor(4.0 ** (level - 1)).astype(np.int64)
            mine = open_[group]
            renumbered = np.cumsum(open_) - 1
            group, held, place = renumbered[group[mine]], held[mine], place[mine]
            at = np.full(parts * n, -1)
            at[held] = np.arange(len(held))
            child, centres, of_group = _split(points[held], group, at[centre[open_]], reach)
            by_child = np.lexsort((child, group))
            order[place] = held[by_child]
            child, group = child[by_child], group[by_child]
            edge = np.flatnonzero(np.concatenate(([True], (child[1:] != child[:-1]) | (group[1:] != group[:-1]))))
            counts = np.bincount(group[edge], minlength=int(open_.sum()))
            first_child[open_] = made + np.cumsum(counts) - counts
            children[open_] = counts
            number = np.concatenate([np.full(len(c), i) for i, c in enumerate(centres)])
            all_centres, all_groups = np.concatenate(centres), np.concatenate(of_group)
            sorted_ = np.lexsort((number, all_groups))
            next_ = (place[edge], np.append(place[edge][1:], 0), held[all_centres[sorted_]])
            sizes = np.diff(np.append(edge, len(child)))
            next_ = (next_[0], next_[0] + sizes, next_[2])
        for name, value in zip(
            nodes, (points[centre], radius, start, end, first_child, children), strict=True
        ):
            nodes[name].append(value)
        start, end, centre = next_
    return Forest(
        order=order.reshape(parts, n) - np.arange(parts)[:, None] * n,
        points=points[order],
        **{name: np.concatenate(value) for name, value in nodes.items()},
    )


def _compared(points: np.ndarray, part: np.ndarray, books: np.ndarray, twins: np.ndarray) -> np.ndarray:
    """Squared distances to the entries of each point's part; entries with an earlier twin never win."""
    apart = squared(points[:, None, :], books[part])
    apart[twins[part]] = np.iinfo(np.int64).max
    return apart


def _twins(books: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one of their part."""
    same = (books[:, :, None, :] == books[:, None, :, :]).all(axis=3)
    return np.tril(same, -1).any(axis=2)


@dataclass
class Assigned:
    """Ranges of places that got the same entry, and how it was found."""

    start: np.ndarray
    end: np.ndarray
    entry: np.ndarray
    compared: int  # points compared one by one


def assign(forest: Forest, books: np.ndarray) -> Assigned:
    """The nearest entry of every point, the first of equal ones, by whole subtrees.

    ``books`` is (parts, entries, d). A subtree goes whole to the entry nearest its centre if
    no other can be nearer to any of its points: if the second nearest is farther than the
    nearest by more than twice the radius. Otherwise its children are looked at, and the points
    of a leaf are compared.
    """
    n = forest.shape[1]
    twins = _twins(books)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    compared = 0
    front = np.flatnonzero(forest.start % max(n, 1) == 0)[: forest.shape[0]] if n else np.zeros(0, np.int64)
    while len(front):
        onward = []
        for at in range(0, len(front), AT_ONCE // books.shape[1]):
            nodes = front[at : at + AT_ONCE // books.shape[1]]
            apart = _compared(forest.centre[nodes], forest.start[nodes] // n, books, twins)
            best = apart.argmin(axis=1)
            rows = np.arange(len(nodes))
            nearest = np.sqrt(apart[rows, best].astype(np.float64))
            apart[rows, best] = np.iinfo(np.int64).max
            second = np.sqrt(apart.min(axis=1).astype(np.float64))
            bound = nearest + 2 * np.sqrt(forest.radius[nodes].astype(np.float64))
            whole = (second > bound * (1 + MARGIN)) | (forest.radius[nodes] == 0)
            found.append((forest.start[nodes[whole]], forest.end[nodes[whole]], best[whole]))
            unsure = nodes[~whole]
            leaf = forest.first_child[unsure] < 0
            place, _ = _ranges(forest.start[unsure[leaf]], forest.end[unsure[leaf]])
            for begin in range(0, len(place), AT_ONCE // books.shape[1]):
                some = place[begin : begin + AT_ONCE // books.shape[1]]
                entry = _compared(forest.points[some], some // n, books, twins).argmin(axis=1)
                found.append((some, some + 1, entry))
            compared += len(place)
            split = unsure[~leaf]
            first = forest.first_child[split]
            onward.append(_ranges(first, first + forest.children[split])[0])
        front = np.concatenate(onward)
    if not found:
        found = [(np.zeros(0, np.int64),) * 3]
    return Assigned(*(np.concatenate(column) for column in zip(*found, strict=True)), compared)


def entry_sums(forest: Forest, assigned: Assigned, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Per part and entry, the sum of its points and their number, from running sums."""
    parts, n = forest.shape
    sums = forest.sums()
    slot = (assigned.start // max(n, 1)) * entries + assigned.entry
    total = np.zeros((parts * entries, forest.points.shape[1]), dtype=np.int64)
    count = np.zeros(parts * entries, dtype=np.int64)
    np.add.at(total, slot, sums[assigned.end] - sums[assigned.start])
    np.add.at(count, slot, assigned.end - assigned.start)
    return total, count


def codes(forest: Forest, assigned: Assigned, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of every part of every vector, (n, parts), and each vector's squared error."""
    parts, n = forest.shape
    at_place = np.zeros(parts * n, dtype=np.int64)
    place, which = _ranges(assigned.start, assigned.end)
    at_place[place] = assigned.entry[which]
    part = np.repeat(np.arange(parts), n)
    missed = squared(forest.points, books[part, at_place])
    vector = forest.order.reshape(-1)
    code = np.zeros((n, parts), dtype=np.int64)
    code[vector, part] = at_place
    error = np.zeros(n, dtype=np.int64)
    np.add.at(error, vector, missed)
    return code, error
