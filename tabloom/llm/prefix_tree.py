"""A prefix tree of ordered sets, and the similar pairs among a group of sets."""

from __future__ import annotations

import numpy as np


def least_overlap(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The smallest intersection at which sets of these sizes reach the similarity."""
    return -(-percent * (a + b) // (100 + percent))


# Depths at which long nodes are cut, so that a query can leave them early.
STOPS = [16 * (2**k - 1) for k in range(1, 24)]


class PrefixTree:
    """Compressed tree over sorted arrays of hashes.

    Sets that begin alike share the nodes of their common beginning. ``similar`` goes down
    level by level with the overlap reached so far, which all sets below a node share, and
    leaves a subtree when what remains of the longest set below, or of the query, cannot
    lift the overlap to the least that the shortest one needs.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.sets = percent, sets
        size = np.array([len(s) for s in sets], np.int64)
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        begin = np.concatenate([[0], np.cumsum(size)])
        self.tokens = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        parent, start, end, owner, doc = [-1], [0], [0], [0], [-1]

        def node(above: int, low: int, high: int, of: int, leaf: int) -> int:
            for column, value in ((parent, above), (start, low), (end, high), (owner, of), (doc, leaf)):
                column.append(value)
            return len(parent) - 1

        stack, before = [0], None
        for k in order:
            shared = 0
            if before is not None:
                least = int(min(size[k], size[before]))
                differ = np.flatnonzero(sets[k][:least] != sets[before][:least])
                shared = int(differ[0]) if len(differ) else least
            last = None
            while end[stack[-1]] > shared:
                last = stack.pop()
            if end[stack[-1]] < shared:
                middle = node(stack[-1], start[last], shared, owner[last], -1)
                parent[last], start[last] = middle, shared
                stack.append(middle)
            for stop in STOPS:
                if shared < stop < size[k]:
                    stack.append(node(stack[-1], shared, stop, k, -1))
                    shared = stop
            stack.append(node(stack[-1], shared, int(size[k]), k, k))
            before = k
        count = len(parent)
        self.parent, self.doc = np.array(parent), np.array(doc)
        self.depth = np.array(end)
        self.low = begin[owner] + np.array(start)
        self.high = begin[owner] + self.depth
        by_parent = np.argsort(self.parent[1:], kind="stable") + 1
        self.children = by_parent
        self.first = np.searchsorted(self.parent[by_parent], np.arange(count + 1))
        self.least, self.most = np.full(count, np.iinfo(np.int64).max), np.zeros(count, np.int64)
        own = self.doc >= 0
        self.least[own] = self.most[own] = size[self.doc[own]]
        place = np.empty(len(sets), np.int64)
        place[order] = np.arange(len(sets))
        self.order = np.array(order, np.int64)
        # The sets below a node are consecutive in order.
        self.since, self.until = np.full(count, len(sets)), np.zeros(count, np.int64)
        self.since[own] = place[self.doc[own]]
        self.until[own] = self.since[own] + 1
        levels = []
        level = np.zeros(1, np.int64)
        while len(level):
            levels.append(level)
            level = self._children_of(level)
        for level in reversed(levels[1:]):
            np.minimum.at(self.least, self.parent[level], self.least[level])
            np.maximum.at(self.most, self.parent[level], self.most[level])
            np.minimum.at(self.since, self.parent[level], self.since[level])
            np.maximum.at(self.until, self.parent[level], self.until[level])

    def _children_of(self, nodes: np.ndarray) -> np.ndarray:
        low, many = self.first[nodes], self.first[nodes + 1] - self.first[nodes]
        total = many.sum()
        return self.children[np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)]

    def similar(self, query: int, open_: np.ndarray) -> np.ndarray:
        """Open sets similar to one of the tree's sets."""
        mine = self.sets[query]
        size = len(mine)
        before = np.concatenate([[0], np.cumsum(open_[self.order])])
        found = []
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        over = np.zeros(len(self.parent), np.int64)
        while len(nodes):
            over[nodes] = overlap
            nodes = self._children_of(nodes)
            nodes = nodes[before[self.until[nodes]] > before[self.since[nodes]]]
            nodes = nodes[(100 * self.most[nodes] >= self.percent * size) & (self.percent * self.least[nodes] <= 100 * size)]
            if not len(nodes):
                break
            low, length = self.low[nodes], self.high[nodes] - self.low[nodes]
            begin = np.concatenate([[0], np.cumsum(length)])
            tokens = self.tokens[np.repeat(low - begin[:-1], length) + np.arange(begin[-1])]
            at = np.minimum(np.searchsorted(mine, tokens), size - 1)
            hits = np.concatenate([[0], np.cumsum(mine[at] == tokens)])
            overlap = over[self.parent[nodes]] + hits[begin[1:]] - hits[begin[:-1]]
            passed = np.where(self.depth[nodes] > 0, np.searchsorted(mine, self.tokens[self.high[nodes] - 1], "right"), 0)
            reach = overlap + np.minimum(self.most[nodes] - self.depth[nodes], size - passed)
            keep = reach >= least_overlap(size, self.least[nodes], self.percent)
            nodes, overlap = nodes[keep], overlap[keep]
            ends = self.doc[nodes] >= 0
            docs = self.doc[nodes[ends]]
            enough = 100 * overlap[ends] >= self.percent * (size + self.depth[nodes[ends]] - overlap[ends])
            found.append(docs[enough & open_[docs]])
        return np.concatenate(found) if found else np.empty(0, np.int64)


def linking_pairs(sets: list[np.ndarray], group: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Similar pairs that connect what ``group`` does not: for every similar pair of sets of
    different groups, the groups end up connected by the pairs returned."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        close = 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both)
        return [(0, 1)] if close and group[0] != group[1] else []
    tree = PrefixTree(sets, percent)
    label = np.unique(group, return_inverse=True)[1]
    later = np.ones(len(sets), bool)
    pairs = []
    for query in range(len(sets)):
        later[query] = False
        open_ = later & (label != label[query])
        if not open_.any():
            continue
        for other in tree.similar(query, open_).tolist():
            if label[other] != label[query]:
                pairs.append((query, other))
                label[label == label[other]] = label[query]
    return pairs
