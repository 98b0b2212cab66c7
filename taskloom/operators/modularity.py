"""Greedy modularity of one component of a call graph that is given by blocks, without listing its links."""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pandas as pd

#: Bytes of rows of links kept at a time; others are computed again when they are needed.
ROW_BYTES = 128 << 20


class Search:
    """The two communities whose union raises the modularity most are merged while any does; of equal ones those of the least
    names, and a community is named after its least node. Gains are whole numbers (2 ``total`` times links, less the product of the
    degrees), so neither rounding nor the number of links decides.

    calls, held: (node, block), as of ``graph.call_blocks``, of one component; total: links of the whole graph. Memory grows with
    these rows, not with the links. Nodes held by the same block that call the same blocks are one class, and a community of more
    than one node knows its links to a node of every class. The best pair of nodes left alone is, of each block, that of the least
    degrees. So a merge costs a pass over the classes and what the merged ones call, and few are looked at again: a best
    partner only gets worse until its community changes.
    """

    def __init__(self, calls: pd.DataFrame, held: pd.DataFrame, total: int) -> None:
        self.total, self.names = total, sorted({*calls["node"], *held["node"]})
        at, code = {n: i for i, n in enumerate(self.names)}, {}
        holder, called = [-1] * len(at), [set() for _ in at]
        for n, b in zip(held["node"], held["block"], strict=True):
            holder[at[n]] = code.setdefault(b, len(code))
        for n, b in zip(calls["node"], calls["block"], strict=True):
            called[at[n]].add(code.setdefault(b, len(code)))
        kinds = defaultdict(list)
        for i, (h, c) in enumerate(zip(holder, called, strict=True)):
            kinds[h, tuple(sorted(c))].append(i)
        of = sorted(kinds)  # those of a block side by side
        self.members, self.first = [kinds[x] for x in of], [0] * len(of)
        self.holder, self.calls = [h for h, _ in of], [c for _, c in of]
        self.class_of = np.empty(len(at), np.int64)
        for k, nodes in enumerate(self.members):
            self.class_of[nodes] = k
        bounds = np.searchsorted(np.array(self.holder), np.arange(len(code) + 1)).tolist()
        self.held = [slice(bounds[b], bounds[b + 1]) for b in range(len(code))]
        callers = [[] for _ in code]
        for k, c in enumerate(self.calls):
            for b in c:
                callers[b].append(k)
        self.callers, self.mutual = [np.array(x, np.int64) for x in callers], {}
        size = np.array([len(x) for x in self.members], np.int64)
        n_held, n_callers = [int(size[s].sum()) for s in self.held], [int(size[x].sum()) for x in self.callers]
        degree = []
        for h, c in of:
            both = sum(int(size[self.both(b, h)].sum()) for b in c) if h >= 0 else 0
            degree.append(sum(n_held[b] for b in c) + (n_callers[h] if h >= 0 else 0) - both - (h in c))
        self.degree = degree
        self.weight = np.array(degree, np.int64)  # of what is left of a class; beyond every gain once nothing is
        self.least = np.array([x[0] for x in self.members], np.int64)
        self.alone = [True] * len(at)
        # Nodes of each block and its callers, the least degree and name last.
        order = sorted(range(len(at)), key=lambda i: (-degree[self.class_of[i]], -i))
        self.left_held, self.left_callers = [[] for _ in code], [[] for _ in code]
        for i in order:
            if holder[i] >= 0:
                self.left_held[holder[i]].append(i)
            for b in called[i]:
                self.left_callers[b].append(i)
        self.of_held, self.of_callers, self.of_mutual = defaultdict(dict), defaultdict(dict), defaultdict(dict)
        self.nodes, self.count, self.near, self.sum, self.version = {}, {}, {}, {}, {}
        self.rows, self.most_rows, self.made, self.clock = OrderedDict(), max(2, ROW_BYTES // (8 * len(of) + 1)), 0, 0
        self.room = np.empty((2, len(of)), np.int64)
        self.pairs = [x for b in range(len(code)) if (x := self.pair(b))]
        heapify(self.pairs)
        self.heap, self.limit = [], 1000

    def both(self, h: int, b: int) -> np.ndarray:
        """The classes held by block ``h`` that call block ``b``."""
        if (h, b) not in self.mutual:
            x, s = self.callers[b], self.held[h]
            self.mutual[h, b] = x[slice(*np.searchsorted(x, [s.start, s.stop]))]
        return self.mutual[h, b]

    def pair(self, b: int) -> tuple | None:
        """(product of degrees, node, node, block) of the best link from a node left alone to another one that block ``b`` holds."""
        x, y = self.left_held[b], self.left_callers[b]
        for nodes in (x, y):
            while nodes and not self.alone[nodes[-1]]:
                nodes.pop()
        if not x or not y:
            return None
        found = [(x[-1], y[-1])]
        if x[-1] == y[-1]:  # one that calls its own block
            found = []
            for nodes in (x, y):
                q = len(nodes) - 2
                while q >= 0 and not self.alone[nodes[q]]:
                    q -= 1
                del nodes[q + 1 : -1]
                found += [(nodes[-1], nodes[q])] if q >= 0 else []
        degree = lambda i: self.degree[self.class_of[i]]
        return min(((degree(i) * degree(j), min(i, j), max(i, j), b) for i, j in found), default=None)

    def add_links(self, row: np.ndarray, k: int, n: int) -> None:
        """Add the links of ``n`` nodes of class ``k`` to a node of every class."""
        h = self.holder[k]
        for b in self.calls[k]:
            row[self.held[b]] += n
        if h >= 0:
            row[self.callers[h]] += n
            for b in self.calls[k]:
                row[self.both(b, h)] -= n

    def row(self, m: int) -> np.ndarray:
        if m not in self.rows:
            self.rows[m] = row = np.zeros(len(self.members), np.int64)
            for k, n in self.count[m].items():
                self.add_links(row, k, n)
            while len(self.rows) > self.most_rows:
                self.rows.popitem(last=False)
        self.rows.move_to_end(m)
        return self.rows[m]

    def best(self, m: int) -> None:
        """Note the best node left alone for community ``m``, if it gains."""
        row, own = self.row(m), self.sum[m]
        gain, cost = self.room
        np.multiply(row, 2 * self.total, out=gain)
        np.multiply(self.weight, own, out=cost)
        gain -= cost
        if self.total < 1 << 30:
            found = np.flatnonzero(gain == gain.max())
        else:  # whole numbers wrap: those near the best one by rounded numbers, and of these their exact distances
            rough = row * (2.0 * self.total) - self.weight * float(own)
            found = np.flatnonzero(rough >= rough.max() - (4.0 * self.total) * (2.0 * self.total + 1) * 2.0**-48)
            exact = gain[found] - gain[found[0]]
            found = found[exact == exact.max()]
        k = found[0]
        gained = 2 * self.total * int(row[k]) - own * int(self.weight[k])
        if gained > 0:
            x, name = int(self.least[found].min()), self.nodes[m][0]
            heappush(self.heap, (-gained, min(name, x), max(name, x), m, x, self.version[m], -1))

    def index(self, m: int, k: int, n: int) -> None:
        h = self.holder[k]
        places = [self.of_callers[b] for b in self.calls[k]]
        if h >= 0:
            places += [self.of_held[h], *(self.of_mutual[h, b] for b in self.calls[k])]
        for place in places:
            place[m] = place.get(m, 0) + n
        self.count[m][k] = self.count[m].get(k, 0) + n

    def unindex(self, m: int, k: int) -> None:
        h = self.holder[k]
        for b in self.calls[k]:
            self.of_callers[b].pop(m, None)
            self.of_mutual[h, b].pop(m, None)
        self.of_held[h].pop(m, None)

    def link(self, m: int, other: int, n: int) -> None:
        self.near[m][other] = self.near[other][m] = self.near[m].get(other, 0) + n

    def add_node(self, m: int, x: int) -> None:
        k = int(self.class_of[x])
        h, near = self.holder[k], defaultdict(int)
        for b in self.calls[k]:
            for c, n in self.of_held[b].items():
                near[c] += n
        if h >= 0:
            for c, n in self.of_callers[h].items():
                near[c] += n
            for b in self.calls[k]:
                for c, n in self.of_mutual[b, h].items():
                    near[c] -= n
        for c, n in near.items():
            if c != m:
                self.link(m, c, n)
        self.index(m, k, 1)
        self.sum[m] += self.degree[k]
        nodes = self.nodes[m]
        nodes.append(x)
        if x < nodes[0]:
            nodes[0], nodes[-1] = nodes[-1], nodes[0]
        if m in self.rows:
            self.add_links(self.rows[m], k, 1)
        self.alone[x] = False
        left, i = self.members[k], self.first[k]
        while i < len(left) and not self.alone[left[i]]:
            i += 1
        self.first[k] = i
        if i < len(left):
            self.least[k] = left[i]
        else:
            self.weight[k] = 2 * self.total + 1

    def new(self) -> int:
        m, self.made = self.made, self.made + 1
        self.nodes[m], self.count[m], self.near[m], self.sum[m] = [], {}, {}, 0
        return m

    def unite(self, m: int, other: int) -> int:
        if len(self.count[m]) < len(self.count[other]):
            m, other = other, m
        for k in self.count[other]:
            self.unindex(other, k)
        for k, n in self.count[other].items():
            self.index(m, k, n)
        row = self.rows.get(m)
        if row is not None:
            if other in self.rows:
                row += self.rows[other]
            else:
                for k, n in self.count[other].items():
                    self.add_links(row, k, n)
        self.near[m].pop(other, None)
        for c, n in self.near[other].items():
            if c != m:
                self.near[c].pop(other)
                self.link(m, c, n)
        self.sum[m] += self.sum[other]
        a, b = self.nodes[m], self.nodes[other]
        if b[0] < a[0]:
            a[0], b[0] = b[0], a[0]
        a += b
        for of in (self.nodes, self.count, self.near, self.sum, self.version, self.rows):
            of.pop(other, None)
        return m

    def changed(self, m: int) -> None:
        """Note the gains of a community that has changed."""
        self.clock += 1
        self.version[m] = self.clock
        name = self.nodes[m][0]
        for c, n in self.near[m].items():
            gain = 2 * self.total * n - self.sum[m] * self.sum[c]
            if gain > 0:
                a, b = sorted((name, self.nodes[c][0]))
                heappush(self.heap, (-gain, a, b, m, c, self.clock, self.version[c]))
        self.best(m)
        if len(self.heap) > self.limit:
            self.heap = [x for x in self.heap if self.version.get(x[3]) == x[5] and x[6] in (-1, self.version.get(x[4]))]
            heapify(self.heap)
            self.limit = 2 * len(self.heap) + 1000

    def top(self) -> tuple | None:
        """The best merge of those that gain: (less gain, names, and of a community: itself, its partner and their versions)."""
        while self.pairs:
            _, i, j, b = self.pairs[0]
            if self.alone[i] and self.alone[j]:
                break
            if x := self.pair(b):
                heapreplace(self.pairs, x)
            else:
                heappop(self.pairs)
        while self.heap:
            _, _, _, m, other, a, b = self.heap[0]
            if self.version.get(m) == a and (self.alone[other] if b < 0 else self.version.get(other) == b):
                break
            heappop(self.heap)
            if b < 0 and self.version.get(m) == a:
                self.best(m)
        found = [(self.pairs[0][0] - 2 * self.total, *self.pairs[0][1:3])] if self.pairs else []
        found = min(found + self.heap[:1], default=None)
        return found if found and found[0] < 0 else None

    def run(self) -> list[list[str]]:
        """The communities, each as its nodes with the least one first."""
        while found := self.top():
            if len(found) == 3:
                m = self.new()
                self.add_node(m, found[1])
                self.add_node(m, found[2])
            elif found[6] < 0:
                m = found[3]
                self.add_node(m, found[4])
            else:
                m = self.unite(found[3], found[4])
            self.changed(m)
        rest = [[i] for i, alone in enumerate(self.alone) if alone]
        return [[self.names[i] for i in nodes] for nodes in [*self.nodes.values(), *rest]]
