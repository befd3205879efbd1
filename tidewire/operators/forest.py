"""Figures of a routing tree that changes from version to version.

A group is a block of consecutive versions of one network: the links in force at its first version and what changes
after it.  Each node keeps sums over its subtree, so a changed parent touches its ancestors only, not the network.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import addresses

#: Most nodes of a network whose tree a task holds, and fewest versions of a block.
NODES, BLOCK = 1 << 20, 256
#: Most networks whose block sizes Spark may broadcast.
NETWORKS = 1 << 16
SHAPES = "network string, version long, root_id long, depth_avg double, depth_min long, depth_max long, diameter long, avg_path_len double"

_ALONE = (1, 0, 0, 0, 0, 1, 0)


def shapes(intervals: DataFrame) -> DataFrame:
    """Root, depths, diameter and path length of every version; ``intervals`` hold network, node_id, parent_id, is_root, first and last version."""
    # A block has a quarter as many versions as the network has nodes, so the links at the begin of all blocks are some four per version.
    size = F.greatest(F.floor(F.count_distinct("node_id") / 4), F.lit(BLOCK)).cast("bigint")
    sizes = intervals.groupBy("network").agg(size.alias("size"), F.max("last").alias("until"))
    blocks, networks = sizes.agg(F.sum(F.floor(F.col("until") / F.col("size")) + 1), F.count(F.lit(1))).first()
    cut = intervals.join(sizes if networks <= NETWORKS else sizes.hint("merge"), "network").select(
        "network", "size", "node_id", F.coalesce("parent_id", "node_id").alias("parent_id"), F.coalesce("is_root", F.lit(False)).alias("is_root"),
        "first", "last", F.explode(F.sequence(F.floor(F.col("first") / F.col("size")), F.floor(F.col("last") / F.col("size")))).alias("block"),
    )
    return cut.repartition(min(blocks or 1, 4096), "network", "block").groupBy("network", "block").applyInPandas(_block_shapes, SHAPES)


class Forest:
    """Nodes with at most one parent each.  A link that would close a loop is kept apart, at the top of its tree."""

    def __init__(self):
        self.parent, self.closing = {}, {}
        # Rows of a node, where messages repeat; a depth counts once for every choice of rows on the way to the root.
        self.rows = defaultdict(lambda: 1)
        # Per node: size, sum of distances down, sum of distances inside (ordered pairs), height, diameter of its subtree; number and sum of depths.
        self.figures = defaultdict(lambda: _ALONE)
        # Over its children: sizes, distances, inside, distances times sizes, numbers and sums of depths; how many have which height and diameter.
        self.sums = defaultdict(lambda: [0, 0, 0, 0, 0, 0])
        self.heights, self.diameters = defaultdict(Counter), defaultdict(Counter)
        self.children = defaultdict(set)
        # Over all tops.
        self.inside, self.pairs, self.longest = 0, 0, Counter()
        self._loops = {}

    def _count(self, figures, sign):
        size, _, inside, _, diameter, _, _ = figures
        self.inside += sign * inside
        self.pairs += sign * size * (size - 1)
        _add(self.longest, diameter, sign)

    def _attach(self, node, child, sign):
        size, down, inside, height, diameter, ways, depths = self.figures[child]
        sums, far = self.sums[node], down + size
        for i, more in enumerate((size, far, inside, far * size, ways, depths + ways)):
            sums[i] += sign * more
        _add(self.heights[node], height + 1, sign)
        _add(self.diameters[node], diameter, sign)

    def _renew(self, node):
        sizes, far, inside, products, ways, depths = self.sums[node]
        tall = heapq.nlargest(2, self.heights[node])
        bend = sum(tall) if not tall or self.heights[node][tall[0]] == 1 else 2 * tall[0]
        self.figures[node] = (
            sizes + 1, far, inside + 2 * (far * (sizes + 1) - products), tall[0] if tall else 0, max(bend, max(self.diameters[node], default=0)),
            self.rows[node] * (1 + ways), self.rows[node] * depths,
        )

    def top(self, node):
        while (above := self.parent.get(node)) is not None:
            node = above
        return node

    def _change(self, node, child, sign):
        """Takes a child in or out and renews all nodes above."""
        line = [node]
        while (above := self.parent.get(line[-1])) is not None:
            line.append(above)
        self._loops.pop(line[-1], None)
        self._count(self.figures[line[-1]], -1)
        for above, below in zip(line[:0:-1], line[-2::-1]):
            self._attach(above, below, -1)
        self._attach(node, child, sign)
        self._renew(node)
        for below, above in zip(line, line[1:]):
            self._attach(above, below, 1)
            self._renew(above)
        self._count(self.figures[line[-1]], 1)

    def cut(self, node):
        if self.closing.pop(node, None) is not None:
            self._loops.pop(node, None)
            return
        above = self.parent.pop(node, None)
        if above is None:
            return
        self.children[above].discard(node)
        self._change(above, node, -1)
        self._count(self.figures[node], 1)
        top = self.top(above)
        if top in self.closing:
            # The loop may be open now.
            self.link(top, self.closing.pop(top))

    def weigh(self, node, rows):
        """Sets the rows of a node that has no parent."""
        if self.rows[node] != rows:
            if node in self.figures:
                self._count(self.figures[node], -1)
            self.rows[node] = rows
            self._renew(node)
            self._count(self.figures[node], 1)

    def link(self, node, above):
        for end in (node, above):
            if end not in self.figures:
                self._count(self.figures[end], 1)
        if self.top(above) == node:
            self.closing[node] = above
            self._loops.pop(node, None)
            return
        self._count(self.figures[node], -1)
        self.parent[node] = above
        self.children[above].add(node)
        self._change(above, node, 1)

    def _loop(self, top):
        """Nodes of the loop that a top closes, from the top on downwards, with the figures of what hangs on them outside the loop."""
        if top not in self._loops:
            line, at = [], self.closing[top]
            while at is not None:
                line.append(at)
                at = self.parent.get(at)
            hung = []
            for below, node in zip([None, *line], line):
                if below is not None:
                    self._attach(node, below, -1)
                    whole = self.figures[node]
                    self._renew(node)
                hung.append(self.figures[node])
                if below is not None:
                    self.figures[node] = whole
                    self._attach(node, below, 1)
            # Parents stand behind their children; the last one's parent is the first.
            size, inside, longest = sum(h[0] for h in hung), sum(h[2] for h in hung), max(h[4] for h in hung)
            inside += 2 * sum(h[1] * (size - h[0]) for h in hung)
            for i, one in enumerate(hung):
                for j in range(i):
                    apart, other = min(i - j, len(hung) - i + j), hung[j]
                    inside += 2 * apart * one[0] * other[0]
                    longest = max(longest, one[3] + other[3] + apart)
            self._loops[top] = (line, hung, inside, longest)
        return self._loops[top]

    def totals(self):
        """Longest distance, sum of distances and number of connected ordered pairs."""
        inside, longest = self.inside, self.longest
        if self.closing:
            longest = longest.copy()
            for top in self.closing:
                _, _, whole, far = self._loop(top)
                inside += whole - self.figures[top][2]
                _add(longest, self.figures[top][4], -1)
                _add(longest, far, 1)
        return max(longest, default=0), inside, self.pairs

    def below(self, root):
        """Number, sum and maximum of the depths below the root; the root's own link doesn't count."""
        for top in self.closing:
            line, hung, _, _ = self._loop(top)
            if root in line:
                # From the root back against the links; ``more`` are the choices of rows from a loop node to the root.
                place, more, count, total, deepest = line.index(root), 1, -self.rows[root], 0, 0
                for steps in range(len(line)):
                    at = (place - steps) % len(line)
                    _, _, _, height, _, ways, depths = hung[at]
                    count, total, deepest = count + ways * more, total + (depths + ways * steps) * more, max(deepest, height + steps)
                    more *= self.rows[line[at]]
                return count, total, deepest
        _, _, _, height, _, ways, depths = self.figures.get(root, _ALONE)
        return ways - self.rows[root], depths, height


def _add(counter, value, sign):
    counter[value] += sign
    if not counter[value]:
        del counter[value]


def _block_shapes(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    network, block = group
    size = int(rows["size"].iloc[0])
    low, high = int(block) * size, (int(block) + 1) * size - 1
    starts, ends = defaultdict(list), defaultdict(list)
    for node, parent, flag, first, last in zip(*(rows[c].tolist() for c in ("node_id", "parent_id", "is_root", "first", "last"))):
        starts[max(first, low)].append((node, (parent != node, parent, flag)))
        if last < high:
            ends[last + 1].append((node, (parent != node, parent, flag)))
    forest, held, links, router = Forest(), defaultdict(Counter), {}, addresses.ROOT_ID
    flagged, highest, seen, out = {router}, [-router], 0, []
    for version in range(low, min(high, int(rows["last"].max())) + 1):
        seen += len(starts[version]) - len(ends[version])
        for changes, sign in ((ends[version], -1), (starts[version], 1)):
            for node, row in changes:
                _add(held[node], row, sign)
        moved = {}
        for node in {node for node, _ in ends[version]} | {node for node, _ in starts[version]}:
            here = held[node]
            has_parent, parent, _ = max(here, default=(False, None, False))
            link = (parent if has_parent else None, here.total() or 1)
            if links.get(node, (None, 1)) != link:
                moved[node] = link
            flag = any(flag for _, _, flag in here)
            if flag and node not in flagged:
                flagged.add(node)
                heapq.heappush(highest, -node)
            elif not flag and node != router:
                flagged.discard(node)
        for node in moved:
            forest.cut(node)
        for node, (_, count) in moved.items():
            forest.weigh(node, count)
        for node, (parent, _) in moved.items():
            if parent is not None:
                forest.link(node, parent)
        links |= moved
        while -highest[0] not in flagged:
            heapq.heappop(highest)
        if not seen:
            continue
        root = -highest[0]
        count, depths, deepest = forest.below(root)
        longest, total, pairs = forest.totals()
        depth = (depths / count, 1, deepest) if count else (0.0, None, None)
        out.append((network, version, root, *depth, longest, float(total) / float(pairs) if pairs else 0.0))
    names = [field.split()[0] for field in SHAPES.split(", ")]
    return pd.DataFrame(out, columns=names).astype({"depth_min": "Int64", "depth_max": "Int64"})
