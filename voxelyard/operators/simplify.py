"""Thinning of skeletons by radius: sampling by regions, and merges of redundant nodes.

Both are sequential by definition, node after node within a body. Bodies come in buckets: samples go through a bucket's
bodies one by one, merges run on all of them as one forest."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .graph import Union
from .paths import AXES, _buckets

#: Defaults of the merge: how much radii may differ, and how far a node may lie off the line.
RADIUS_SCALE, DISTANCE_SCALE = 1.2, 2.0
#: Whose place two merged nodes take: that of the one above, of the one below, or a mean.
UPPER, LOWER, BOTH = 1, 2, 3


def region_keep(v: np.ndarray, r: np.ndarray, edges: np.ndarray, spare_junctions: bool = True) -> np.ndarray:
    """Which nodes stay if the thickest ones, in turn, drop all others strictly within their radius.
    With spare_junctions, tips and branch points are never dropped."""
    degree = np.bincount(edges.ravel(), minlength=len(v)) if len(edges) else np.zeros(len(v), int)
    safe = (degree == 1) | (degree > 2) if spare_junctions else np.zeros(len(v), bool)
    state = np.zeros(len(v), np.int8)  # 1 stays, 2 is gone
    for i in sorted(range(len(v)), key=lambda i: (-r[i], i)):
        if state[i] == 0:
            state[i] = 1
            within = (((v - v[i]) ** 2).sum(axis=1) < r[i] ** 2) & (state == 0) & ~safe
            state[within] = 2
    return state == 1


def rewired(r: np.ndarray, edges: np.ndarray, keep: np.ndarray) -> list[tuple[int, int]]:
    """Edges over the nodes that stay: their own, and for each connected clump of others a star over the
    nodes around it, on the thickest one."""
    clumps = Union(len(keep))
    own, rim = set(), {}
    for a, b in edges:
        if not keep[a] and not keep[b]:
            clumps.join(int(a), int(b))
    for a, b in edges:
        if keep[a] and keep[b]:
            own.add((int(min(a, b)), int(max(a, b))))
        elif keep[a] or keep[b]:
            inner, outer = (int(b), int(a)) if keep[a] else (int(a), int(b))
            rim.setdefault(clumps.find(inner), set()).add(outer)
    for around in rim.values():
        hub = max(sorted(around), key=lambda i: r[i])
        own |= {(min(hub, i), max(hub, i)) for i in around if i != hub}
    return sorted(e for e in own if e[0] != e[1])


@dataclass
class Chain:
    """The tubes of a rooted forest, a row for each node: place, radius, how many nodes it stands for,
    the row above (-1 for a root), and whether it is still there."""

    place: np.ndarray
    radius: np.ndarray
    count: np.ndarray
    above: np.ndarray
    there: np.ndarray

    @staticmethod
    def rooted(place: np.ndarray, radius: np.ndarray, edges: np.ndarray) -> "Chain":
        """Each component hangs on its thickest node, the first of equal ones."""
        n = len(place)
        ends = np.concatenate([edges, edges[:, ::-1]]) if len(edges) else np.zeros((0, 2), np.int64)
        ends = ends[np.argsort(ends[:, 0], kind="stable")]
        first = np.searchsorted(ends[:, 0], np.arange(n + 1))
        above, seen = np.full(n, -1, np.int64), np.zeros(n, bool)
        for root in np.argsort(-radius, kind="stable").tolist():
            rim = [] if seen[root] else [root]
            seen[root] = True
            while rim:  # a level at a time
                below = []
                for i in rim:
                    for j in ends[first[i] : first[i + 1], 1].tolist():
                        if not seen[j]:
                            seen[j], above[j] = True, i
                            below.append(j)
                rim = below
        return Chain(np.array(place, float), np.array(radius, float), np.ones(n), above, np.ones(n, bool))

    def depth(self) -> np.ndarray:
        """Steps up to the root, by doubling."""
        out, at = (self.above >= 0).astype(np.int64), self.above.copy()
        while (on := np.flatnonzero(at >= 0)).size:
            out[on], at[on] = out[on] + out[at[on]], at[at[on]]
        return out

    def redundant(self, radius_scale: float, distance_scale: float) -> np.ndarray:
        """Of each node whether it need not stand beside the node above it, and which place the two of
        them take: 0 if it must stay, UPPER, LOWER, or BOTH for a mean by count.

        A ball within the other adds nothing, so the larger one's place holds.  Of balls where one covers
        the other's centre, on an unbranched run at either of the two, the mean keeps the run; a tip keeps
        its own place, so no cable is lost.  A node amid a run that touches the one above is redundant if
        the tube between its neighbours passes through it: near its centre by distance_scale, and as
        thick by radius_scale; corners and swellings aren't."""
        live = np.flatnonzero(self.there & (self.above >= 0))
        out = np.zeros(len(self.above), np.int8)
        if not len(live):
            return out
        kids = np.bincount(self.above[live], minlength=len(self.above))
        only = np.full(len(self.above), -1, np.int64)
        only[self.above[live]] = live  # of a single child, that child
        run = (kids == 1) & (self.above >= 0)
        up, own = self.above[live], live
        gap = np.linalg.norm(self.place[own] - self.place[up], axis=1)
        r, R = self.radius[own], self.radius[up]
        down = np.where(run[own], only[own], own)
        rest = np.linalg.norm(self.place[down] - self.place[own], axis=1)
        share = np.divide(rest, gap + rest, out=np.zeros(len(own)), where=gap + rest > 0)
        tube = share * R + (1 - share) * self.radius[down]
        off = np.linalg.norm(share[:, None] * self.place[up] + (1 - share[:, None]) * self.place[down] - self.place[own], axis=1)
        passes = run[own] & (gap + rest > 0) & (gap < r + R) & (off * distance_scale < tube) & (r < tube * radius_scale) & (tube < r * radius_scale)
        covers = (gap < np.maximum(r, R)) & (run[own] | run[up])
        cases = [gap + r <= R, gap + R <= r, covers & (kids[own] == 0), covers, passes]
        out[live] = np.select(cases, [UPPER, LOWER, LOWER, BOTH, UPPER], 0)
        return out

    def absorb(self, own: np.ndarray, how: np.ndarray) -> None:
        """Takes the nodes away; what hangs on them hangs on the node above. Of two under one node, one at most may
        change its place."""
        up = self.above[own]
        whole = (self.count[own] + self.count[up])[:, None]
        both = np.column_stack([self.place, self.radius])
        mean = (both[own] * self.count[own, None] + both[up] * self.count[up, None]) / whole
        new = np.select([(how == UPPER)[:, None], (how == LOWER)[:, None]], [both[up], both[own]], mean)
        self.place[up], self.radius[up] = new[:, :3], new[:, 3]
        self.count[up] = np.where(how == BOTH, whole[:, 0], self.count[up])
        self.there[own] = False
        to = np.arange(len(self.above))
        to[own] = up
        moved = self.above >= 0
        self.above[moved] = to[self.above[moved]]
        self.above[own] = -1

    def settle(self, radius_scale: float, distance_scale: float, group: np.ndarray | None = None) -> None:
        """Every other level at a time, so that no node goes together with the one above it, until nothing
        is redundant. Those that leave the node above as it is go all at once, of the others one under each node;
        a run of nodes halves with each pass. What goes in one group of nodes doesn't depend on other groups."""
        group = np.zeros(len(self.above), np.int64) if group is None else group
        gone = True
        while gone:
            gone = False
            for odd in (1, 0):
                found = self.redundant(radius_scale, distance_scale)
                own = np.flatnonzero((found > 0) & (self.depth() % 2 == odd))
                plain = own[found[own] == UPPER]
                other = own[~np.isin(group[own], group[plain])]
                plain = np.sort(np.concatenate([plain, other[np.unique(self.above[other], return_index=True)[1]]]))
                if len(plain):
                    self.absorb(plain, found[plain])
                    gone = True

    def links(self) -> list[tuple[int, int]]:
        own = np.flatnonzero(self.there & (self.above >= 0))
        return list(zip(own.tolist(), self.above[own].tolist()))


SCHEMA = "body_id long, node_id long, z_nm double, y_nm double, x_nm double, radius_nm double, neighbours array<long>"


def _out(bodies: np.ndarray, ids: np.ndarray, v: np.ndarray, r: np.ndarray, keep: np.ndarray, edges: list[tuple[int, int]]) -> pd.DataFrame:
    near: dict[int, list[int]] = {i: [] for i in keep.tolist()}
    names = ids.tolist()
    for a, b in edges:
        near[a].append(names[b])
        near[b].append(names[a])
    out = {"body_id": bodies[keep], "node_id": ids[keep], **{a: v[keep, k] for k, a in enumerate(AXES)}, "radius_nm": r[keep]}
    return pd.DataFrame(out | {"neighbours": pd.Series([sorted(x) for x in near.values()], dtype=object)})


def _columns(n: pd.DataFrame, e: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Bodies, ids, places and radii of nodes, and edges."""
    return n["body_id"].to_numpy(np.int64), n["node_id"].to_numpy(np.int64), n[AXES].to_numpy(float).reshape(-1, 3), n["radius_nm"].to_numpy(float), e[["src", "dst"]].to_numpy(np.int64).reshape(-1, 2)


def _asked(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    return nodes.select("body_id", "node_id", *AXES, "radius_nm"), edges.select("body_id", "edge_id", "src", "dst")


def region_sample(nodes: DataFrame, edges: DataFrame, spare_junctions: bool = True) -> DataFrame:
    """Nodes that stay, each with its neighbours' ids."""

    def work(n, e):
        bodies, ids, v, r, ends = _columns(n, e)
        keep, tied = np.zeros(len(n), bool), []
        first = np.flatnonzero(np.r_[True, bodies[1:] != bodies[:-1]]) if len(n) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(n))
        ends = ends[np.argsort(bodies[ends[:, 0]], kind="stable")]
        of = bodies[ends[:, 0]]
        for a, b, c, d in zip(first.tolist(), last.tolist(), np.searchsorted(of, bodies[first]).tolist(), np.searchsorted(of, bodies[first], "right").tolist()):
            own = ends[c:d] - a
            stay = region_keep(v[a:b], r[a:b], own, spare_junctions)
            keep[a:b] = stay
            tied += [(a + x, a + y) for x, y in rewired(r[a:b], own, stay)]
        return _out(bodies, ids, v, r, np.flatnonzero(keep), tied)

    return _buckets(*_asked(nodes, edges), work, SCHEMA)


def optimal_downsample(nodes: DataFrame, edges: DataFrame, radius_scale: float = RADIUS_SCALE, distance_scale: float = DISTANCE_SCALE) -> DataFrame:
    """Nodes after all merges, each with its neighbours' ids."""

    def work(n, e):
        bodies, ids, v, r, ends = _columns(n, e)
        chain = Chain.rooted(v, r, ends)
        chain.settle(radius_scale, distance_scale, bodies)
        return _out(bodies, ids, chain.place, chain.radius, np.flatnonzero(chain.there), chain.links())

    return _buckets(*_asked(nodes, edges), work, SCHEMA)
