"""Skeletons of voxel bodies, block by block, and their fusion to one skeleton per body.

Tracing runs on bodies of blocks, many of them as one graph, fusion on one body's fragments: both are grouped calls on
buckets, and the fragments' way from one to the other is the shuffle by body.
"""

from __future__ import annotations

import errno
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import AXES, block_of
from .graph import components, labels, least_forest, lengths, near_pairs, short_tips

#: Voxels of a component to be traced, of a path to be kept, and around a path that it covers.
DUST, MIN_LENGTH, COVER_SCALE, COVER_CONST = 50, 10.0, 1.2, 2.0
#: The 13 forward steps of the 26-neighbourhood.
STEPS = np.array([(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) > (0, 0, 0)])


def depth(cells: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None) -> np.ndarray:
    """Distance of each voxel to the nearest one that isn't in the list, axis by axis. Nothing is known, and so
    nothing is background, before the corner low and beyond the corner high; without them all else is. Where no
    background is known at all, the distance is the length of the longest axis."""
    first, last = cells.min(axis=0) - 1, cells.max(axis=0) + 1
    first = first if low is None else np.maximum(first, low)
    last = last if high is None else np.minimum(last, high)
    square = np.zeros(last - first + 1)
    square[tuple((cells - first).T)] = np.inf
    for axis in range(3):
        rows = np.moveaxis(square, axis, 0)
        out = rows.copy()
        for step in range(1, len(rows)):
            if step * step >= out.max():
                break
            out[step:] = np.minimum(out[step:], rows[:-step] + step * step)
            out[:-step] = np.minimum(out[:-step], rows[step:] + step * step)
        square = np.moveaxis(out, 0, axis)
    found = np.sqrt(square[tuple((cells - first).T)])
    return np.where(np.isinf(found), float(max(square.shape)), found)


def neighbours(cells: np.ndarray, group: np.ndarray | None = None) -> np.ndarray:
    """Pairs of touching voxels (of one group), by place in the list, which must be in order of group and place; no
    place is negative."""
    shape = cells.max(axis=0) + 2
    group = np.zeros(len(cells), np.int64) if group is None else group
    key = lambda c: ((group * (shape[0] + 1) + c[:, 0] + 1) * (shape[1] + 1) + c[:, 1] + 1) * (shape[2] + 1) + c[:, 2] + 1
    flat, pairs = key(cells), []
    for step in STEPS:
        to = key(cells + step)
        at = np.minimum(np.searchsorted(flat, to), len(flat) - 1)
        hit = np.flatnonzero(flat[at] == to)
        pairs.append(np.stack([hit, at[hit]], axis=1))
    return np.concatenate(pairs)


@dataclass
class Ways:
    """Both directions of edges between vertices, in order of the vertex that they leave."""

    first: np.ndarray
    out: np.ndarray
    to: np.ndarray
    edge: np.ndarray

    @staticmethod
    def of(n: int, pairs: np.ndarray) -> "Ways":
        out = np.concatenate([pairs[:, 0], pairs[:, 1]])
        order = np.argsort(out, kind="stable")
        return Ways(np.searchsorted(out[order], np.arange(n + 1)), out[order], np.concatenate([pairs[:, 1], pairs[:, 0]])[order], np.concatenate([np.arange(len(pairs))] * 2)[order])

    def costs(self, weight: np.ndarray, sources: np.ndarray) -> np.ndarray:
        """The least cost from a source to each vertex, infinite where there is no way. The cheapest of what
        changed goes on first, a band of costs at a time, in all parts of the graph at once."""
        n, w = len(self.first) - 1, weight[self.edge]
        cost = np.full(n, np.inf)
        cost[sources] = 0.0
        band = float(w.mean()) / 2 if len(w) else 1.0
        waiting = np.unique(sources)
        while len(waiting):
            level = cost[waiting]
            go = level <= level.min() + band
            front, waiting = waiting[go], waiting[~go]
            count = self.first[front + 1] - self.first[front]
            at = np.arange(count.sum()) + np.repeat(self.first[front] - (np.cumsum(count) - count), count)
            new = np.repeat(cost[front], count) + w[at]
            better = new < cost[self.to[at]]
            to = self.to[at[better]]
            np.minimum.at(cost, to, new[better])
            waiting = np.unique(np.concatenate([waiting, to]))
        return cost

    def before(self, weight: np.ndarray, cost: np.ndarray) -> np.ndarray:
        """The vertex before each one on its cheapest way, of equally cheap ones the one with the least cost, and the
        first of these; -1 for sources."""
        step = np.flatnonzero((cost[self.out] + weight[self.edge] == cost[self.to]) & np.isfinite(cost[self.to]))
        a, b = self.out[step], self.to[step]
        order = np.lexsort((a, cost[a], b))
        a, b = a[order], b[order]
        lead = np.diff(b, prepend=-1) > 0
        up = np.full(len(cost), -1, np.int64)
        up[b[lead]] = a[lead]
        return up


def _paths(cells: np.ndarray, radius: np.ndarray, far: np.ndarray, before: list[int], root: int, targets: list[int], min_length: float) -> tuple[list[int], list[tuple[int, int]]]:
    """Vertices and edges of a component's paths: to all targets, then to the furthest voxel that no path covers yet."""
    covered, on, edges = np.zeros(len(cells), bool), {root}, []
    reach = (COVER_SCALE * radius + COVER_CONST) ** 2
    while True:
        must = bool(targets)
        tip = targets.pop() if must else int(np.argmax(np.where(covered, -1.0, far)))
        if not must and covered[tip]:
            break
        path = [tip]
        while path[-1] not in on:
            path.append(before[path[-1]])
        line = np.array(path)
        if must or not edges:
            keep = True
        else:
            steps = np.sqrt(((cells[line[1:]] - cells[line[:-1]]) ** 2).sum(axis=1))
            keep = sum(steps[~covered[line[:-1]]].tolist()) >= min_length
        if keep:
            edges += list(zip(path, path[1:]))
            on.update(path)
        for k in range(0, len(line), 64):  # what the path stands for, and at least itself
            some = line[k : k + 64]
            left = np.flatnonzero(~covered)
            near = ((cells[left, None] - cells[None, some]) ** 2).sum(axis=2) <= reach[some]
            covered[left[near.any(axis=1)]] = True
        covered[line] = True
    return sorted(on), edges


def traces(cells: np.ndarray, doors: np.ndarray, group: np.ndarray, corners: list[tuple[np.ndarray | None, np.ndarray | None]], dust: int = DUST, min_length: float = MIN_LENGTH) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """trace of many groups of voxels (numbered from 0, in order) as one graph: of each its voxels' places in the whole
    list, their radii, and edges. corners has low and high of each group."""
    if not len(cells):
        return []
    order = np.lexsort((*cells.T[::-1], group))
    cells, doors, group = cells[order], doors[order], group[order]
    start = np.searchsorted(group, np.arange(len(corners) + 1))
    spans = list(zip(start[:-1].tolist(), start[1:].tolist()))
    radius = np.concatenate([depth(cells[a:b], *c) for (a, b), c in zip(spans, corners)])
    cells = np.concatenate([cells[a:b] - cells[a:b].min(axis=0) for a, b in spans])
    pairs = neighbours(cells, group)
    label = labels(len(cells), pairs)
    size = np.bincount(label, minlength=len(cells))
    pairs = pairs[size[label[pairs[:, 0]]] >= dust]
    step = np.sqrt(((cells[pairs[:, 0]] - cells[pairs[:, 1]]) ** 2).sum(axis=1))
    ways, cost = Ways.of(len(cells), pairs), 1.0 / (1.0 + radius**2)
    parts = np.flatnonzero((label == np.arange(len(cells))) & (size >= dust))
    # the deepest voxel of each patch of doors, in order of the patches
    patch = labels(len(cells), pairs[doors[pairs].all(axis=1)])
    own = np.flatnonzero(doors & (size[label] >= dust))
    own = own[np.lexsort((own, -radius[own], patch[own], label[own]))]
    own = own[np.diff(patch[own], prepend=-1) != 0]
    targets: dict[int, list[int]] = {p: [] for p in parts.tolist()}
    for p, i in zip(label[own].tolist(), own.tolist()):
        targets[p].append(i)
    # a path begins at a door if there is one, not at the rim of the face
    rims = ways.costs(step, np.array([p for p in targets if not targets[p]], np.int64))
    members = np.argsort(label, kind="stable")
    first = np.searchsorted(label[members], parts)
    held = {p: members[a : a + n] for p, a, n in zip(parts.tolist(), first.tolist(), size[parts].tolist())}
    roots = {p: t.pop() if t else int(held[p][np.argmax(rims[held[p]])]) for p, t in targets.items()}
    at = np.array(list(roots.values()), np.int64)
    far = ways.costs(step, at)
    weight = step * (cost[pairs[:, 0]] + cost[pairs[:, 1]])
    before = ways.before(weight, ways.costs(weight, at))
    place = np.zeros(len(cells), np.int64)
    used: list[dict[int, int]] = [{} for _ in corners]
    edges: list[list[tuple[int, int]]] = [[] for _ in corners]
    for p, whole in held.items():
        place[whole] = np.arange(len(whole))
        up = np.where(before[whole] < 0, -1, place[before[whole]]).tolist()
        on, tied = _paths(cells[whole], radius[whole], far[whole], up, int(place[roots[p]]), place[targets[p]].tolist(), min_length)
        names, g = whole.tolist(), int(group[p])
        edges[g] += [(names[a], names[b]) for a, b in tied]
        for i in on:
            used[g][names[i]] = len(used[g])
    out = []
    for own_, tied in zip(used, edges):
        keep = np.array(list(own_), np.int64)
        out.append((order[keep], radius[keep], np.array([(own_[a], own_[b]) for a, b in tied], np.int64).reshape(-1, 2)))
    return out


def trace(cells: np.ndarray, doors: np.ndarray, dust: int = DUST, min_length: float = MIN_LENGTH, low: np.ndarray | None = None, high: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Voxels of the skeleton, their radii, and edges. doors marks voxels on a face of the block beyond
    which the body may go on: the deepest voxel of each patch of them is always reached. low and high are the
    corners of what is known, as the depth has it."""
    return traces(cells, doors, np.zeros(len(cells), np.int64), [(low, high)], dust, min_length)[0]


#: Bodies of blocks that are traced as one graph, and buckets of them a shuffle partition.
TOGETHER, BUCKETS = 64, 16


def dealt(df: DataFrame, key: list[str]) -> DataFrame:
    """Adds a bucket, a hash of the key, so that small groups share a Python call."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


FRAGMENT = "body_id long, block string, node long, z_nm double, y_nm double, x_nm double, radius_nm double, links array<long>"


def skeletonize_blocks(voxels: DataFrame, block: int, nm: float, dust: int = DUST, min_length: float = MIN_LENGTH) -> DataFrame:
    """Fragments: the skeleton nodes of each body in each block, each with the nodes before it that it is
    linked to. Blocks share their faces' voxels, so that fragments of neighbours meet."""
    own = voxels.where("body_id <> 0").select(F.col("body_id").cast("long").alias("body_id"), *AXES, *block_of(block))
    shared = own
    for a in AXES:  # the first layer of a block belongs to the one before as well
        again = shared.where((F.col(a) % block == 0) & (F.col(f"b{a}") > 0) & (F.floor(F.col(a) / block) == F.col(f"b{a}"))).withColumn(f"b{a}", F.col(f"b{a}") - 1)
        shared = shared.unionByName(again)

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("body_id", "bz", "by", "bx")])
        get = lambda names: np.stack([table.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        cells, at, body = get(AXES), get(("bz", "by", "bx")) * block, table.column("body_id").to_numpy()
        doors = ((cells == at) & (at > 0)).any(axis=1) | (cells == at + block).any(axis=1)
        start = np.flatnonzero(np.r_[True, (body[1:] != body[:-1]) | (at[1:] != at[:-1]).any(axis=1)])
        ends = np.append(start[1:], len(body))
        rows, sizes, node, radii, near = [], [], [], [], []
        for k in range(0, len(start), TOGETHER):
            some, a, b = start[k : k + TOGETHER], start[k], ends[k : k + TOGETHER][-1]
            group = np.repeat(np.arange(len(some)), np.diff(np.append(some, b)))
            for keep, radius, edges in traces(cells[a:b], doors[a:b], group, [(at[i], at[i] + block) for i in some], dust, min_length):
                own: list[list[int]] = [[] for _ in keep]
                for p, q in edges.tolist():
                    own[max(p, q)].append(min(p, q))
                rows.append(a + keep)
                sizes.append(len(keep))
                node.append(np.arange(len(keep)))
                radii.append(radius * nm)
                near += own
        rows = np.concatenate(rows)
        names = np.repeat(np.array(["_".join(map(str, b // block)) for b in at[start]], object), sizes)
        columns = [pa.array(body[rows]), pa.array(names, pa.string()), pa.array(np.concatenate(node)), *[pa.array(cells[rows, c] * nm) for c in range(3)], pa.array(np.concatenate(radii)), pa.array(near, pa.list_(pa.int64()))]
        return pa.table(columns, [f.strip().split(" ")[0] for f in FRAGMENT.split(", ")])

    return dealt(shared, ["body_id", "bz", "by", "bx"]).groupBy("bucket").applyInArrow(work, FRAGMENT)


# ---- fusion ---------------------------------------------------------------------------------------
@dataclass
class Shape:
    """A skeleton in the middle of fusion."""

    v: np.ndarray
    r: np.ndarray
    e: np.ndarray

    def parts(self) -> np.ndarray:
        return components(len(self.v), self.e)

    def cable(self) -> float:
        return float(lengths(self.v, self.e).sum())

    def degree(self) -> np.ndarray:
        return np.bincount(self.e.ravel(), minlength=len(self.v)) if len(self.e) else np.zeros(len(self.v), int)

    def only(self, keep: np.ndarray) -> "Shape":
        new = np.cumsum(keep) - 1
        e = self.e[keep[self.e].all(axis=1)] if len(self.e) else self.e
        return Shape(self.v[keep], self.r[keep], new[e].reshape(-1, 2))

    def profile(self) -> dict:
        d = self.degree()
        return {"comps": len(np.unique(self.parts())), "cable": self.cable(), "tips": int((d == 1).sum()), "branches": int((d > 2).sum()), "verts": len(self.v)}


def welded(s: Shape) -> Shape:
    """Vertices at one place are one, with the largest radius; repeated edges and loops go."""
    v, at = np.unique(np.round(s.v, 3), axis=0, return_inverse=True)
    r = np.zeros(len(v))
    np.maximum.at(r, at.ravel(), s.r)
    e = np.sort(at.ravel()[s.e].reshape(-1, 2), axis=1)
    return Shape(v, r, np.unique(e[e[:, 0] != e[:, 1]], axis=0).reshape(-1, 2))


def joined(s: Shape, radius: float | None) -> Shape:
    """Joins components by their shortest links, nearest first: up to the radius, or for None where the
    ends' balls meet."""
    label = s.parts()
    if len(np.unique(label)) < 2:
        return s
    pairs = near_pairs(s.v, radius if radius is not None else 2 * float(s.r.max()))
    if radius is None:
        pairs = pairs[lengths(s.v, pairs) <= s.r[pairs[:, 0]] + s.r[pairs[:, 1]]]
    return Shape(s.v, s.r, np.concatenate([s.e, least_forest(s.v, label, pairs)]))


def without_dust(s: Shape, least: float) -> Shape:
    label = s.parts()
    cable = np.zeros(len(s.v))
    if len(s.e):
        np.add.at(cable, label[s.e[:, 0]], lengths(s.v, s.e))
    return s.only(cable[label] >= least)


def without_loops(s: Shape) -> Shape:
    """A spanning forest of the shortest edges."""
    from .graph import Union

    sets = Union(len(s.v))
    order = np.argsort(lengths(s.v, s.e), kind="stable")
    return Shape(s.v, s.r, s.e[sorted(k for k in order.tolist() if sets.join(int(s.e[k, 0]), int(s.e[k, 1])))].reshape(-1, 2))


def without_ticks(s: Shape, least: float) -> Shape:
    """Side branches shorter than this go, shortest first; a component's last path stays."""
    while True:
        d = s.degree()
        near: dict[int, list[int]] = {i: [] for i in range(len(s.v))}
        for a, b in s.e.tolist():
            near[a].append(b)
            near[b].append(a)
        ticks = []
        for tip in np.flatnonzero(d == 1).tolist():
            path, size = [tip], 0.0
            while d[path[-1]] < 3:
                ahead = [j for j in near[path[-1]] if j not in path[-2:]]
                if not ahead:
                    break
                size += float(np.linalg.norm(s.v[path[-1]] - s.v[ahead[0]]))
                path.append(ahead[0])
            if d[path[-1]] > 2 and size < least:
                ticks.append((size, path[:-1]))
        if not ticks:
            return s
        keep = np.ones(len(s.v), bool)
        keep[min(ticks)[1]] = False
        s = s.only(keep)


def fuse(s: Shape, seam: float, dust: float, tick: float) -> tuple[Shape, dict]:
    """Seams, dust, loops, touching ends, ticks, in this order, and what each step did."""
    stats: dict = {}
    s = welded(s)
    p0 = s.profile()
    s = joined(s, seam) if seam > 0 else s
    p1 = s.profile()
    s = without_dust(s, dust)
    p2 = s.profile()
    s = without_loops(s)
    p3 = s.profile()
    s = joined(s, None)
    p4 = s.profile()
    s = without_ticks(s, tick)
    p5 = s.profile()
    stats |= {"comps_in": p0["comps"], "cable_in_nm": p0["cable"], "cable_joined_nm": p1["cable"], "seam_join_comps_merged": p0["comps"] - p1["comps"], "seam_join_cable_added_nm": p1["cable"] - p0["cable"]}
    stats |= {"dust_comps_dropped": p1["comps"] - p2["comps"], "dust_cable_dropped_nm": p1["cable"] - p2["cable"], "loop_cable_delta_nm": p3["cable"] - p2["cable"]}
    stats |= {"radius_join_comps_merged": p3["comps"] - p4["comps"], "radius_join_cable_added_nm": p4["cable"] - p3["cable"], "tick_branches_removed": max(0, p4["tips"] - p5["tips"]), "tick_cable_removed_nm": p4["cable"] - p5["cable"]}
    stats |= {"comps_out": p5["comps"], "cable_out_nm": p5["cable"], "tips_out": p5["tips"], "branches_out": p5["branches"], "deleted": p5["verts"] == 0}
    return s, stats


STATS = "body_id long, status string, error string, n_fragments long, comps_in long, cable_in_nm double, cable_joined_nm double, seam_join_comps_merged long, seam_join_cable_added_nm double, dust_comps_dropped long, dust_cable_dropped_nm double, loop_cable_delta_nm double, radius_join_comps_merged long, radius_join_cable_added_nm double, tick_branches_removed long, tick_cable_removed_nm double, comps_out long, cable_out_nm double, tips_out long, branches_out long, deleted boolean, max_radius_nm double, z_nm array<double>, y_nm array<double>, x_nm array<double>, radii array<double>, src array<long>, dst array<long>"


#: Errors of the system, not of a body: no space, quota used up, read-only disk.
SYSTEM = {errno.ENOSPC, errno.EDQUOT, errno.EROFS}


def systemic(error: BaseException) -> bool:
    """Whether the next body would fail as well."""
    return isinstance(error, (MemoryError, ImportError)) or (isinstance(error, OSError) and error.errno in SYSTEM)


def guarded(work, body):
    """work(body), or a row of the status failed with the error's text; errors of the system stop the job."""
    try:
        return work(body)
    except Exception as error:
        if systemic(error):
            raise
        return {"status": "failed", "error": f"{type(error).__name__}: {error}"}


def _by_body(table: pa.Table):
    """Each body's id and its fragments: number of blocks, places, radii, and edges between places."""
    table = table.sort_by([(c, "ascending") for c in ("body_id", "block", "node")])
    body, node = (table.column(c).to_numpy() for c in ("body_id", "node"))
    block = table.column("block").to_pylist()
    v = np.stack([table.column(c).to_numpy() for c in ("z_nm", "y_nm", "x_nm")], axis=1)
    r, links = table.column("radius_nm").to_numpy(), table.column("links").to_pylist()
    start = np.flatnonzero(np.diff(body, prepend=body[:1] - 1)).tolist()
    for a, b in zip(start, [*start[1:], len(body)]):
        base, n, e = 0, 0, []
        for i in range(a, b):
            if i == a or block[i] != block[i - 1]:
                base, n = i - a, n + 1
            e += [(base + int(node[i]), base + k) for k in links[i]]
        yield int(body[a]), (n, v[a:b], r[a:b], np.array(e, np.int64).reshape(-1, 2))


def _told(rows: list[dict], schema: str) -> pa.Table:
    """The rows as a table of the schema's columns; null what a row hasn't."""
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    fields = [f.strip().split(" ") for f in schema.split(", ")]
    return pa.table([pa.array([r.get(n) for r in rows], kinds[t]) for n, t in fields], [n for n, _ in fields])


def _fused(body: tuple[int, np.ndarray, np.ndarray, np.ndarray], seam: float, dust: float, tick: float) -> dict:
    n, v, r, e = body
    s, stats = fuse(Shape(v, r, e), seam, dust, tick)
    row = stats | {"status": "dust" if stats["deleted"] else "written", "n_fragments": n, "max_radius_nm": float(s.r.max()) if len(s.r) else None}
    return row | {"z_nm": s.v[:, 0], "y_nm": s.v[:, 1], "x_nm": s.v[:, 2], "radii": s.r, "src": s.e[:, 0], "dst": s.e[:, 1]}


def join_radius(radius: float | None, nm: tuple[float, float, float]) -> float:
    """How far apart ends may be to be joined: as given, or twice the longest side of a voxel."""
    return 2 * max(nm) if radius is None else radius


def fuse_bodies(fragments: DataFrame, seam: float, dust: float = 500.0, tick: float = 500.0) -> DataFrame:
    """A row per body: status (written, or dust), what each step did, and the skeleton. A body whose
    fusion fails has the status failed and the error's text, and stops no other."""

    def work(table: pa.Table) -> pa.Table:
        out = [guarded(lambda b: _fused(b, seam, dust, tick), one) | {"body_id": body} for body, one in _by_body(table)]
        return _told(out, STATS)

    return dealt(fragments, ["body_id"]).groupBy("bucket").applyInArrow(work, STATS)


def fusion_grid(fragments: DataFrame, seam: float, dusts: list[float], ticks: list[float]) -> DataFrame:
    """What each pair of thresholds leaves: (dust, tick) and the totals of fusion_summary. Each body is fused
    for all pairs where its fragments are, so they move once."""
    schema = "dust double, tick double, " + ", ".join(STATS.split(", ")[:-6])

    def work(table: pa.Table) -> pa.Table:
        out = []
        for body, one in _by_body(table):
            for dust in dusts:
                for tick in ticks:
                    row = guarded(lambda b: _fused(b, seam, dust, tick), one)  # noqa: B023
                    out.append({"dust": dust, "tick": tick} | row | {"body_id": body})
        return _told(out, schema)

    return fusion_summary(dealt(fragments, ["body_id"]).groupBy("bucket").applyInArrow(work, schema), ["dust", "tick"])


def fusion_summary(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals over bodies, of each group if any, counts of deleted and of still broken ones, and fractions of the cable."""
    summed = [n for n, t in stats.dtypes if t in ("bigint", "double") and n not in (*(by or []), "body_id", "tips_out", "branches_out", "max_radius_nm")]
    out = stats.groupBy(*(by or [])).agg(F.count("*").alias("n_bodies"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in summed], F.count_if("deleted").alias("n_deleted"), F.count_if(F.col("comps_out") > 1).alias("n_multi"))
    part = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), F.lit(0.0))
    return out.withColumn("dropped_fraction", part(F.col("dust_cable_dropped_nm") + F.col("tick_cable_removed_nm"), F.col("cable_in_nm"))).withColumn("inferred_fraction", part(F.col("seam_join_cable_added_nm") + F.col("radius_join_cable_added_nm"), F.col("cable_out_nm")))


def twigs(v: np.ndarray, e: np.ndarray, least: float) -> int:
    """Tips whose path to the first branch point is shorter than this; see ``short_tips``."""
    return len(short_tips(v, e, least))
