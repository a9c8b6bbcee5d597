"""Volumes in chunks and bricks, fields, surfaces, run regions and wide graphs on shapes whose answers are known."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelyard.operators import fields, graph, paths, regions, volume, wide
from voxelyard.sources import bricks, chunks
from voxelyard.sources.scratch import folder

CELL = "z int, y int, x int, body_id long"


def voxels(spark, cells, body=1):
    return spark.createDataFrame([(*map(int, c), body) for c in cells], CELL)


def random_cells(seed, shape, share=0.4):
    draw = np.random.default_rng(seed)
    return np.argwhere(draw.random(shape) < share)


# ---- chunks -----------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def written(spark):
    cells = random_cells(1, (20, 13, 7))
    path = folder(spark, "chunk-test")
    rows = voxels(spark, cells).union(spark.createDataFrame([(0, 0, 0, 9), (0, 0, 0, 3), (1, 1, 1, 0), (25, 0, 0, 4)], CELL))
    return path, chunks.write(rows, path, (20, 13, 7), 8, (8.0, 4.0, 2.0)), {tuple(map(int, c)) for c in cells}


def test_region_reads_its_blocks_alone(spark, written):
    path, info, cells = written
    assert info == chunks.Info((20, 13, 7), 8, (8.0, 4.0, 2.0))
    assert chunks.read(spark, path).rdd.getNumPartitions() == 3 * 2 * 1
    df = chunks.region(spark, path, (9, 2, 1, 15, 7, 6))
    assert df.rdd.getNumPartitions() == 1
    assert {(r["z"], r["y"], r["x"]) for r in df.collect()} == {c for c in cells if 9 <= c[0] < 15 and 2 <= c[1] < 7 and 1 <= c[2] < 6}
    assert chunks.read(spark, path).where("z = 3 and y > 7").rdd.getNumPartitions() == 1
    assert chunks.read(spark, path).where("z > 30").count() == 0
    assert {r[0] for r in chunks.read(spark, path).where("body_id = 1 and x <= 0").select("x").collect()} == {0}


def test_background_and_columns(spark, written):
    path, _, cells = written
    whole = chunks.read(spark, path, background=True)
    assert whole.count() == 20 * 13 * 7 and whole.where("body_id <> 0").count() == len(cells | {(0, 0, 0)})
    assert chunks.read(spark, path, "body_id long").columns == ["body_id"]
    first = chunks.read(spark, path).where("z = 0 and y = 0 and x = 0").first()
    assert first["body_id"] in (1, 3)  # the smallest of those at the place
    with pytest.raises(ValueError, match="no region"):
        chunks.region(spark, path, (0, 0, 0, 21, 1, 1))
    with pytest.raises(Exception, match="no columns"):
        chunks.read(spark, path, "label int").count()


def test_an_empty_volume_and_torn_files(spark):
    path = folder(spark, "chunk-test")
    chunks.write(voxels(spark, [(0, 0, 0)]).limit(0), path, (4, 4, 4), 2)
    assert chunks.read(spark, path).count() == 0 and chunks.read(spark, path, background=True).count() == 64
    store, at = chunks._store(path)
    with store.open_output_stream(f"{at}/chunks/.0_0_0-half") as f:
        f.write(b"torn")
    assert chunks.read(spark, path).count() == 0


# ---- bricks -----------------------------------------------------------------------------------------
def test_bricks_join_without_an_exchange(spark):
    cells, labels = random_cells(2, (16, 16, 8)), random_cells(3, (16, 16, 8))
    bricks.save(voxels(spark, cells), "brick_seg", 4, 4)
    bricks.save(voxels(spark, labels).select("z", "y", "x", (F.col("x") + 1).alias("label")), "brick_sem", 4, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bricks.labelled(spark, "brick_seg", "brick_sem")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        held = {tuple(map(int, c)) for c in labels}
        assert {(r["z"], r["y"], r["x"], r["label"]) for r in df.collect()} == {(*c, c[2] + 1 if c in held else 0) for c in (tuple(map(int, c)) for c in cells)}
        some = bricks.labelled(spark, "brick_seg", "brick_sem", ["0_0_0", "1_2_1"])
        text = some._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SelectedBucketsCount: 4 out of 4" not in text
        assert {(r["z"] // 4, r["y"] // 4, r["x"] // 4) for r in some.collect()} == {(0, 0, 0), (1, 2, 1)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- fields and surfaces ------------------------------------------------------------------------------
@pytest.mark.parametrize("tasks", [1, 5])
def test_distances_by_brute_force(spark, tasks):
    shape, nm = (9, 7, 11), (3.0, 2.0, 1.0)
    rows = []
    for body, seed in ((1, 4), (2, 5)):
        rows += [(*map(int, c), body) for c in random_cells(seed, shape, 0.8)]
    rows += [(*c, 3) for c in itertools.product(*map(range, shape))]  # fills the volume
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = {(r["body_id"], r["z"], r["y"], r["x"]): r["distance"] for r in fields.distance_field(spark.createDataFrame(rows + rows[:9], CELL), shape, nm).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    every = np.array([*itertools.product(*map(range, shape))])
    for body in (1, 2, 3):
        own = np.array([r[:3] for r in rows if r[3] == body])
        held = {tuple(c) for c in own.tolist()}
        out = np.array([c for c in every.tolist() if tuple(c) not in held]).reshape(-1, 3)
        for c in own.tolist():
            want = np.sqrt((((out - c) * nm) ** 2).sum(axis=1).min()) if len(out) else None
            assert got[(body, *c)] == (None if want is None else pytest.approx(want)), (body, c)


def test_a_ball_is_as_deep_as_its_radius_and_open_at_faces(spark):
    r = 6
    ball = [c for c in itertools.product(range(13), repeat=3) if sum((v - r) ** 2 for v in c) <= r * r]
    rod = [(z, y, x) for z in range(13) for y in range(4, 9) for x in range(4, 9)]
    field = fields.distance_field(voxels(spark, ball).union(voxels(spark, rod, 2)), (13, 13, 13))
    nodes = spark.createDataFrame([(1, 6.0, 6.0, 6.0, 6.0), (1, 0.0, 0.0, 0.0, 1.0), (2, 0.0, 6.0, 6.0, 3.0), (2, 12.0, 6.0, 6.0, 9.0)], "body_id long, z double, y double, x double, radius double")
    got = {r["body_id"]: r for r in fields.radius_against_field(nodes, field, (13, 13, 13)).collect()}
    assert 6 <= got[1]["deepest"] <= 7 and got[1]["n_nodes"] == 2
    assert got[2]["deepest"] == 3 and got[2]["error_p50"] == 3 and got[2]["share_over"] == 0.5 and got[2]["mean_error"] == 3


def cubes(spark):
    one, two = [(0, 0, 0)], [(1, 1, 1), (1, 1, 2), (1, 2, 1), (1, 2, 2)]
    ring = [(5, y, x) for y in range(3) for x in range(3) if (y, x) != (1, 1)]
    hollow = [c for c in itertools.product(range(3), repeat=3) if c != (1, 1, 1)]
    return voxels(spark, one).union(voxels(spark, two, 2)).union(voxels(spark, ring, 3)).union(voxels(spark, hollow, 4))


def test_euler_numbers(spark):
    """A ball has 2, a ring 0, a hollow ball 4."""
    got = {r["body_id"]: r for r in fields.closed_surfaces(cubes(spark), (8, 8, 8), (2.0, 1.0, 1.0)).collect()}
    assert {b: (r["n_vertices"], r["n_edges"], r["n_faces"], r["euler"]) for b, r in got.items()} == {1: (8, 12, 6, 2), 2: (18, 32, 16, 2), 3: (32, 64, 32, 0), 4: (64, 120, 60, 4)}
    assert {b: r["enclosed_nm3"] for b, r in got.items()} == {1: 2, 2: 8, 3: 16, 4: 52}
    assert got[1]["area_nm2"] == 2 * 1 + 4 * 2


def test_surfaces_are_closed_and_look_outward(spark):
    """Each edge is passed as often one way as the other, and triangles have the area of the faces."""
    faces = fields.quads(cubes(spark), (8, 8, 8))
    ways = {}
    for r in faces.collect():
        ring = [r[c] for c in "abcd"]
        for p, q in zip(ring, ring[1:] + ring[:1]):
            ways[r["body_id"], p, q] = ways.get((r["body_id"], p, q), 0) + 1
    assert all(ways.get((b, q, p)) == n for (b, p, q), n in ways.items())
    points = fields.corners(faces, (8, 8, 8)).select("body_id", F.col("place").alias("vertex_id"), "z", "y", "x")
    area = {r["body_id"]: r["area_nm2"] for r in volume.mesh_area(points, fields.triangles(faces)).collect()}
    assert area == {r["body_id"]: pytest.approx(r["n_faces"]) for r in fields.closed_surfaces(cubes(spark), (8, 8, 8)).collect()}


# ---- regions of runs -----------------------------------------------------------------------------------
def test_runs_of_any_length(spark):
    runs = [(0, 0, 2, 5), (0, 0, 4, 4), (0, 0, 9, 1_000_009), (1, 0, -3, -1), (2, 2, 5, 4)]
    points = [(i, float(z), float(y), float(x)) for i, (z, y, x) in enumerate((z, y, x) for z in (0, 1, 2) for y in (0, 2) for x in (-4, -3, 0, 2, 4, 5, 6, 9, 500_000, 1_000_009, 1_000_010))]
    df = spark.createDataFrame([(*p, 1) for p in points], "id int, z double, y double, x double, kind int")
    got = regions.in_runs(df, spark.createDataFrame(runs, "z int, y int, x0 int, x1 int"), (1.0, 1.0, 1.0))
    assert got.columns == ["id", "z", "y", "x", "kind", "in_roi"] and got.schema["kind"].dataType == df.schema["kind"].dataType
    want = {i: any(r[0] == z and r[1] == y and r[2] <= x <= r[3] for r in runs) for i, z, y, x in points}
    assert {r["id"]: r["in_roi"] for r in got.collect()} == want
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert not any(r["in_roi"] for r in regions.in_runs(df, spark.createDataFrame(runs, "z int, y int, x0 int, x1 int").limit(0), (1.0, 1.0, 1.0)).collect())


def test_mask_predicate():
    cells = [(0, 0, 0), (2, 1, 5), (-1, 4, 4)]
    inside = regions.mask(np.array(cells), (2.0, 1.0, 1.0), (10.0, 0.0, 0.0))
    at = np.array([[10.0, 0.5, 0.5], [15.9, 1.0, 5.0], [8.0, 4.0, 4.9], [12.0, 0.0, 0.0], [1e6, 0, 0]])
    assert inside(at).tolist() == [True, True, True, False, False]
    assert not regions.mask(np.zeros((0, 3)), (1.0, 1.0, 1.0))(at).any()
    assert regions.any_of([inside, regions.balls(np.array([[12.0, 0.0, 0.0]]), 1.0)])(at).tolist() == [True, True, True, True, False]


# ---- wide graphs ---------------------------------------------------------------------------------------
def made_up(seed, n=60, bodies=2):
    draw, nodes, edges = random.Random(seed), [], []
    for b in range(bodies):
        for i in range(n):
            nodes.append((b, i, *(float(draw.randrange(40)) for _ in range(3))))
            if i and draw.random() < 0.7:
                edges.append((b, len(edges) + 1, draw.randrange(max(0, i - 3), i), i))
        edges += [(b, len(edges) + k + 1, draw.randrange(n), draw.randrange(n)) for k in range(3)]
        edges.append((b, len(edges) + 9, 3, 10_000))  # no such node
    return nodes, edges


def tables(spark, nodes, edges):
    return spark.createDataFrame(nodes, "body_id long, node_id long, z_nm double, y_nm double, x_nm double"), spark.createDataFrame(edges, "body_id long, edge_id long, src long, dst long")


def test_near_pairs_by_brute_force():
    v = np.random.default_rng(5).uniform(-20, 20, (150, 3))
    v[:20] = v[20:40]
    want = {(i, j) for i, j in itertools.combinations(range(150), 2) if ((v[i] - v[j]) ** 2).sum() <= 49}
    got = graph.near_pairs(v, 7.0)
    assert len(got) == len(want) and set(map(tuple, got.tolist())) == want
    assert not len(graph.near_pairs(v[:0], 1.0)) and not len(graph.near_pairs(v, 0.0))


@pytest.mark.parametrize("seed", range(2))
def test_bridges_are_a_least_forest(spark, monkeypatch, seed):
    """Against Kruskal's method over all pairs, with components by stars, too."""
    monkeypatch.setattr(wide.labels, "__defaults__", (0 if seed else wide.FEW,))
    nodes, edges = made_up(seed)
    got = {}
    for r in wide.bridges(*tables(spark, nodes, edges), 12.0).collect():
        got.setdefault(r["body_id"], set()).add((r["src"], r["dst"]))
    for b in {n[0] for n in nodes}:
        place = {n[1]: np.array(n[2:]) for n in nodes if n[0] == b}
        sets = graph.Union(len(place))
        for e in edges:
            if e[0] == b and e[3] in place:
                sets.join(e[2], e[3])
        want = set()
        for _, i, j in sorted((float(np.sqrt(((place[i] - place[j]) ** 2).sum())), i, j) for i, j in itertools.combinations(sorted(place), 2)):
            if np.sqrt(((place[i] - place[j]) ** 2).sum()) <= 12 and sets.find(i) != sets.find(j):
                sets.join(i, j)
                want.add((i, j))
        assert got.get(b, set()) == want
    assert wide.bridges(*tables(spark, nodes, edges), 0.0).count() == 0
    with pytest.raises(ValueError):
        wide.bridges(*tables(spark, nodes, edges), -1.0)


def test_components_and_distances_as_by_body(spark, monkeypatch):
    monkeypatch.setattr(wide.labels, "__defaults__", (0,))
    nodes, edges = made_up(7, 80)
    line = [(9, i, float(i), 0.0, 0.0) for i in range(600)]  # a long run, and a ring that no source is on
    ring = [(9, 1000 + i, 0.0, float(i), 5.0) for i in range(6)]
    more = [(9, i + 1, i, i + 1) for i in range(599)] + [(9, 2000 + i, 1000 + i, 1000 + (i + 1) % 6) for i in range(6)]
    n, e = tables(spark, nodes + line + ring, edges + more)
    assert sorted(map(tuple, wide.components(n, e).collect())) == sorted(map(tuple, paths.components(n, e).collect()))
    n = n.withColumn("is_source", (F.col("node_id") % 37 == 5) & (F.col("node_id") < 1000) & ((F.col("body_id") < 9) | (F.col("node_id") < 100)))
    got = {(r["body_id"], r["node_id"]): r["distance_nm"] for r in wide.path_distances(n, e).collect()}
    want = {(r["body_id"], r["node_id"]): r["distance_nm"] for r in paths.path_distances(n, e).collect()}
    assert got.keys() == want.keys() and {k for k in got if got[k] is None} == {k for k in want if want[k] is None}
    assert all(got[k] == pytest.approx(want[k]) for k in got if got[k] is not None)
    assert wide.path_distances(n.limit(0), e).count() == 0
    assert wide.path_distances(n.withColumn("is_source", F.lit(False)), e).where("distance_nm is not null").count() == 0


def test_bridged_edges_are_numbered(spark):
    nodes, edges = made_up(3)
    n, e = tables(spark, nodes, edges)
    got = wide.bridge_gaps(n, e, 12.0)
    new = got.where("is_bridge").collect()
    assert got.count() == len(edges) + len(new) and len({(r["body_id"], r["edge_id"]) for r in new}) == len(new)
    assert all(r["edge_id"] > max(x[1] for x in edges if x[0] == r["body_id"]) for r in new)


@pytest.mark.parametrize("share", [0.01, 0.6])
def test_box_counts_by_brute_force(spark, share):
    """Sparse and dense, over the seams of blocks, the same for any block; negative places, too."""
    cells = random_cells(8, (14, 9, 11), share) - [3, 2, 40]
    want = {tuple(map(int, c)): int((np.abs(cells - c) <= 2).all(axis=1).sum()) for c in cells}
    for block in (2, 5, 64):
        got = fields.box_counts(voxels(spark, cells), 2, block)
        assert {(r["z"], r["y"], r["x"]): r["n"] for r in got.collect()} == want
        assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    far = fields.extreme_places(voxels(spark, cells), got).first()
    best = min(want, key=lambda c: (-want[c], c))
    worst = min(want, key=lambda c: (want[c], c))
    assert (far["most"], far["most_z"], far["most_y"], far["most_x"]) == (want[best], *best) and (far["least"], far["least_z"], far["least_y"], far["least_x"]) == (want[worst], *worst)
    with pytest.raises(ValueError):
        fields.box_counts(voxels(spark, cells), 9, 4)


@pytest.mark.parametrize("share", [0.01, 0.6])
def test_narrow_counts_by_brute_force(spark, share):
    """Sparse and dense, over the seams of blocks, without Python."""
    cells = random_cells(8, (14, 9, 11), share) - [3, 2, 40]
    for reach, block in ((0, 5), (1, 1), (2, 2), (2, 5), (3, 64)):
        got = fields.narrow_counts(voxels(spark, cells), reach, block)
        assert sorted((r["z"], r["y"], r["x"], r["n"]) for r in got.collect()) == sorted((*map(int, c), int((np.abs(cells - c) <= reach).all(axis=1).sum())) for c in cells)
        assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    with pytest.raises(ValueError):
        fields.narrow_counts(voxels(spark, cells), 9, 4)
