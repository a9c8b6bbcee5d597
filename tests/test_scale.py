"""What only larger or odder tables show."""

import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from tests.oracle import DATA
from voxelyard.functions import frames
from voxelyard.operators import calibre, simplify, trace, volume
from voxelyard.plans import catalogue, sweeps


@pytest.mark.parametrize("axis", [0, 1, 2])
def test_what_lies_beyond_the_shape_is_no_block(spark, axis):
    inside, beyond = [3, 3, 3], [3, 3, 3]
    beyond[axis] = 900
    rows = spark.createDataFrame([(*inside, 1), (*beyond, 2)], "z int, y int, x int, body_id long")
    found = volume.occupied_blocks(rows, 64.0, 8.0, 128, (20, 20, 20))
    assert [tuple(r) for r in found.collect()] == [(0, 0, 0)]


@pytest.mark.parametrize("name", ["bridge_gaps", "swc_forest", "skeleton_stats"])
def test_small_bodies_share_python_calls(spark, name):
    plan = catalogue.queries()[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    calls = re.findall(r"FlatMapCoGroupsInPandas \[([^#\]]*)", plan)
    assert calls and set(calls) == {"bucket"}


def cells_of(spark, rows):
    return spark.createDataFrame(rows, "z long, y long, x long")


@pytest.mark.parametrize("reach", [1, 2, 5])
def test_density_spreads_no_voxel_over_its_neighbourhood(spark, reach):
    draw = random.Random(reach)
    cells = sorted({(draw.randrange(-70, 140), draw.randrange(60, 70), draw.randrange(120, 131)) for _ in range(1500)})
    df = volume.local_density(cells_of(spark, cells + cells[:50]), reach)
    got = {(r["z"], r["y"], r["x"]): round(r["density"] * (2 * reach + 1) ** 3) for r in df.collect()}
    at = np.array(cells)
    assert got == {c: int((np.abs(at - c) <= reach).all(axis=1).sum()) for c in cells}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"sum\(n", plan)


@pytest.mark.parametrize("small", [64, 4, 0])
def test_pairs_of_small_bodies_need_no_cells(spark, small):
    draw = random.Random(1)
    rows = [(k, i, draw.random() * 9, draw.random() * 9, draw.random() * 9) for k, n in ((1, 3), (2, 9), (3, 1), (4, 4)) for i in range(n)]
    side = lambda p: spark.createDataFrame(rows, f"body_id long, {p}_node long, {p}_z double, {p}_y double, {p}_x double")
    df = calibre.within(side("a"), side("b"), 4.0, ["body_id"], small)
    got = sorted((r["body_id"], r["a_node"], r["b_node"]) for r in df.collect())
    assert got == sorted((p[0], p[1], q[1]) for p in rows for q in rows if p[0] == q[0] and sum((s - t) ** 2 for s, t in zip(p[2:], q[2:])) <= 16.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("Generate" in plan) == (small < 64)


def test_bodies_are_traced_as_one_graph(spark):
    """As each alone: rods, noise and dust, with doors and without; and no call is a body's own."""
    draw = np.random.default_rng(0)
    rod = lambda r: np.array([(z, y, x) for z in range(33) for y in range(2 * r + 1) for x in range(2 * r + 1) if (y - r) ** 2 + (x - r) ** 2 <= r * r])
    cells = [draw.permutation(c) for c in (rod(2), np.argwhere(draw.random((9, 14, 9)) < 0.4), rod(1)[:9], rod(4), np.argwhere(draw.random((12, 12, 12)) < 0.25))]
    doors = [(c == 32).any(axis=1) for c in cells]
    got = trace.traces(np.concatenate(cells), np.concatenate(doors), np.repeat(np.arange(5), [*map(len, cells)]), [(None, None)] * 5)
    base = 0
    for own, at, found in zip(cells, doors, got):
        keep, radius, edges = trace.trace(own, at)
        assert (found[0] == base + keep).all() and (found[1] == radius).all() and (found[2] == edges).all()
        base += len(own)
    assert len(got[2][0]) == 0 < len(got[0][0])
    for name in ("trace_blocks", "fuse_skeletons", "fusion_totals", "fusion_grid"):
        plan = catalogue.queries()[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
        calls = re.findall(r"FlatMapGroupsIn\w+ \[([^#\]]*)", plan)
        assert calls and set(calls) == {"bucket"}


@pytest.mark.parametrize("name", ["synapse_distances", "synapse_summary", "region_sample", "optimal_downsample"])
def test_no_python_call_is_a_body_s_own(spark, name):
    plan = catalogue.queries()[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    calls = re.findall(r"FlatMapCoGroupsIn\w+ \[([^#\]]*)", plan)
    assert calls and set(calls) == {"bucket"}


def test_merges_in_one_body_depend_on_no_other():
    draw, alone, base = np.random.default_rng(2), [], 0
    v, r, e = [], [], []
    for n in (1, 7, 300, 40, 12):
        place, radius, ends = draw.random((n, 3)) * n, draw.random(n) * n / 3, np.array([(i // 2, i) for i in range(1, n)], np.int64).reshape(-1, 2)
        one = simplify.Chain.rooted(place, radius, ends)
        one.settle(1.2, 2.0)
        alone.append(one)
        v.append(place)
        r.append(radius)
        e.append(ends + base)
        base += n
    both = simplify.Chain.rooted(np.concatenate(v), np.concatenate(r), np.concatenate(e))
    both.settle(1.2, 2.0, np.repeat(np.arange(5), [*map(len, v)]))
    assert (both.there == np.concatenate([c.there for c in alone])).all() and not both.there.all()
    assert (both.place == np.concatenate([c.place for c in alone])).all() and (both.radius == np.concatenate([c.radius for c in alone])).all()


def test_overlap_moves_tiles_not_voxels(spark):
    draw = random.Random(4)
    some = lambda n: sorted({(draw.randrange(2), draw.randrange(-9, 9), draw.randrange(-9, 9), draw.randrange(-9, 9)) for _ in range(n)})
    tube, mask = some(900), [*some(600), (5, 0, 0, 0)]
    df = volume.overlap(*[spark.createDataFrame(rows, "body_id long, z int, y int, x int") for rows in (tube, mask + mask)])
    got = {r["body_id"]: (r["n_tube"], r["n_mask"], r["n_both"]) for r in df.collect()}
    assert got == {b: tuple(len([c for c in cells if c[0] == b]) for cells in (tube, mask, set(tube) & set(mask))) for b in (0, 1, 5)}
    assert "bit_or" in df._jdf.queryExecution().executedPlan().toString()


def test_runs_sort_once_and_group_nothing(spark):
    rows = [(1, 0, 0, x) for x in (5, 1, 2, 2, 3, 7, 8, 8)] + [(1, 0, 1, 4), (2, 0, 0, 4), (2, 0, 0, None), (2, 0, 0, None), (2, 0, 0, 5)]
    found = volume.runs(spark.createDataFrame(rows, "body_id int, z int, y int, x int"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r) for r in found.collect()), key=key) == [(1, 0, 0, 1, 3), (1, 0, 0, 5, 5), (1, 0, 0, 7, 8), (1, 0, 1, 4, 4), (2, 0, 0, None, None), (2, 0, 0, 4, 5)]
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Aggregate" not in plan


def test_tasks_of_block_batches_stay_as_large(spark, monkeypatch):
    """More voxels are more tasks, not larger ones."""
    n = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet").count()
    monkeypatch.setattr(frames, "TASK_ROWS", n // 10, raising=False)
    assert sweeps._batches(spark, f"{DATA}/sf0.001").rdd.getNumPartitions() >= 10


def test_nearest_nodes_of_small_bodies_make_no_row_of_each_pair(spark):
    nodes = spark.createDataFrame([(1, n, 0.0, 0.0, float(n)) for n in range(60)], "body_id long, node_id long, z_nm double, y_nm double, x_nm double")
    points = nodes.select("body_id", F.col("node_id").alias("point_id"), *[F.col(f"{a}_nm").alias(a) for a in "zyx"])
    found = calibre.nearest_nodes(points.union(points), nodes, [])
    assert sorted((r["point_id"], r["node_id"], r["distance_nm"]) for r in found.collect()) == [(n, n, 0.0) for n in range(60)]
    metrics, stack = [], [found._jdf.queryExecution().executedPlan()]
    while stack:
        at = stack.pop()
        name = at.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            stack.append(at.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            stack.append(at.plan())
        children = at.children()
        stack += [children.apply(i) for i in range(children.size())]
        if "Join" in name and at.metrics().contains("numOutputRows"):
            metrics.append(at.metrics().apply("numOutputRows").value())
    assert max(metrics, default=0) <= 120  # 7,200 pairs
