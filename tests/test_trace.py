"""Tracing and fusion on shapes whose skeletons are known."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelyard.operators import trace


def rod(n=60, r=3, z0=0):
    return np.array([(z0 + z, y, x) for z in range(n) for y in range(-r, r + 1) for x in range(-r, r + 1) if y * y + x * x <= r * r]) + [0, 10, 10]


def test_depth_of_a_rod():
    cells = rod()
    d = trace.depth(cells)
    axis = (cells[:, 1] == 10) & (cells[:, 2] == 10) & (cells[:, 0] > 8) & (cells[:, 0] < 50)
    assert np.allclose(d[axis], d[axis][0]) and 3 <= d[axis][0] <= 4
    assert d.min() == 1


def test_rod_is_one_path():
    cells = rod()
    keep, radius, edges = trace.trace(cells, np.zeros(len(cells), bool))
    shape = trace.Shape(cells[keep].astype(float), radius, edges).profile()
    assert (shape["comps"], shape["tips"], shape["branches"]) == (1, 2, 0)
    assert 50 <= shape["cable"] <= 75
    inner = (cells[keep][:, 0] > 10) & (cells[keep][:, 0] < 50)
    assert np.abs(cells[keep][inner][:, 1:] - 10).max() <= 1


def test_y_branches_once():
    arm = np.array([(z, 10 + (z - 30) + dy, 10 + dx) for z in range(30, 60) for dy in (-2, -1, 0, 1, 2) for dx in (-2, -1, 0, 1, 2)])
    cells = np.unique(np.concatenate([rod(), arm]), axis=0)
    keep, radius, edges = trace.trace(cells, np.zeros(len(cells), bool))
    shape = trace.Shape(cells[keep].astype(float), radius, edges).profile()
    assert (shape["comps"], shape["tips"], shape["branches"]) == (1, 3, 1)


def test_dust_is_not_traced():
    cells = rod(3, 1)
    assert len(trace.trace(cells, np.zeros(len(cells), bool))[0]) == 0


def test_rod_over_blocks_is_one_component(spark):
    rows = [(*map(int, c), 7) for c in rod(96, 3)] + [(*map(int, c), 9) for c in rod(3, 1, 40) + [0, 12, 12]]
    voxels = spark.createDataFrame(rows, "z int, y int, x int, body_id long")
    parts = trace.skeletonize_blocks(voxels, 32, 8.0)
    assert parts.select("block").distinct().count() == 3
    got = {r["body_id"]: r for r in trace.fuse_bodies(parts, 16.0, dust=100.0, tick=100.0).collect()}
    assert got.keys() == {7}
    row = got[7]
    assert (row["status"], row["n_fragments"], row["comps_out"], row["tips_out"]) == ("written", 3, 1, 2)
    assert row["cable_out_nm"] == pytest.approx(96 * 8, rel=0.2)
    total = trace.fusion_summary(trace.fuse_bodies(parts, 16.0, dust=1e6)).first()
    assert (total["n_bodies"], total["n_deleted"]) == (1, 1) and total["dropped_fraction"] == pytest.approx(1, abs=0.1)


def test_fusion_steps():
    line = lambda a, b, y: np.array([[z, y, 0.0] for z in range(a, b, 10)])
    v = np.concatenate([line(0, 100, 0), line(105, 200, 0), line(0, 20, 500)])
    e = np.array([(i, i + 1) for i in range(9)] + [(10 + i, 11 + i) for i in range(9)] + [(20, 21), (0, 2)])
    s, stats = trace.fuse(trace.Shape(v, np.full(len(v), 2.0), e), 20.0, 50.0, 0.0)
    assert stats["comps_in"] == 3 and stats["seam_join_comps_merged"] == 1 and stats["seam_join_cable_added_nm"] == 15
    assert stats["dust_comps_dropped"] == 1 and stats["dust_cable_dropped_nm"] == 10 and stats["loop_cable_delta_nm"] == -20
    assert stats["comps_out"] == 1


def test_ticks():
    v = np.concatenate([np.array([[z, 0.0, 0.0] for z in range(0, 200, 10)]), [[100.0, 10.0, 0.0], [100.0, 20.0, 0.0]]])
    e = np.array([(i, i + 1) for i in range(19)] + [(10, 20), (20, 21)])
    s = trace.without_ticks(trace.Shape(v, np.zeros(len(v)), e), 50.0)
    assert len(s.v) == 20 and s.profile()["tips"] == 2
    assert trace.twigs(v, e, 50.0) == 1 and trace.twigs(v, e, 10.0) == 0
    assert len(trace.without_ticks(trace.Shape(v[:5], np.zeros(5), e[:4]), 1e9).v) == 5


def test_a_failing_body_stops_no_other(spark):
    rows = [(1, "0", i, float(i) * 300, 0.0, 0.0, 5.0, [i - 1] if i else []) for i in range(4)] + [(2, "0", 0, 0.0, 0.0, 0.0, 5.0, [99])]
    got = {r["body_id"]: r["status"] for r in trace.fuse_bodies(spark.createDataFrame(rows, trace.FRAGMENT), 0.0).collect()}
    assert got == {1: "written", 2: "failed"}
    assert trace.fuse_bodies(spark.createDataFrame(rows, trace.FRAGMENT), 0.0).where(F.col("status") == "failed").count() == 1


def test_depth_at_open_faces():
    """A rod that goes on beyond a face is as thick there as inside; beyond a closed one it ends."""
    cells = rod(64, 5)
    axis = (cells[:, 1] == 10) & (cells[:, 2] == 10)
    inside = trace.depth(cells)[axis][20]
    half = cells[cells[:, 0] <= 32]
    at = (half[:, 1] == 10) & (half[:, 2] == 10)
    open_ = trace.depth(half, np.array([0, -50, -50]), np.array([32, 50, 50]))[at]
    assert np.allclose(open_, inside)
    assert trace.depth(half)[at][-1] == 1


def test_no_background_at_all():
    cube = np.array([(z, y, x) for z in range(4) for y in range(4) for x in range(4)])
    assert (trace.depth(cube, np.zeros(3, int), np.full(3, 3)) == 4).all()


@pytest.mark.parametrize("radius", [3, 5])
def test_seams_add_no_cable(spark, radius):
    """Traced in blocks and fused, the cable is that of the whole rod, and stays on the axis."""
    cells = rod(64, radius)
    voxels = spark.createDataFrame([(*map(int, c), 1) for c in cells], "z int, y int, x int, body_id long")
    whole, _, edges = trace.trace(cells, np.zeros(len(cells), bool), low=np.array([0, 0, 0]), high=np.array([64, 64, 64]))
    uncut = np.linalg.norm(cells[whole][edges[:, 0]] - cells[whole][edges[:, 1]], axis=1).sum() * 8
    parts = trace.skeletonize_blocks(voxels, 32, 8.0)
    row = trace.fuse_bodies(parts, 16.0, dust=10.0, tick=10.0).first()
    assert row["comps_out"] == 1 and row["tips_out"] == 2
    assert row["cable_out_nm"] == pytest.approx(uncut, rel=0.02)
    off = [abs(v - 80) for v, z in zip(row["y_nm"] + row["x_nm"], row["z_nm"] * 2) if 80 < z < 420]
    assert max(off) <= 8
