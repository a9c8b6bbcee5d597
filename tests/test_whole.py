"""Queries without SQL run over whole tables."""

from tests.oracle import DATA
from voxelyard.plans import catalogue
from voxelyard.sources.bind import read, skeletons

SF = f"{DATA}/sf0.001"


def bodies(df):
    return {r[0] for r in df.select("body_id").distinct().collect()}


def test_each_supplier_is_traced_and_fused(spark):
    want = {r[0] + 1 for r in read(spark, SF, "supplier").select("s_suppkey").collect()}
    for name in ("trace_blocks", "fuse_skeletons"):
        assert bodies(catalogue.queries()[name](spark, SF)) == want, name
    assert catalogue.queries()["fusion_totals"](spark, SF).first()["n_bodies"] == len(want)


def test_tubes_of_every_body(spark):
    """Against brute force; a body is missing only where its balls lie outside the shape."""
    cells = {}
    for r in skeletons(spark, SF)[0].collect():
        centre = [round(r[f"{a}_nm"] / 40.0) for a in "zyx"]  # half to even, as bround
        n = round(r["radius_nm"] * 10 / 40.0)
        ball = [(i, j, k) for i in range(-n, n + 1) for j in range(-n, n + 1) for k in range(-n, n + 1) if i * i + j * j + k * k <= n * n]
        own = cells.setdefault(r["body_id"], set())
        own |= {p for p in ((centre[0] + i, centre[1] + j, centre[2] + k) for i, j, k in ball) if 0 <= p[0] < 80 and 0 <= p[1] < 20 and 0 <= p[2] < 5}
    want = {b: (len(c), sum((z + y) % 3 != 0 for z, y, _ in c)) for b, c in cells.items() if c}
    assert {r["body_id"]: (r["n_tube"], r["n_mask"]) for r in catalogue.queries()["tube_overlap"](spark, SF).collect()} == want


def test_a_synapse_by_each_node(spark):
    want = {r[0] for r in read(spark, SF, "orders").select("o_orderkey").collect()}
    found = catalogue.queries()["synapse_distances"](spark, SF)
    assert {r["point_id"] for r in found.select("point_id").collect()} == want
