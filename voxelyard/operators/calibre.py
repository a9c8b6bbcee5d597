"""Calibre of bodies: nearest nodes and edges of points, local radii, histograms of weighted values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import distance2
from .skeleton import ends


#: Nodes of a body whose points are compared with all of them.
SMALL = 64
#: Levels of the grid pyramid, each of cells STEP times as wide as those of the one before; STEP is more than
#: the diagonal of a cell, sqrt(3). Above them is one cell for all.
LEVELS, STEP = 17, 2


def _levels(df: DataFrame) -> DataFrame:
    return df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))


def _placed(df: DataFrame, prefix: str, side: float, around: bool = False) -> DataFrame:
    """Adds the cell (cz, cy, cx) of a position at the row's level, or a row for each of the 27 cells around."""
    level = F.col("level")
    wide = F.pow(F.lit(float(STEP)), level) * side
    own = {f"c{a}": F.when(level < LEVELS, F.floor(F.col(f"{prefix}{a}") / wide)).otherwise(0).cast("long") for a in "zyx"}
    df = df.withColumns(own)
    if not around:
        return df
    step = F.when(level < LEVELS, F.array(*[F.lit(d).cast("long") for d in (-1, 0, 1)])).otherwise(F.array(F.lit(0).cast("long")))
    for c in own:
        df = df.withColumn("step_", F.explode(step)).withColumn(c, F.col(c) + F.col("step_")).drop("step_")
    return df


def _side(nodes: DataFrame) -> float:
    """The finest cells' width: a 512th of the spacing that as many nodes would have on an even grid."""
    r = nodes.agg(F.count("*"), *[F.max(f"n_{a}") - F.min(f"n_{a}") for a in "zyx"]).first()
    wide = max([x for x in r[1:] if x is not None] or [0.0])
    return wide / max(r[0], 1) ** (1 / 3) / 512 or 1.0


def _distance2(node: Column) -> Column:
    """distance2("p_", "n_") to a node that is a struct."""
    moves = [F.col(f"p_{a}") - node[f"n_{a}"] for a in "zyx"]
    return sum((m * m for m in moves), F.lit(0.0))


def nearest_nodes(points: DataFrame, nodes: DataFrame, carry: list[str], side: float | None = None, small: int = SMALL) -> DataFrame:
    """For each point (point_id, body_id, z, y, x) the nearest node of its body, and the distance; of
    equally near ones that with the smallest id.

    The points of bodies of up to small nodes are compared with all of these. Those of others look for the
    finest level of a grid pyramid with a node in their own cell; that node is within the cell's diagonal, so
    the nearest one is in the 27 cells around on the next level, and a point meets these alone. Exact, whatever the spacing; a body's points
    and nodes are spread by cells, so a large body is no hot key."""
    own = nodes.select("body_id", "node_id", *[F.col(f"{a}_nm").alias(f"n_{a}") for a in "zyx"])
    at = points.select("point_id", "body_id", *carry, *[F.col(a).alias(f"p_{a}") for a in "zyx"])
    size = own.groupBy("body_id").agg(F.count("*").alias("size_"))
    large = size.where(F.col("size_") > small).select("body_id")
    few, many = own.join(large, "body_id", "left_anti"), own.join(large, "body_id", "left_semi")
    point = ["point_id", "body_id", *carry]
    listed = few.groupBy("body_id").agg(F.collect_list(F.struct("node_id", "n_z", "n_y", "n_x")).alias("nodes_"))
    nearest = F.array_min(F.transform("nodes_", lambda n: F.struct(_distance2(n).alias("d2"), n["node_id"].alias("node_id"))))
    near = at.join(listed, "body_id").select(*point, nearest.alias("best"))  # a row of a point, not of each pair
    if not large.isEmpty():
        side = side or _side(many)
        cells = ["body_id", "level", "cz", "cy", "cx"]
        seen = _placed(_levels(many), "n_", side).select(*cells).distinct()
        found = _placed(_levels(at), "p_", side).join(seen, cells, "left_semi").groupBy(*point, "p_z", "p_y", "p_x").agg(F.least(F.min("level") + 1, F.lit(LEVELS)).alias("level"))
        pairs = _placed(found, "p_", side, True).join(_placed(_levels(many), "n_", side), cells)
        near = near.unionByName(pairs.select(*point, F.struct(distance2("p_", "n_").alias("d2"), "node_id").alias("best")))
    best = near.groupBy(*point).agg(F.min("best").alias("best"))
    return best.select("point_id", "body_id", *carry, F.col("best.node_id").alias("node_id"), F.sqrt("best.d2").alias("distance_nm"))


def _cells(prefix: str, side: float, spread: bool) -> Column:
    """Grid cell of a position; with spread, it and its 26 neighbours."""
    own = [F.floor(F.col(f"{prefix}{a}") / side) for a in "zyx"]
    moves = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)] if spread else [(0, 0, 0)]
    return F.explode(F.array(*[F.struct(*[(c + d).alias(f"c{a}") for a, c, d in zip("zyx", own, m)]) for m in moves])).alias("cell")


def within(a: DataFrame, b: DataFrame, radius: float, key: list[str], small: int = SMALL) -> DataFrame:
    """Pairs of rows of a (a_z, a_y, a_x) and b (b_z, b_y, b_x) with equal keys and at most this far
    apart. Exact. Rows of keys with up to small rows of b are compared with all of these; those of others by a grid of
    the radius: b is put into its cell, a into the 27 cells around."""
    if radius <= 0:
        raise ValueError("a radius is positive")

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return left.join(right, on).withColumn("d2", distance2("a_", "b_")).where(F.col("d2") <= radius * radius)

    def by_grid(a: DataFrame, b: DataFrame) -> DataFrame:
        left = a.select("*", _cells("a_", radius, True)).select("*", "cell.*").drop("cell")
        right = b.select("*", _cells("b_", radius, False)).select("*", "cell.*").drop("cell")
        return met(left, right, [*key, "cz", "cy", "cx"]).drop("cz", "cy", "cx")

    if not key or not small:
        return by_grid(a, b)
    large = b.groupBy(*key).agg(F.count("*").alias("size_")).where(F.col("size_") > small).select(*key)
    if large.isEmpty():
        return met(a, b, key)
    few = met(a.join(large, key, "left_anti"), b.join(large, key, "left_anti"), key)
    return few.unionByName(by_grid(a.join(large, key, "left_semi"), b.join(large, key, "left_semi")))


def nearest_by_grid(points: DataFrame, nodes: DataFrame, side: float) -> DataFrame:
    """nearest_nodes by the grid alone, with finest cells of this side."""
    return nearest_nodes(points, nodes, [], side, 0)


def bin_to_nodes(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """Points and summed distance of each node."""
    return nearest_nodes(points, nodes, []).groupBy("body_id", "node_id").agg(F.count("*").alias("n"), F.sum("distance_nm").alias("distance_sum_nm"))


def cross_section(volume: Column, length: Column) -> tuple[Column, Column]:
    """Mean area and radius of a tube; null, never infinite, without length."""
    area = F.when(length > 0, volume / length)
    return area, F.sqrt(area / F.pi())


def mean_radius(area: Column, length: Column) -> Column:
    """Radius of the tube with this side and length; null without a length."""
    return F.when(length > 0, area / (2 * math.pi * length))


def node_radii(counts: DataFrame, shares: DataFrame, voxel_nm: float) -> DataFrame:
    """Local radius of each node that has both voxels and cable, weighted by its cable."""
    both = counts.join(shares, ["body_id", "node_id"]).where((F.col("share_nm") > 0) & (F.col("n") > 0))
    return both.select("body_id", "node_id", F.sqrt(F.col("n") * voxel_nm**3 / (F.col("share_nm") * math.pi)).alias("radius_nm"), F.col("share_nm").alias("weight"))


def blob_signal(counts: DataFrame, shares: DataFrame, voxel_nm: float, tolerance: float = 1.25) -> DataFrame:
    """Fraction of the cable whose voxels lie further out than a cylinder of its radius has them."""
    both = counts.join(shares, ["body_id", "node_id"]).where((F.col("share_nm") > 0) & (F.col("n") > 0))
    r2 = F.col("n") * voxel_nm**3 / (F.col("share_nm") * math.pi)
    spacing = F.col("share_nm")
    expected = F.sqrt(r2 / 2 + spacing * spacing / 12)
    far = F.col("distance_sum_nm") / F.col("n") > tolerance * expected
    return both.groupBy("body_id").agg((F.sum(F.when(far, F.col("share_nm")).otherwise(0.0)) / F.sum("share_nm")).alias("blob_fraction"))


def _edges_near(at: DataFrame, own: DataFrame) -> DataFrame:
    """(point_id, body_id, edge_id) of the edges that may be a point's nearest one. Edges stand as samples
    a mean length apart; where the nearest sample is d away, the nearest edge has one within d and half of
    that spacing, so in the 27 cells around of the level that is as wide."""
    step = own.agg(F.avg("length_nm")).first()[0] or 1.0
    n = F.greatest(F.ceil(F.col("length_nm") / step), F.lit(1))
    at_ = own.withColumn("n_", n).withColumn("k_", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_"))))
    samples = at_.select("body_id", "edge_id", *[(F.col(f"a_{a}") + F.col("k_") / F.col("n_") * (F.col(f"b_{a}") - F.col(f"a_{a}"))).alias(f"n_{a}") for a in "zyx"])
    side = _side(samples)
    nodes = samples.select("body_id", F.col("edge_id").alias("node_id"), *[F.col(f"n_{a}").alias(f"{a}_nm") for a in "zyx"])
    near = nearest_nodes(at.select("point_id", "body_id", *[F.col(f"p_{a}").alias(a) for a in "zyx"]), nodes, ["z", "y", "x"], side, 0)
    reach = F.greatest((F.col("distance_nm") + step / 2) * 1.0001 / side, F.lit(1.0))
    asked = near.select("point_id", "body_id", *[F.col(a).alias(f"p_{a}") for a in "zyx"], F.least(F.ceil(F.log2(reach)), F.lit(LEVELS)).cast("int").alias("level"))
    cells = ["body_id", "level", "cz", "cy", "cx"]
    return _placed(asked, "p_", side, True).join(_placed(_levels(samples), "n_", side), cells).select("point_id", "body_id", "edge_id").distinct()


def attach(points: DataFrame, nodes: DataFrame, edges: DataFrame, small: int = SMALL) -> DataFrame:
    """For each point the nearest edge of its body: where on it (t from 0 to 1), how far, and the radius
    there. Of equally near edges the one with the smallest id; a zero-length edge has t = 0. Points of bodies of
    up to small edges are compared with all of these, others with those near by."""
    own = ends(nodes, edges).drop("src", "dst")
    at = points.select("point_id", "body_id", *[F.col(a).alias(f"p_{a}") for a in "zyx"])
    large = edges.groupBy("body_id").agg(F.count("*").alias("size_")).where(F.col("size_") > small).select("body_id")
    pairs = at.join(own.join(large, "body_id", "left_anti"), "body_id")
    if not large.isEmpty():
        far, tied = at.join(large, "body_id", "left_semi"), own.join(large, "body_id", "left_semi")
        pairs = pairs.unionByName(far.join(_edges_near(far, tied), ["point_id", "body_id"]).join(tied, ["body_id", "edge_id"]))
    along = sum(((F.col(f"p_{a}") - F.col(f"a_{a}")) * (F.col(f"b_{a}") - F.col(f"a_{a}")) for a in "zyx"), F.lit(0.0))
    square = F.col("length_nm") * F.col("length_nm")
    pairs = pairs.withColumn("t", F.when(square > 0, F.least(F.greatest(along / F.nullif(square, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).otherwise(0.0))
    gap = [F.col(f"p_{a}") - F.col(f"a_{a}") - F.col("t") * (F.col(f"b_{a}") - F.col(f"a_{a}")) for a in "zyx"]
    pairs = pairs.withColumn("d2", sum((g * g for g in gap), F.lit(0.0))).withColumn("radius", F.col("a_radius") + F.col("t") * (F.col("b_radius") - F.col("a_radius")))
    # edges that meet at the nearest node are equally near, but for rounding
    best = pairs.groupBy("point_id", "body_id").agg(F.min(F.struct(F.round("d2", 6).alias("near"), "edge_id", "t", "radius", "d2")).alias("best"))
    return best.select("point_id", "body_id", F.col("best.edge_id").alias("edge_id"), F.col("best.t").alias("t"), F.sqrt("best.d2").alias("snap_nm"), F.col("best.radius").alias("radius_nm"))


def log_edges(low: float, high: float, n: int) -> list[float]:
    if not 0 < low < high or n < 1:
        raise ValueError("bins need 0 < low < high and n of 1 or more")
    step = (math.log10(high) - math.log10(low)) / n
    return [float(low), *(10 ** (math.log10(low) + step * k) for k in range(1, n)), float(high)]


def log_histogram(df: DataFrame, value: Column, low: float, high: float, n: int, weight: Column | None = None) -> DataFrame:
    """(bin, lo, hi, weight) of n logarithmic bins with bin 0 below and bin n + 1 above. Bins are closed on
    the left, the top edge is above, empty bins are there, and no weight is lost but that of null and
    non-finite values."""
    edges = log_edges(low, high, n)
    at = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda a, e: a + F.when(F.col("v") >= e, 1).otherwise(0))
    rows = df.select(value.cast("double").alias("v"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    sums = rows.groupBy(at.alias("bin")).agg(F.sum("w").alias("weight"))
    bins = df.sparkSession.createDataFrame([(k, edges[k - 1] if k else None, edges[k] if k <= n else None) for k in range(n + 2)], "bin int, lo double, hi double")
    return bins.join(sums, "bin", "left").na.fill(0.0, ["weight"])
