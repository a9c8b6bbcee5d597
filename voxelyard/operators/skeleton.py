"""Measures of skeletons, given as nodes (body_id, node_id, z_nm, y_nm, x_nm, radius_nm) and edges
(body_id, edge_id, src, dst). A skeleton may be a forest; zero-length edges count for topology and not
for weighted statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.frames import distance2

QUANTILES = (0.1, 0.5, 0.9, 0.99)


def ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends (a_..., b_...), and their length."""
    cells = ["z", "y", "x"]
    for side, key in (("a", "src"), ("b", "dst")):
        own = nodes.select("body_id", F.col("node_id").alias(key), *[F.col(f"{c}_nm").alias(f"{side}_{c}") for c in cells], F.col("radius_nm").alias(f"{side}_radius"))
        edges = edges.join(own, ["body_id", key])
    return edges.withColumn("length_nm", F.sqrt(distance2("a_", "b_")))


def links(nodes: DataFrame, edges: DataFrame, least: float = 1e-6) -> DataFrame:
    """The graph of a skeleton, (body_id, node_id, other, weight) in both directions: no loops, each pair once
    however often it comes, and no weight under the least, so that ends at one place stay tied."""
    one = ends(nodes, edges).where("src <> dst").select("body_id", F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.greatest("length_nm", F.lit(least)).alias("weight"))
    both = F.explode(F.array(F.struct(F.col("a").alias("node_id"), F.col("b").alias("other")), F.struct(F.col("b").alias("node_id"), F.col("a").alias("other")))).alias("x")
    return one.groupBy("body_id", "a", "b").agg(F.min("weight").alias("weight")).select("body_id", both, "weight").select("body_id", "x.*", "weight")


def cable_length(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Length of all edges of each body; 0, not null, without edges."""
    sums = ends(nodes, edges).groupBy("body_id").agg(F.sum("length_nm").alias("cable_nm"))
    return nodes.select("body_id").distinct().join(sums, "body_id", "left").na.fill(0.0, ["cable_nm"])


def cable_shares(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Half of each edge's length to either end; 0 for a node without edges."""
    halves = ends(nodes, edges).select("body_id", F.explode(F.array("src", "dst")).alias("node_id"), (F.col("length_nm") / 2).alias("half"))
    sums = halves.groupBy("body_id", "node_id").agg(F.sum("half").alias("share_nm"))
    return nodes.select("body_id", "node_id").join(sums, ["body_id", "node_id"], "left").na.fill(0.0, ["share_nm"])


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = edges.select("body_id", F.explode(F.array("src", "dst")).alias("node_id")).groupBy("body_id", "node_id").agg(F.count("*").alias("degree"))
    return nodes.select("body_id", "node_id").join(n, ["body_id", "node_id"], "left").na.fill(0, ["degree"])


def topology(nodes: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Vertices, edges, tips (degree 1), branches (degree over 2) and components of each body. labels is
    of components() and has a component for every node, so an isolated vertex is one too."""
    by_node = degrees(nodes, edges).groupBy("body_id").agg(F.count("*").alias("n_vertices"), F.count_if(F.col("degree") == 1).alias("n_tips"), F.count_if(F.col("degree") > 2).alias("n_branches"))
    n_edges = edges.groupBy("body_id").agg(F.count("*").alias("n_edges"))
    pieces = labels.groupBy("body_id").agg(F.count_distinct("component").alias("n_components"))
    return by_node.join(n_edges, "body_id", "left").join(pieces, "body_id", "left").na.fill(0, ["n_edges", "n_components"])


def weighted_quantiles(df: DataFrame, key: list[str], value: str, weight: str, quantiles: tuple[float, ...], order: list[str]) -> DataFrame:
    """Step quantiles: the smallest value at which the running weight reaches q times the whole. Zero
    weights and non-finite values are dropped; a negative weight stops the job."""
    w = F.when(F.col(weight) >= 0, F.col(weight)).otherwise(F.raise_error(F.lit("negative weight")).cast("double"))
    rows = df.withColumn("w", w).where((F.col("w") > 0) & ~F.isnan(value) & (F.abs(value) < float("inf")))
    by_value = Window.partitionBy(*key).orderBy(value, *order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("cum", F.sum("w").over(by_value)).withColumn("all", F.sum("w").over(Window.partitionBy(*key)))
    # the last row always reaches the whole, whatever the rounding of the two sums
    last = F.col("cum") == F.max("cum").over(Window.partitionBy(*key))
    rows = rows.withColumn("last", last)
    return rows.groupBy(*key).agg(*[F.min(F.when((F.col("cum") >= q * F.col("all")) | F.col("last"), F.col(value))).alias(f"p{round(q * 100)}") for q in quantiles])


def diameter_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Of each edge's mean diameter, weighted by length: mean, step quantiles, maximum."""
    tubes = ends(nodes, edges)
    means = tubes.groupBy("body_id").agg(*_calibre()).where("mean_nm is not null")
    return means.join(_steps(tubes), "body_id")


def _steps(tubes: DataFrame) -> DataFrame:
    """Step quantiles of the mean diameters of ends(), weighted by length."""
    rows = tubes.select("body_id", "edge_id", "length_nm", (F.col("a_radius") + F.col("b_radius")).alias("d")).where((F.col("length_nm") > 0) & F.col("d").isNotNull())
    return weighted_quantiles(rows, ["body_id"], "d", "length_nm", QUANTILES, ["edge_id"])


def _calibre() -> list[Column]:
    """Aggregates over ends(): the mean diameter weighted by length, and the largest; null without a length."""
    d, n = F.col("a_radius") + F.col("b_radius"), F.col("length_nm")
    told = (n > 0) & d.isNotNull()
    return [(F.sum(F.when(told, d * n)) / F.sum(F.when(told, n))).alias("mean_nm"), F.max(F.when(told, d)).alias("max_nm")]


def _cones() -> list[Column]:
    """Aggregates over ends(): volume and lateral area of the cones."""
    r0, r1, n = F.col("a_radius"), F.col("b_radius"), F.col("length_nm")
    volume = F.pi() / 3 * n * (r0 * r0 + r0 * r1 + r1 * r1)
    area = F.pi() * (r0 + r1) * F.sqrt(n * n + (r1 - r0) * (r1 - r0))
    return [F.sum(volume).alias("volume_nm3"), F.sum(area).alias("area_nm2")]


def frusta(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Volume and lateral area of the cones between the ends of each edge."""
    return ends(nodes, edges).groupBy("body_id").agg(*_cones())


def skeleton_metrics(nodes: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Cable, branches, tips, and the largest positive radius or null."""
    radius = nodes.groupBy("body_id").agg(F.max(F.when(F.col("radius_nm") > 0, F.col("radius_nm"))).alias("max_radius_nm"))
    shape = topology(nodes, edges, labels).select("body_id", "n_branches", "n_tips")
    return cable_length(nodes, edges).join(shape, "body_id").join(radius, "body_id")


def measure(nodes: DataFrame, edges: DataFrame, labels: DataFrame, dataset: str, variant: str) -> DataFrame:
    """One flat row a body, with the same columns whatever the input. All sums over edges are one aggregate; the
    quantiles alone go over the edges again, in order."""
    tubes = ends(nodes, edges)
    sums = tubes.groupBy("body_id").agg(F.sum("length_nm").alias("cable_nm"), *_calibre(), *_cones())
    steps = [f"p{round(q * 100)}" for q in QUANTILES]
    out = topology(nodes, edges, labels).join(sums, "body_id", "left").na.fill(0.0, ["cable_nm"]).join(_steps(tubes), "body_id", "left")
    shape = ["n_vertices", "n_tips", "n_branches", "n_edges", "n_components"]
    return out.select(F.lit(dataset).alias("dataset"), F.lit(variant).alias("variant"), "body_id", "cable_nm", *shape, "mean_nm", "max_nm", *steps, "volume_nm3", "area_nm2")


def sweep(bodies: DataFrame, nodes: DataFrame, edges: DataFrame, labels: DataFrame, require_radii: bool = False) -> DataFrame:
    """A row per body with its four measures and status: written, absent (no skeleton), or failed (a
    radius is missing, not finite or negative and radii are required)."""
    bad = nodes.groupBy("body_id").agg(F.max(F.coalesce(F.isnan("radius_nm") | (F.col("radius_nm") < 0) | (F.abs("radius_nm") == float("inf")), F.lit(True))).alias("bad"))
    found = skeleton_metrics(nodes, edges, labels).join(bad, "body_id")
    status = F.when(F.col("bad").isNull(), "absent").when(F.col("bad") & F.lit(require_radii), "failed").otherwise("written")
    out = bodies.select("body_id").join(found, "body_id", "left").withColumn("status", status)
    measures = ["cable_nm", "n_branches", "n_tips", "max_radius_nm"]
    return out.select("body_id", *[F.when(F.col("status") == "written", F.col(m)).alias(m) for m in measures], "status")


def boxes(nodes: DataFrame, voxel_nm: tuple[float, float, float]) -> DataFrame:
    """Box of each body's vertices in voxels; bodies without vertices have no row."""
    low = [F.floor(F.min(f"{a}_nm") / v).alias(f"{a}0") for a, v in zip("zyx", voxel_nm)]
    high = [F.ceil(F.max(f"{a}_nm") / v).alias(f"{a}1") for a, v in zip("zyx", voxel_nm)]
    return nodes.groupBy("body_id").agg(*low, *high)


def uniform_scale(matrix: list[list[float]]) -> float | None:
    """Scale of a 3 x 4 transform whose linear part is uniform; None for another one."""
    linear = [row[:3] for row in matrix]
    s = abs(linear[0][0])
    fits = all(abs(abs(linear[i][j]) - (s if i == j else 0.0)) < 1e-9 * max(1.0, s) for i in range(3) for j in range(3))
    return s if fits and s > 0 else None


def transformed(nodes: DataFrame, matrix: list[list[float]], require_radii: bool = True) -> DataFrame:
    """Nodes under a 3 x 4 matrix over z, y, x. Radii scale with a uniform one; under another they are
    refused, or null where the centre line is enough."""
    scale = uniform_scale(matrix)
    if scale is None and require_radii:
        raise ValueError("radii have no one scale under this transform")
    moved = {f"{a}_nm": sum((F.col(f"{b}_nm") * float(row[j]) for j, b in enumerate("zyx")), F.lit(float(row[3]))) for a, row in zip("zyx", matrix)}
    return nodes.withColumns(moved | {"radius_nm": F.col("radius_nm") * scale if scale is not None else F.lit(None).cast("double")})


def slab(nodes: DataFrame, edges: DataFrame, low: float, high: float, axis: str = "z") -> DataFrame:
    """Edges with both ends in the slab of an axis."""
    both = ends(nodes, edges)
    return both.where(F.col(f"a_{axis}").between(low, high) & F.col(f"b_{axis}").between(low, high)).select(*edges.columns, "length_nm")


def samples(nodes: DataFrame, edges: DataFrame, step_nm: float) -> DataFrame:
    """Points along each edge, no further apart than the step, with the radius between the ends', and all
    vertices as well."""
    n = F.greatest(F.ceil(F.col("length_nm") / step_nm), F.lit(1)).cast("int")
    each = ends(nodes, edges).withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n"))))
    t: Column = F.col("k") / F.col("n")
    mid = [(F.col(f"a_{c}") + t * (F.col(f"b_{c}") - F.col(f"a_{c}"))).alias(f"{c}_nm") for c in "zyx"]
    along = each.select("body_id", *mid, (F.col("a_radius") + t * (F.col("b_radius") - F.col("a_radius"))).alias("radius_nm"))
    return along.unionByName(nodes.select(*along.columns))


def swc_edges(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of SWC text rows (value): id type x y z r parent; comments and blank lines are
    skipped, and a node whose parent is not there is a root."""
    cells = F.split(F.trim("value"), r"\s+")
    rows = lines.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#")).select(cells.alias("c"))
    cell = lambda k, kind: F.element_at("c", k).cast(kind)
    nodes = rows.select(cell(1, "long").alias("node_id"), cell(5, "double").alias("z_nm"), cell(4, "double").alias("y_nm"), cell(3, "double").alias("x_nm"), cell(6, "double").alias("radius_nm"), cell(7, "long").alias("parent"))
    parents = nodes.select(F.col("node_id").alias("parent"))
    edges = nodes.join(parents, "parent").select(F.col("node_id").alias("edge_id"), F.col("parent").alias("src"), F.col("node_id").alias("dst"))
    return nodes.drop("parent"), edges
