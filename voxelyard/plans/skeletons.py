"""Queries of skeletons, calibre and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calibre, paths, sequences, simplify, skeleton, sweep, trace, volume
from ..sources.bind import BROKEN, EDGES, ENDS, NODES, POINTS, VOXELS, points, read, skeletons, voxels


def rounded(df, places=4):
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def edge_lengths(spark, d):
    return rounded(skeleton.ends(*skeletons(spark, d)).select("body_id", "edge_id", "src", "dst", "length_nm"))


def cable_length(spark, d):
    return rounded(skeleton.cable_length(*skeletons(spark, d, True)))


def cable_shares(spark, d):
    return rounded(skeleton.cable_shares(*skeletons(spark, d, True)))


def components(spark, d):
    return paths.components(*skeletons(spark, d, True))


def topology(spark, d):
    nodes, edges = skeletons(spark, d, True)
    return skeleton.topology(nodes, edges, paths.components(nodes, edges))


def diameter_stats(spark, d):
    return rounded(skeleton.diameter_stats(*skeletons(spark, d)))


def frustum_volume_area(spark, d):
    return rounded(skeleton.frusta(*skeletons(spark, d)), 2)


def measure_skeletons(spark, d):
    nodes, edges = skeletons(spark, d, True)
    return rounded(skeleton.measure(nodes, edges, paths.components(nodes, edges), "test", "all"), 2)


def sweep_skeletons(spark, d):
    nodes, edges = skeletons(spark, d, True)
    nodes = nodes.where("body_id % 4 <> 1").withColumn("radius_nm", F.when(F.expr("body_id % 4 = 2 and node_id = 1"), -1.0).otherwise(F.col("radius_nm")))
    edges = edges.where("body_id % 4 <> 1")
    bodies = skeletons(spark, d)[0].select("body_id").distinct()
    return rounded(skeleton.sweep(bodies, nodes, edges, paths.components(nodes, edges), require_radii=True))


def skeleton_boxes(spark, d):
    out = skeleton.boxes(skeletons(spark, d)[0], (8.0, 8.0, 4.0))
    return out.select("body_id", *[F.col(c).cast("long").alias(c) for c in out.columns[1:]])


def transformed_nodes(spark, d):
    moved = skeleton.transformed(skeletons(spark, d)[0], [[2, 0, 0, 5], [0, 2, 0, -1], [0, 0, 2, 0]])
    return rounded(moved.select("body_id", "node_id", "z_nm", "y_nm", "x_nm", "radius_nm"))


def slab_edges(spark, d):
    return rounded(skeleton.slab(*skeletons(spark, d), 200.0, 1500.0))


def edge_samples(spark, d):
    found = skeleton.samples(*skeletons(spark, d), 250.0)
    return rounded(found.groupBy("body_id").agg(F.count("*").alias("n"), F.sum("radius_nm").alias("radii"), F.sum("z_nm").alias("z_sum")), 2)


def mean_cross_section(spark, d):
    cable = skeleton.cable_length(*skeletons(spark, d, True))
    both = sweep.volumes(voxels(spark, d), (8.0, 8.0, 8.0)).join(cable, "body_id")
    area, radius = calibre.cross_section(F.col("volume_nm3"), F.col("cable_nm"))
    return rounded(both.select("body_id", area.alias("area_nm2"), radius.alias("radius_nm")))


def _points(spark, d):
    """All points, and as nodes the first one of each body in each cell of 0.2."""
    rows = points(spark, d)
    cell = [F.floor(F.col(a) / 0.2).alias(f"c{a}") for a in "zyx"]
    first = rows.groupBy("body_id", *cell).agg(F.min(F.struct(F.col("point_id").alias("node_id"), *[F.col(a).alias(f"{a}_nm") for a in "zyx"])).alias("n"))
    return rows, first.select("body_id", "n.*")


def nearest_nodes(spark, d):
    at, nodes = _points(spark, d)
    return rounded(calibre.nearest_nodes(at, nodes, []), 5)


def nearest_by_grid(spark, d):
    at, nodes = _points(spark, d)
    return rounded(calibre.nearest_by_grid(at, nodes, 0.25), 5)


def nearest_node_binning(spark, d):
    return rounded(calibre.bin_to_nodes(*_points(spark, d)), 4)


def _shares(spark, d):
    return _points(spark, d)[1].select("body_id", "node_id", (1.0 + F.col("node_id") % 7).alias("share_nm"))


def node_radii(spark, d):
    return rounded(calibre.node_radii(calibre.bin_to_nodes(*_points(spark, d)), _shares(spark, d), 2.0))


def blob_signal(spark, d):
    return rounded(calibre.blob_signal(calibre.bin_to_nodes(*_points(spark, d)), _shares(spark, d), 0.2), 6)


def _near_points(spark, d):
    """A point by each node of the skeletons."""
    nodes, _ = skeletons(spark, d)
    return nodes.select(F.col("o_orderkey").alias("point_id"), "body_id", (F.col("z_nm") + 40).alias("z"), (F.col("y_nm") - 15).alias("y"), F.lit(3.5).alias("x"))


def attach_points(spark, d):
    return rounded(calibre.attach(_near_points(spark, d), *skeletons(spark, d)), 3)


def ball_region(spark, d):
    at, nodes = _points(spark, d)
    a = at.select("point_id", *[F.col(c).alias(f"a_{c}") for c in "zyx"])
    b = nodes.select("node_id", *[F.col(f"{c}_nm").alias(f"b_{c}") for c in "zyx"])
    return calibre.within(a, b, 0.05, []).where("point_id <> node_id").select("point_id").distinct()


def gap_candidates(spark, d):
    """Of each pair of components of a body at most 300 nm apart, the shortest link."""
    nodes, edges = skeletons(spark, d, True)
    named = nodes.join(paths.components(nodes, edges), ["body_id", "node_id"])
    a, b = (named.select("body_id", F.col("node_id").alias(f"{s}_node"), F.col("component").alias(f"{s}_part"), *[F.col(f"{c}_nm").alias(f"{s}_{c}") for c in "zyx"]) for s in "ab")
    pairs = calibre.within(a, b, 300.0, ["body_id"]).where("a_part < b_part")
    best = pairs.groupBy("body_id", "a_part", "b_part").agg(F.min(F.struct(F.round("d2", 6).alias("d2"), "a_node", "b_node")).alias("best"))
    return rounded(best.select("body_id", "a_part", "b_part", F.col("best.a_node").alias("a_node"), F.col("best.b_node").alias("b_node"), F.sqrt("best.d2").alias("gap_nm")), 4)


def bridge_gaps(spark, d):
    return paths.bridge_gaps(*skeletons(spark, d, True), 300.0)


def path_distances(spark, d):
    nodes, edges = skeletons(spark, d, True)
    return rounded(paths.path_distances(nodes.withColumn("is_source", F.col("node_id") == 1), edges))


def _inside(p):
    return p[:, 0] < 600.0


def synapse_distances(spark, d):
    nodes, edges = skeletons(spark, d, True)
    return rounded(paths.synapse_distances(nodes, edges, _near_points(spark, d), _inside, gap=400.0))


def synapse_summary(spark, d):
    return paths.summary(synapse_distances(spark, d))


def region_sample(spark, d):
    return rounded(simplify.region_sample(*skeletons(spark, d)))


def optimal_downsample(spark, d):
    nodes, edges = skeletons(spark, d)
    return rounded(simplify.optimal_downsample(nodes.withColumn("radius_nm", F.col("radius_nm") * 40), edges))


def agreement(spark, d):
    """Distances from each node of a skeleton to the nearest of a thinned one, and back."""
    nodes, _ = skeletons(spark, d)
    thin = nodes.where("node_id % 2 = 1")
    as_points = lambda n: n.select(F.col("node_id").alias("point_id"), "body_id", *[F.col(f"{a}_nm").alias(a) for a in "zyx"])
    out = None
    for name, a, b in (("ab", nodes, thin), ("ba", thin, nodes)):
        own = calibre.nearest_nodes(as_points(a), b, []).groupBy("body_id").agg(F.median("distance_nm").alias(f"{name}_median"), F.percentile("distance_nm", 0.9).alias(f"{name}_p90"), F.avg(F.when(F.col("distance_nm") > 100, 1.0).otherwise(0.0)).alias(f"{name}_far"))
        out = own if out is None else out.join(own, "body_id")
    n = nodes.groupBy("body_id").agg((F.count_if(F.col("node_id") % 2 == 1) / F.count("*")).alias("node_ratio"))
    return rounded(out.join(n, "body_id"))


def tube_overlap(spark, d):
    nodes, _ = skeletons(spark, d)
    thick = nodes.withColumn("radius_nm", F.col("radius_nm") * 10)
    tube = volume.rasterised(thick, 40.0, (80, 20, 5))
    mask = tube.where("(z + y) % 3 <> 0")
    out = volume.overlap(tube, mask)
    return rounded(out, 6)


def mesh_metrics(spark, d):
    """Each inner node of a heap tree and its two children make a face."""
    nodes, _ = skeletons(spark, d)
    vertices = nodes.select("body_id", F.col("node_id").alias("vertex_id"), *[F.col(f"{a}_nm").alias(a) for a in "zyx"])
    n = nodes.groupBy("body_id").agg(F.max("node_id").alias("n"))
    faces = nodes.join(n, "body_id").where("2 * node_id + 1 <= n and node_id % 3 <> 0").select("body_id", F.col("node_id").alias("a"), (F.col("node_id") * 2).alias("b"), (F.col("node_id") * 2 + 1).alias("c"))
    area = volume.mesh_area(vertices, faces)
    parts = paths.components(nodes, volume.mesh_edges(faces).withColumn("edge_id", F.col("src") * 100000 + F.col("dst"))).groupBy("body_id").agg(F.count_distinct("component").alias("n_components"))
    return rounded(parts.join(area, "body_id", "left").na.fill(0.0, ["area_nm2"]), 2)


def mesh_fragment_offsets(spark, d):
    nodes, _ = skeletons(spark, d)
    rows = nodes.select("body_id", (F.col("node_id") % 3).cast("int").alias("lod"), F.col("node_id").alias("fragment"), (F.col("o_orderkey") % 100).alias("n_vertices"))
    return volume.rebased(rows)


def swc_tables(spark, d):
    nodes, _ = skeletons(spark, d)
    one = nodes
    parent = F.when(F.col("node_id") == 1, -1).when(F.col("o_orderkey") % 5 == 0, 999).otherwise(F.expr("node_id div 2"))
    text = one.select("body_id", F.concat_ws(" ", F.col("node_id") + F.col("body_id") * 1000, F.lit(0), F.col("x_nm").cast("int"), F.lit(2), F.col("z_nm").cast("int"), F.col("radius_nm").cast("int"), F.when(parent > 0, parent + F.col("body_id") * 1000).otherwise(-1)).alias("value"))
    return skeleton.swc_edges(text.select("value").unionByName(spark.createDataFrame([("# id type x y z r parent",), ("  ",)], "value string")))[1]


def method_pairs(spark, d):
    from ..operators import tables

    nodes, _ = skeletons(spark, d)
    rows = nodes.groupBy("body_id", F.concat(F.lit("m"), F.col("node_id") % 3).alias("method")).agg(F.min("o_orderkey").alias("seq"), F.count("*").alias("nodes"), F.sum("y_nm").alias("cable")).withColumn("error", F.when(F.col("seq") % 11 == 0, "x"))
    return rounded(tables.paired_medians(tables.paired(rows, "m1")), 4)


def _rods(spark, d):
    """A rod along z for each supplier, as long and thick as its key has it."""
    rows = read(spark, d, "supplier").select((F.col("s_suppkey") + 1).alias("body_id"), (40 + F.col("s_suppkey") % 50).cast("int").alias("n"), (2 + F.col("s_suppkey") % 3).cast("int").alias("r"))
    for a, low, high in (("z", F.lit(0), F.col("n") - 1), ("dy", -F.col("r"), F.col("r")), ("dx", -F.col("r"), F.col("r"))):
        rows = rows.withColumn(a, F.explode(F.sequence(low, high)))
    return rows.where("dy * dy + dx * dx <= r * r").select("z", (F.col("dy") + 10).alias("y"), (F.col("dx") + 10).alias("x"), "body_id")


def trace_blocks(spark, d):
    found = trace.skeletonize_blocks(_rods(spark, d), 32, 8.0)
    return found.groupBy("body_id", "block").agg(F.count("*").alias("nodes"), F.max("radius_nm").alias("max_radius_nm"))


def fuse_skeletons(spark, d):
    found = trace.fuse_bodies(trace.skeletonize_blocks(_rods(spark, d), 32, 8.0), 16.0, 100.0, 100.0)
    return rounded(found.drop("z_nm", "y_nm", "x_nm", "radii", "src", "dst"))


def fusion_totals(spark, d):
    return rounded(trace.fusion_summary(trace.fuse_bodies(trace.skeletonize_blocks(_rods(spark, d), 32, 8.0), 16.0, 100.0, 100.0)))


def fusion_grid(spark, d):
    return rounded(trace.fusion_grid(trace.skeletonize_blocks(_rods(spark, d), 32, 8.0), 16.0, [0.0, 300.0], [0.0, 200.0]))


def _paths(spark, d):
    return skeletons(spark, d)[0].withColumnRenamed("node_id", "pos")


def path_steps(spark, d):
    return rounded(sequences.path_length(_paths(spark, d), ["body_id"]))


def trailing_valid(spark, d):
    return rounded(sequences.trailing_run(_paths(spark, d), ["body_id"], F.col("o_orderkey") % 4 != 0))


def path_suffix(spark, d):
    return sequences.after_last(_paths(spark, d), ["body_id"], F.col("o_orderkey") % 7 == 0).select("body_id", "pos")


def named_labels(spark, d):
    names = read(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("label"))
    wanted = [r[0] for r in names.where("label in (7, 3, 11)").orderBy(F.desc("label")).select("name").collect()]
    return sequences.named_labels(names, wanted)


def swc_forest(spark, d):
    return paths.rooted(*skeletons(spark, d, True))


def skeleton_stats(spark, d):
    nodes, edges = skeletons(spark, d, True)
    cable = skeleton.cable_length(nodes, edges).select("body_id", F.round(F.col("cable_nm") / 1000, 1).alias("cable_um"))
    shape = skeleton.topology(nodes, edges, paths.components(nodes, edges))
    return shape.join(paths.twig_counts(nodes, edges, 300.0), "body_id", "left").join(cable, "body_id", "left").na.fill(0, ["n_twigs", "cable_um"])


QUERIES = {f.__name__: f for f in (edge_lengths, cable_length, cable_shares, components, topology, diameter_stats, frustum_volume_area, measure_skeletons, sweep_skeletons, skeleton_boxes, transformed_nodes, slab_edges, edge_samples, mean_cross_section, nearest_nodes, nearest_by_grid, nearest_node_binning, node_radii, blob_signal, attach_points, ball_region, gap_candidates, bridge_gaps, path_distances, synapse_distances, synapse_summary, region_sample, optimal_downsample, agreement, tube_overlap, mesh_metrics, mesh_fragment_offsets, swc_tables, method_pairs, trace_blocks, fuse_skeletons, fusion_totals, fusion_grid, path_steps, trailing_valid, path_suffix, named_labels, swc_forest, skeleton_stats)}

# a broken heap tree's component is the first node upwards whose edge is missing
_UP = """walk AS (SELECT body_id, node_id, node_id AS top, 0.0::DOUBLE AS dist FROM nodes UNION ALL
  SELECT w.body_id, w.node_id, e.src, w.dist + e.length_nm FROM walk w JOIN ends e ON e.body_id = w.body_id AND e.dst = w.top)"""
_TOP = "tops AS (SELECT body_id, node_id, min(top) AS component, max(dist) AS dist FROM walk GROUP BY body_id, node_id)"
_COMP = f"WITH RECURSIVE {NODES}, {BROKEN}, {ENDS}, {_UP}, {_TOP}"
_CABLE = "cable AS (SELECT n.body_id, coalesce(sum(e.length_nm), 0) AS cable_nm FROM (SELECT DISTINCT body_id FROM nodes) n LEFT JOIN ends e USING (body_id) GROUP BY n.body_id)"
_TOPOLOGY = """deg AS (SELECT n.body_id, n.node_id, count(e.node_id) AS g FROM nodes n LEFT JOIN (SELECT body_id, src AS node_id FROM edges UNION ALL SELECT body_id, dst FROM edges) e USING (body_id, node_id) GROUP BY n.body_id, n.node_id),
  topo AS (SELECT body_id, count(*) AS n_vertices, count(*) FILTER (WHERE g = 1) AS n_tips, count(*) FILTER (WHERE g > 2) AS n_branches FROM deg GROUP BY body_id),
  shape AS (SELECT t.*, coalesce(k, 0) AS n_edges, n_vertices - coalesce(k, 0) AS n_components FROM topo t LEFT JOIN (SELECT body_id, count(*) AS k FROM edges GROUP BY body_id) USING (body_id))"""
_QUANT = """tubes AS (SELECT body_id, edge_id, ra + rb AS d, length_nm AS w FROM ends WHERE length_nm > 0), cum AS (SELECT *, sum(w) OVER (PARTITION BY body_id ORDER BY d, edge_id ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY body_id) AS t FROM tubes),
  quant AS (SELECT body_id, min(d) FILTER (WHERE c >= 0.1 * t) AS p10, min(d) FILTER (WHERE c >= 0.5 * t) AS p50, min(d) FILTER (WHERE c >= 0.9 * t) AS p90, min(d) FILTER (WHERE c >= 0.99 * t - 1e-9) AS p99, sum(d * w) / sum(w) AS mean_nm, max(d) AS max_nm FROM cum GROUP BY body_id)"""
_FRUSTA = "frusta AS (SELECT body_id, sum(pi() / 3 * length_nm * (ra * ra + ra * rb + rb * rb)) AS volume_nm3, sum(pi() * (ra + rb) * sqrt(length_nm * length_nm + (rb - ra) * (rb - ra))) AS area_nm2 FROM ends GROUP BY body_id)"
_NEAR = f"WITH {POINTS}, n AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY body_id, floor(z/0.2), floor(y/0.2), floor(x/0.2) ORDER BY point_id) = 1), pairs AS (SELECT p.point_id, p.body_id, n.point_id AS node_id, (p.z-n.z)*(p.z-n.z)+(p.y-n.y)*(p.y-n.y)+(p.x-n.x)*(p.x-n.x) AS d2 FROM points p JOIN n USING (body_id)), near AS (SELECT point_id, body_id, node_id, sqrt(d2) AS d FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY d2, node_id) AS r FROM pairs) WHERE r = 1), bins AS (SELECT body_id, node_id, count(*) AS n, sum(d) AS s, 1.0::DOUBLE + node_id % 7 AS share FROM near GROUP BY body_id, node_id)"
_SYN = "points AS (SELECT o_orderkey AS point_id, body_id, z_nm + 40 AS z, y_nm - 15 AS y, 3.5::DOUBLE AS x FROM nodes)"
_AT = ", ".join(f"a.{c}_nm AS a{c}, b.{c}_nm - a.{c}_nm AS s{c}" for c in "zyx")

SQL = {
    "edge_lengths": f"WITH {NODES}, {EDGES}, {ENDS} SELECT body_id, edge_id, src, dst, round(length_nm, 4) AS length_nm FROM ends",
    "cable_length": f"WITH {NODES}, {BROKEN}, {ENDS}, {_CABLE} SELECT body_id, round(cable_nm, 4) AS cable_nm FROM cable",
    "cable_shares": f"WITH {NODES}, {BROKEN}, {ENDS} SELECT n.body_id, n.node_id, round(coalesce(sum(length_nm / 2), 0), 4) AS share_nm FROM nodes n LEFT JOIN (SELECT body_id, src AS node_id, length_nm FROM ends UNION ALL SELECT body_id, dst, length_nm FROM ends) e USING (body_id, node_id) GROUP BY n.body_id, n.node_id",
    "components": f"{_COMP} SELECT body_id, node_id, component FROM tops",
    "topology": f"WITH {NODES}, {BROKEN}, {_TOPOLOGY} SELECT * FROM shape",
    "diameter_stats": f"WITH {NODES}, {EDGES}, {ENDS}, {_QUANT} SELECT body_id, round(mean_nm, 4) AS mean_nm, max_nm, p10, p50, p90, p99 FROM quant",
    "frustum_volume_area": f"WITH {NODES}, {EDGES}, {ENDS}, {_FRUSTA} SELECT body_id, round(volume_nm3, 2) AS volume_nm3, round(area_nm2, 2) AS area_nm2 FROM frusta",
    "measure_skeletons": f"WITH {NODES}, {BROKEN}, {ENDS}, {_CABLE}, {_TOPOLOGY}, {_QUANT}, {_FRUSTA} SELECT 'test' AS dataset, 'all' AS variant, s.*, round(cable_nm, 2) AS cable_nm, round(mean_nm, 2) AS mean_nm, max_nm, p10, p50, p90, p99, round(volume_nm3, 2) AS volume_nm3, round(area_nm2, 2) AS area_nm2 FROM shape s JOIN cable USING (body_id) LEFT JOIN quant USING (body_id) LEFT JOIN frusta USING (body_id)",
    "sweep_skeletons": f"WITH {NODES}, {BROKEN}, {ENDS}, {_CABLE}, {_TOPOLOGY}, r AS (SELECT body_id, max(radius_nm) AS max_radius_nm FROM nodes GROUP BY body_id) SELECT s.body_id, CASE WHEN s.body_id % 4 IN (0, 3) THEN round(cable_nm, 4) END AS cable_nm, CASE WHEN s.body_id % 4 IN (0, 3) THEN n_branches END AS n_branches, CASE WHEN s.body_id % 4 IN (0, 3) THEN n_tips END AS n_tips, CASE WHEN s.body_id % 4 IN (0, 3) THEN max_radius_nm END AS max_radius_nm, CASE s.body_id % 4 WHEN 1 THEN 'absent' WHEN 2 THEN 'failed' ELSE 'written' END AS status FROM shape s JOIN cable USING (body_id) JOIN r USING (body_id)",
    "skeleton_boxes": f"WITH {NODES} SELECT body_id, CAST(floor(min(z_nm)/8) AS BIGINT) AS z0, CAST(floor(min(y_nm)/8) AS BIGINT) AS y0, CAST(floor(min(x_nm)/4) AS BIGINT) AS x0, CAST(ceil(max(z_nm)/8) AS BIGINT) AS z1, CAST(ceil(max(y_nm)/8) AS BIGINT) AS y1, CAST(ceil(max(x_nm)/4) AS BIGINT) AS x1 FROM nodes GROUP BY body_id",
    "transformed_nodes": f"WITH {NODES} SELECT body_id, node_id, round(2*z_nm+5, 4) AS z_nm, round(2*y_nm-1, 4) AS y_nm, round(2*x_nm, 4) AS x_nm, 2*radius_nm AS radius_nm FROM nodes",
    "slab_edges": f"WITH {NODES}, {EDGES}, {ENDS} SELECT e.body_id, e.edge_id, e.src, e.dst, round(length_nm, 4) AS length_nm FROM ends e JOIN nodes a ON a.body_id=e.body_id AND a.node_id=e.src JOIN nodes b ON b.body_id=e.body_id AND b.node_id=e.dst WHERE a.z_nm BETWEEN 200 AND 1500 AND b.z_nm BETWEEN 200 AND 1500",
    "edge_samples": f"WITH {NODES}, {EDGES}, {ENDS}, s AS (SELECT e.body_id, ra, rb, a.z_nm AS az, b.z_nm AS bz, k, greatest(ceil(length_nm/250), 1) AS n FROM ends e JOIN nodes a ON a.body_id=e.body_id AND a.node_id=e.src JOIN nodes b ON b.body_id=e.body_id AND b.node_id=e.dst, range(100) r(k) WHERE k <= greatest(ceil(length_nm/250), 1)), p AS (SELECT body_id, ra+k/n*(rb-ra) AS r, az+k/n*(bz-az) AS z FROM s UNION ALL SELECT body_id, radius_nm, z_nm FROM nodes) SELECT body_id, count(*) AS n, round(sum(r), 2) AS radii, round(sum(z), 2) AS z_sum FROM p GROUP BY body_id",
    "mean_cross_section": f"WITH {VOXELS}, {NODES}, {BROKEN}, {ENDS}, {_CABLE}, v AS (SELECT body_id, count(*) * 512.0::DOUBLE AS volume_nm3 FROM voxels WHERE body_id <> 0 GROUP BY body_id) SELECT body_id, CASE WHEN cable_nm > 0 THEN round(volume_nm3/cable_nm, 4) END AS area_nm2, CASE WHEN cable_nm > 0 THEN round(sqrt(volume_nm3/cable_nm/pi()), 4) END AS radius_nm FROM v JOIN cable USING (body_id)",
    "nearest_nodes": f"{_NEAR} SELECT point_id, body_id, node_id, round(d, 5) AS distance_nm FROM near",
    "nearest_by_grid": f"{_NEAR} SELECT point_id, body_id, node_id, round(d, 5) AS distance_nm FROM near",
    "nearest_node_binning": f"{_NEAR} SELECT body_id, node_id, n, round(s, 4) AS distance_sum_nm FROM bins",
    "node_radii": f"{_NEAR} SELECT body_id, node_id, round(sqrt(n*8.0::DOUBLE/(share*pi())), 4) AS radius_nm, share AS weight FROM bins",
    "blob_signal": f"{_NEAR} SELECT body_id, round(sum(CASE WHEN s/n > 1.25 * sqrt(n*0.008::DOUBLE/(share*pi())/2 + share*share/12) THEN share ELSE 0 END)/sum(share), 6) AS blob_fraction FROM bins GROUP BY body_id",
    "attach_points": f"WITH {NODES}, {EDGES}, {_SYN}, s AS (SELECT e.body_id, e.edge_id, a.radius_nm AS ra, b.radius_nm - a.radius_nm AS sr, {_AT} FROM edges e JOIN nodes a ON a.body_id=e.body_id AND a.node_id=e.src JOIN nodes b ON b.body_id=e.body_id AND b.node_id=e.dst), t AS (SELECT p.*, s.*, CASE WHEN sz*sz+sy*sy+sx*sx > 0 THEN least(greatest(((z-az)*sz+(y-ay)*sy+(x-ax)*sx)/(sz*sz+sy*sy+sx*sx), 0), 1) ELSE 0 END AS t FROM points p JOIN s USING (body_id)), q AS (SELECT *, (z-az-t*sz)*(z-az-t*sz)+(y-ay-t*sy)*(y-ay-t*sy)+(x-ax-t*sx)*(x-ax-t*sx) AS d2 FROM t), w AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(d2, 6), edge_id) AS r FROM q) SELECT point_id, body_id, edge_id, round(t, 3) AS t, round(sqrt(d2), 3) AS snap_nm, round(ra+t*sr, 3) AS radius_nm FROM w WHERE r = 1",
    "ball_region": f"WITH {POINTS}, n AS (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY body_id, floor(z/0.2), floor(y/0.2), floor(x/0.2) ORDER BY point_id) = 1) SELECT DISTINCT p.point_id FROM points p JOIN n ON p.point_id <> n.point_id AND (p.z-n.z)*(p.z-n.z)+(p.y-n.y)*(p.y-n.y)+(p.x-n.x)*(p.x-n.x) <= 0.05*0.05",
    "gap_candidates": f"{_COMP}, m AS (SELECT n.*, component FROM nodes n JOIN tops USING (body_id, node_id)), p AS (SELECT a.body_id, a.component AS a_part, b.component AS b_part, a.node_id AS a_node, b.node_id AS b_node, round((a.z_nm-b.z_nm)*(a.z_nm-b.z_nm)+(a.y_nm-b.y_nm)*(a.y_nm-b.y_nm)+(a.x_nm-b.x_nm)*(a.x_nm-b.x_nm), 6) AS d2 FROM m a JOIN m b ON a.body_id=b.body_id AND a.component < b.component), r AS (SELECT *, row_number() OVER (PARTITION BY body_id, a_part, b_part ORDER BY d2, a_node, b_node) AS r FROM p WHERE d2 <= 90000) SELECT body_id, a_part, b_part, a_node, b_node, round(sqrt(d2), 4) AS gap_nm FROM r WHERE r = 1",
    "path_distances": f"{_COMP} SELECT body_id, node_id, CASE WHEN component = 1 THEN round(dist, 4) END AS distance_nm, 0::BIGINT AS n_bridges, 0.0::DOUBLE AS bridge_nm, CASE WHEN component = 1 THEN 1 END::BIGINT AS source FROM tops",
    "agreement": f"""WITH {NODES}, ab AS (SELECT a.body_id, a.node_id, min(sqrt((a.z_nm-b.z_nm)*(a.z_nm-b.z_nm)+(a.y_nm-b.y_nm)*(a.y_nm-b.y_nm)+(a.x_nm-b.x_nm)*(a.x_nm-b.x_nm))) AS d FROM nodes a JOIN nodes b ON a.body_id=b.body_id AND b.node_id % 2 = 1 GROUP BY 1, 2),
        ba AS (SELECT a.body_id, a.node_id, min(sqrt((a.z_nm-b.z_nm)*(a.z_nm-b.z_nm)+(a.y_nm-b.y_nm)*(a.y_nm-b.y_nm)+(a.x_nm-b.x_nm)*(a.x_nm-b.x_nm))) AS d FROM nodes a JOIN nodes b ON a.body_id=b.body_id WHERE a.node_id % 2 = 1 GROUP BY 1, 2),
        x AS (SELECT body_id, median(d) AS m, quantile_cont(d, 0.9) AS p, avg(CASE WHEN d > 100 THEN 1.0::DOUBLE ELSE 0 END) AS f FROM ab GROUP BY body_id), y AS (SELECT body_id, median(d) AS m, quantile_cont(d, 0.9) AS p, avg(CASE WHEN d > 100 THEN 1.0::DOUBLE ELSE 0 END) AS f FROM ba GROUP BY body_id), n AS (SELECT body_id, count(*) FILTER (WHERE node_id % 2 = 1)::DOUBLE / count(*) AS q FROM nodes GROUP BY body_id)
        SELECT body_id, round(x.m, 4) AS ab_median, round(x.p, 4) AS ab_p90, round(x.f, 4) AS ab_far, round(y.m, 4) AS ba_median, round(y.p, 4) AS ba_p90, round(y.f, 4) AS ba_far, round(q, 4) AS node_ratio FROM x JOIN y USING (body_id) JOIN n USING (body_id)""",
    "mesh_metrics": f"WITH {NODES}, k AS (SELECT body_id, max(node_id) AS n FROM nodes GROUP BY body_id), f AS (SELECT node_id AS a, body_id FROM nodes JOIN k USING (body_id) WHERE 2*node_id+1 <= n AND node_id % 3 <> 0), p AS (SELECT f.body_id, q.z_nm-a.z_nm AS uz, q.y_nm-a.y_nm AS uy, q.x_nm-a.x_nm AS ux, r.z_nm-a.z_nm AS vz, r.y_nm-a.y_nm AS vy, r.x_nm-a.x_nm AS vx FROM f JOIN nodes a ON a.body_id=f.body_id AND a.node_id=f.a JOIN nodes q ON q.body_id=f.body_id AND q.node_id=2*f.a JOIN nodes r ON r.body_id=f.body_id AND r.node_id=2*f.a+1), s AS (SELECT body_id, sum(sqrt(pow(uy*vx-ux*vy,2)+pow(ux*vz-uz*vx,2)+pow(uz*vy-uy*vz,2)))/2 AS area, count(*) AS c FROM p GROUP BY body_id) SELECT body_id, n - 2*coalesce(c, 0) AS n_components, round(coalesce(area, 0), 2) AS area_nm2 FROM k LEFT JOIN s USING (body_id)",
    "mesh_fragment_offsets": f"WITH {NODES}, r AS (SELECT body_id, CAST(node_id % 3 AS INT) AS lod, node_id AS fragment, o_orderkey % 100 AS n_vertices, max(node_id % 3) OVER (PARTITION BY body_id) AS top FROM nodes) SELECT body_id, lod, fragment, n_vertices, CAST(coalesce(sum(n_vertices) OVER (PARTITION BY body_id ORDER BY fragment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS base FROM r WHERE lod = top",
    "swc_tables": f"WITH {NODES}, n AS (SELECT body_id*1000+node_id AS id, body_id*1000+node_id//2 AS parent FROM nodes WHERE node_id > 1 AND o_orderkey % 5 <> 0) SELECT id AS edge_id, parent AS src, id AS dst FROM n",
    "method_pairs": f"WITH {NODES}, r AS (SELECT body_id, 'm' || (node_id % 3) AS method, min(o_orderkey) AS seq, count(*) AS nodes, sum(y_nm) AS cable FROM nodes GROUP BY 1, 2), g AS (SELECT * FROM r WHERE seq % 11 <> 0), p AS (SELECT a.method, a.nodes::DOUBLE/b.nodes AS q, a.cable-b.cable AS d FROM g a JOIN g b ON a.body_id=b.body_id AND b.method='m1' AND a.method<>'m1') SELECT method, count(*) AS n, round(median(q), 4) AS node_ratio, round(median(d), 4) AS cable_difference, count(*) FILTER (WHERE d > 0) AS n_ahead FROM p GROUP BY method",
    "path_steps": f"WITH {NODES}, s AS (SELECT body_id, sqrt(pow(z_nm - lag(z_nm) OVER w, 2) + pow(y_nm - lag(y_nm) OVER w, 2) + pow(x_nm - lag(x_nm) OVER w, 2)) AS d FROM nodes WINDOW w AS (PARTITION BY body_id ORDER BY node_id)) SELECT body_id, round(coalesce(sum(d), 0), 4) AS length_nm FROM s GROUP BY body_id",
    "trailing_valid": f"WITH {NODES}, s AS (SELECT *, sqrt(pow(z_nm - lag(z_nm) OVER w, 2) + pow(y_nm - lag(y_nm) OVER w, 2) + pow(x_nm - lag(x_nm) OVER w, 2)) AS d FROM nodes WINDOW w AS (PARTITION BY body_id ORDER BY node_id)), b AS (SELECT body_id, max(CASE WHEN o_orderkey % 4 = 0 THEN node_id ELSE 0 END) AS last FROM nodes GROUP BY body_id) SELECT body_id, count(*) FILTER (WHERE node_id > last) AS n_valid, round(coalesce(sum(d) FILTER (WHERE node_id > last + 1), 0), 4) AS valid_nm FROM s JOIN b USING (body_id) GROUP BY body_id",
    "path_suffix": f"WITH {NODES}, b AS (SELECT body_id, max(CASE WHEN o_orderkey % 7 = 0 THEN node_id END) AS last FROM nodes GROUP BY body_id) SELECT body_id, node_id AS pos FROM nodes JOIN b USING (body_id) WHERE last IS NULL OR node_id >= last",
    "named_labels": "SELECT CAST(row_number() OVER (ORDER BY n_nationkey DESC) - 1 AS INT) AS pos, n_name AS name, n_nationkey AS label FROM nation WHERE n_nationkey IN (7, 3, 11)",
    # a tree's root is its node with the fewest edges; depth by going along edges and not back
    "swc_forest": f"""{_COMP}, near AS (SELECT body_id, src AS a, dst AS b FROM edges UNION ALL SELECT body_id, dst, src FROM edges), g AS (SELECT t.body_id, t.node_id, component, count(near.a) AS g FROM tops t LEFT JOIN near ON near.body_id = t.body_id AND near.a = t.node_id GROUP BY ALL),
      roots AS (SELECT body_id, node_id FROM (SELECT *, row_number() OVER (PARTITION BY body_id, component ORDER BY g, node_id) AS r FROM g) WHERE r = 1),
      down AS (SELECT body_id, node_id, (-1)::BIGINT AS parent, 0::BIGINT AS depth FROM roots UNION ALL SELECT d.body_id, near.b, d.node_id, d.depth + 1 FROM down d JOIN near ON near.body_id = d.body_id AND near.a = d.node_id WHERE near.b <> d.parent) SELECT body_id, node_id, parent, depth FROM down""",
    "tube_overlap": f"""WITH {NODES}, c AS (SELECT DISTINCT body_id, CAST(round_even(z_nm / 40, 0) AS INT) AS cz, CAST(round_even(y_nm / 40, 0) AS INT) AS cy, CAST(round_even(x_nm / 40, 0) AS INT) AS cx, CAST(round_even(radius_nm * 10 / 40, 0) AS INT) AS r FROM nodes),
      t AS (SELECT DISTINCT body_id, cz + i AS z, cy + j AS y, cx + k AS x FROM c, range(-5, 6) a(i), range(-5, 6) b(j), range(-5, 6) e(k) WHERE i*i + j*j + k*k <= r*r AND cz + i BETWEEN 0 AND 79 AND cy + j BETWEEN 0 AND 19 AND cx + k BETWEEN 0 AND 4),
      n AS (SELECT body_id, count(*) AS n_tube, count(*) FILTER (WHERE (z + y) % 3 <> 0) AS n_mask FROM t GROUP BY body_id) SELECT body_id, n_tube, n_mask, n_mask AS n_both, round(n_mask / greatest(n_mask, 1)::DOUBLE, 6) AS coverage, round((n_tube - n_mask) / greatest(n_tube, 1)::DOUBLE, 6) AS spill FROM n""",
}
