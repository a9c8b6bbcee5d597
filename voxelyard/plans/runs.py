"""Queries of run control, regions, files as rows, and the plain geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import frames
from ..operators import calibre, ledger, paths, regions, skeleton, sweep, tables, volume
from ..sources import bodies, readers, sinks
from ..sources.bind import BROKEN, EDGES, ENDS, LEDGER, NODES, VOXELS, read, skeletons, voxels
from ..sources.bind import ledger as events
from .skeletons import _CABLE, _COMP, _FRUSTA, rounded


def manifest_records(spark, d):
    """The ledger as lines of a manifest: some torn, some without a status, some of the old form."""
    rows = events(spark, d)
    name = lambda c: F.when(F.col("seq") % 3 == 0, F.lit(None)).otherwise(F.col(c))
    cells = F.struct(name("grp").alias("group"), F.when(F.col("seq") % 3 == 0, F.col("grp")).alias("level"), "key", F.when(F.col("seq") % 5 != 0, F.col("status")).alias("status"))
    whole = rows.select("seq", F.to_json(cells).alias("line"))
    return readers.records(whole.select(F.when(F.col("seq") % 7 == 0, F.expr("left(line, length(line) - 1)")).otherwise(F.col("line")).alias("value")))


def stale_keys(spark, d):
    """Keys told as written of which there is no customer."""
    return ledger.stale(events(spark, d), read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("key")), ["key"])


def progress_rates(spark, d):
    """What came in the second half of the events, by group, in ten minutes."""
    rows = events(spark, d)
    half = rows.agg(F.max("seq")).first()[0] // 2
    counts = lambda df: df.groupBy("grp").agg(F.count("*").alias("n"))
    return rounded(ledger.rates(counts(rows.where(F.col("seq") <= half)), counts(rows), "grp", F.lit(10)), 6)


def stage_progress(spark, d):
    stages = spark.createDataFrame([("g0", 10), ("g1", 20)], "stage string, n_planned long")
    stages = ledger.planned(ledger.planned(stages, "g1", 500), "g9", 7)
    return ledger.progress(stages, events(spark, d).withColumnRenamed("grp", "stage"))


def _bodies(spark, d):
    k = F.col("c_custkey")
    return read(spark, d, "customer").select(k.alias("body_id"), (k * 3).alias("z0"), (k * 7).alias("voxel_count"), (k * 0.5).cast("double").alias("volume_nm3"), (k * 2.0).alias("cable_length_nm"), k.alias("n_tips"))


def reset_sweep(spark, d):
    return ledger.reset_sweep(_bodies(spark, d))


def reset_skeletons(spark, d):
    return ledger.reset_skeletons(_bodies(spark, d))


def dust_filter(spark, d):
    """Labels of bodies that have nine voxels or more."""
    kept = volume.without_dust(voxels(spark, d), ["body_id", "label"], 9)
    return kept.groupBy("body_id", "label").agg(F.count("*").alias("n"))


def finite_values(spark, d):
    k = F.col("p_partkey")
    value = F.when(k % 11 == 0, float("nan")).when(k % 13 == 0, float("-inf")).when(k % 17 != 0, k.cast("double"))
    rows = read(spark, d, "part").select("p_partkey", value.alias("value"), (k % 4).cast("double").alias("weight"))
    return tables.finite(rows, ["value"], "weight").select("p_partkey", "value")


def physical_boxes(spark, d):
    found = sweep.boxes(voxels(spark, d))
    nm = frames.physical_box({c: F.col(c) for c in ledger.BOX}, (8.0, 4.0, 2.0))
    return found.select("body_id", *[c.cast("double").alias(n) for n, c in nm.items()])


def crop_to_physical(spark, d):
    """Nodes as if given from the corner of their body's crop."""
    nodes, _ = skeletons(spark, d)
    moved = frames.to_physical({a: F.col("body_id") + k for k, a in enumerate("zyx")}, (8.0, 4.0, 2.0))
    return rounded(nodes.select("body_id", "node_id", *[c.alias(n) for n, c in moved.items()]), 6)  # ties at four places


def flat_places(spark, d):
    shape = (64, 96, 50)
    rows = voxels(spark, d).select((F.col("z") % 64).alias("z"), (F.col("y") % 96).alias("y"), (F.col("x") % 50).alias("x")).distinct()
    at = rows.select(frames.flat(shape).alias("place"))
    return at.select("place", *[c.cast("int").alias(a) for a, c in zip("zyx", frames.unflat(F.col("place"), shape))])


def skeleton_graph(spark, d):
    """Links of skeletons whose edges come twice, once turned round, and with loops."""
    nodes, edges = skeletons(spark, d)
    turned = edges.select("body_id", "edge_id", F.col("dst").alias("src"), F.col("src").alias("dst"))
    loops = edges.select("body_id", "edge_id", "src", F.col("src").alias("dst"))
    return rounded(skeleton.links(nodes, edges.unionByName(turned).unionByName(loops)), 6)


def _dense(spark, d):
    """Voxels folded into a cube, so that they have neighbours."""
    fold = [(F.col(a) % 24).cast("int").alias(a) for a in "zyx"]
    return voxels(spark, d).select((F.col("label") % 2 + 1).cast("long").alias("body_id"), *fold)


def neighbour_costs(spark, d):
    cells = _dense(spark, d).groupBy("body_id", "z", "y", "x").agg(F.count("*").cast("double").alias("cost"))
    return rounded(volume.neighbour_costs(cells).groupBy("body_id", "z", "y", "x").agg(F.count("*").alias("n"), F.sum("cost").alias("cost")), 6)


def surface_faces(spark, d):
    return volume.surface(_dense(spark, d), (8.0, 4.0, 2.0))


def stripes(spark, d):
    found = sinks.stripes(volume.runs(_dense(spark, d)))
    return found.select("body_id", "z", "y", F.array_join(F.transform("runs", lambda r: F.array_join(F.transform(r, lambda v: v.cast("string")), "-")), ",").alias("runs"))


def label_region(spark, d):
    """Nodes that lie in voxels of three labels."""
    fold = [(F.col(a) % n).cast("int").alias(a) for a, n in (("z", 64), ("y", 64), ("x", 8))]
    names = read(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("int").alias("label"))
    first = names.where("label = 1").first()["name"]
    labels = regions.label_ids(names, [first, 4, 6])
    points = skeletons(spark, d)[0].select("body_id", "node_id", *[F.col(f"{a}_nm").alias(a) for a in "zyx"])
    return regions.in_labels(points, voxels(spark, d).select(*fold, "label"), labels, (40.0, 8.0, 4.0)).select("body_id", "node_id", "in_roi")


def near_region(spark, d):
    """Nodes within 120 nm of one of their own body's nodes with a sixth part of the orders."""
    nodes = skeletons(spark, d)[0].select("body_id", "node_id", "o_orderkey", *[F.col(f"{a}_nm").alias(a) for a in "zyx"])
    return regions.near_points(nodes, nodes.where("o_orderkey % 6 = 1"), 120.0, ["body_id", "node_id"], ["body_id"]).select("body_id", "node_id", "in_roi")


def bad_radii(spark, d):
    r = F.when(F.col("o_orderkey") % 9 == 0, float("nan")).when(F.col("o_orderkey") % 10 == 0, -1.0).when(F.col("o_orderkey") % 11 != 0, F.col("radius_nm"))
    return bodies.bad_radii(skeletons(spark, d)[0].withColumn("radius_nm", r))


def mean_radius(spark, d):
    nodes, edges = skeletons(spark, d, True)
    both = skeleton.frusta(nodes, edges).join(skeleton.cable_length(nodes, edges), "body_id")
    return rounded(both.select("body_id", calibre.mean_radius(F.col("area_nm2"), F.col("cable_nm")).alias("radius_nm")))


def component_sizes(spark, d):
    """Components of five nodes or more; what is smaller is dust."""
    nodes, edges = skeletons(spark, d, True)
    kept = volume.without_dust(paths.components(nodes, edges), ["body_id", "component"], 5)
    return kept.groupBy("body_id", "component").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (manifest_records, stale_keys, progress_rates, stage_progress, reset_sweep, reset_skeletons, dust_filter, finite_values, physical_boxes, crop_to_physical, flat_places, skeleton_graph, neighbour_costs, surface_faces, stripes, label_region, near_region, bad_radii, mean_radius, component_sizes)}

_DENSE = f"{VOXELS}, dense AS (SELECT CAST(label % 2 + 1 AS BIGINT) AS body_id, z % 24 AS z, y % 24 AS y, x % 24 AS x, count(*)::DOUBLE AS cost FROM voxels GROUP BY ALL)"
_FINAL = "final AS (SELECT key, grp, status FROM (SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY seq DESC) AS r FROM ledger) WHERE r = 1)"


def _hidden(axis):
    others = " AND ".join(f"a.{c} = b.{c}" for c in "zyx" if c != axis)
    return f"(SELECT count(*) FROM dense a JOIN dense b ON a.body_id = b.body_id AND {others} AND b.{axis} = a.{axis} + 1 WHERE a.body_id = k.body_id)"


SQL = {
    "manifest_records": f"WITH {LEDGER} SELECT grp AS \"group\", key, status FROM ledger WHERE seq % 5 <> 0 AND seq % 7 <> 0",
    "stale_keys": f"WITH {LEDGER}, {_FINAL.format('key')} SELECT key FROM final WHERE status = 'written' AND key NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)",
    "progress_rates": f"WITH {LEDGER} SELECT grp, count(*) FILTER (WHERE seq > (SELECT max(seq) // 2 FROM ledger)) AS n, round(count(*) FILTER (WHERE seq > (SELECT max(seq) // 2 FROM ledger)) / 10.0::DOUBLE, 6) AS rate FROM ledger GROUP BY grp",
    "stage_progress": f"WITH {LEDGER}, {_FINAL.format('grp, key')}, s(stage, n_planned) AS (VALUES ('g0', 10::BIGINT), ('g1', 500), ('g9', 7)) SELECT stage, n_planned, count(*) FILTER (WHERE status <> 'failed') AS done, count(*) FILTER (WHERE status = 'failed') AS failed FROM s LEFT JOIN final ON grp = stage GROUP BY ALL",
    "reset_sweep": "SELECT c_custkey AS body_id, c_custkey * 3 AS z0, 0::BIGINT AS voxel_count, 0.0::DOUBLE AS volume_nm3, c_custkey * 2.0::DOUBLE AS cable_length_nm, c_custkey AS n_tips FROM customer",
    "reset_skeletons": "SELECT c_custkey AS body_id, c_custkey * 3 AS z0, c_custkey * 7 AS voxel_count, c_custkey * 0.5::DOUBLE AS volume_nm3, NULL::DOUBLE AS cable_length_nm, NULL::BIGINT AS n_tips FROM customer",
    "dust_filter": f"WITH {VOXELS} SELECT body_id, label, count(*) AS n FROM voxels GROUP BY body_id, label HAVING count(*) >= 9",
    "finite_values": "SELECT p_partkey, p_partkey::DOUBLE AS value FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 4 > 0",
    "physical_boxes": f"WITH {VOXELS} SELECT body_id, min(z) * 8.0::DOUBLE AS z0_nm, min(y) * 4.0::DOUBLE AS y0_nm, min(x) * 2.0::DOUBLE AS x0_nm, (max(z) + 1) * 8.0::DOUBLE AS z1_nm, (max(y) + 1) * 4.0::DOUBLE AS y1_nm, (max(x) + 1) * 2.0::DOUBLE AS x1_nm FROM voxels WHERE body_id <> 0 GROUP BY body_id",
    "crop_to_physical": f"WITH {NODES} SELECT body_id, node_id, round(z_nm + body_id * 8, 6) AS z_nm, round(y_nm + (body_id + 1) * 4, 6) AS y_nm, round(x_nm + (body_id + 2) * 2, 6) AS x_nm FROM nodes",
    "flat_places": f"WITH {VOXELS} SELECT DISTINCT (z % 64)::BIGINT + (y % 96) * 64 + (x % 50) * 6144 AS place, z % 64 AS z, y % 96 AS y, x % 50 AS x FROM voxels",
    "skeleton_graph": f"WITH {NODES}, {EDGES}, {ENDS}, w AS (SELECT body_id, src, dst, round(greatest(length_nm, 1e-6), 6) AS weight FROM ends WHERE src <> dst) SELECT body_id, src AS node_id, dst AS other, weight FROM w UNION ALL SELECT body_id, dst, src, weight FROM w",
    "neighbour_costs": f"WITH {_DENSE} SELECT a.body_id, a.z, a.y, a.x, count(*) AS n, round(sum(sqrt((a.z-b.z)*(a.z-b.z)+(a.y-b.y)*(a.y-b.y)+(a.x-b.x)*(a.x-b.x)) * (a.cost + b.cost)), 6) AS cost FROM dense a, dense b, range(-1, 2) i(i), range(-1, 2) j(j), range(-1, 2) k(k) WHERE a.body_id = b.body_id AND b.z = a.z + i AND b.y = a.y + j AND b.x = a.x + k AND (i > 0 OR (i = 0 AND j > 0) OR (i = 0 AND j = 0 AND k > 0)) GROUP BY a.body_id, a.z, a.y, a.x",
    "surface_faces": f"WITH {_DENSE}, k AS (SELECT body_id, count(*) AS n FROM dense GROUP BY body_id), f AS (SELECT body_id, 2*(n - {_hidden('z')}) AS faces_z, 2*(n - {_hidden('y')}) AS faces_y, 2*(n - {_hidden('x')}) AS faces_x FROM k) SELECT *, faces_z * 8.0::DOUBLE + faces_y * 16.0::DOUBLE + faces_x * 32.0::DOUBLE AS area_nm2 FROM f",
    "stripes": f"WITH {_DENSE}, i AS (SELECT *, x - row_number() OVER (PARTITION BY body_id, z, y ORDER BY x) AS g FROM dense), r AS (SELECT body_id, z, y, min(x) AS x0, max(x) AS x1 FROM i GROUP BY body_id, z, y, g) SELECT body_id, z, y, string_agg(x0 || '-' || x1, ',' ORDER BY x0) AS runs FROM r GROUP BY body_id, z, y",
    "label_region": f"WITH {VOXELS}, {NODES}, m AS (SELECT DISTINCT z % 64 AS z, y % 64 AS y, x % 8 AS x FROM voxels WHERE label IN (1, 4, 6)) SELECT body_id, node_id, m.z IS NOT NULL AS in_roi FROM nodes LEFT JOIN m ON m.z = floor(z_nm / 40) AND m.y = floor(y_nm / 8) AND m.x = floor(x_nm / 4)",
    "near_region": f"WITH {NODES} SELECT a.body_id, a.node_id, EXISTS (SELECT 1 FROM nodes b WHERE b.body_id = a.body_id AND b.o_orderkey % 6 = 1 AND (a.z_nm-b.z_nm)*(a.z_nm-b.z_nm)+(a.y_nm-b.y_nm)*(a.y_nm-b.y_nm)+(a.x_nm-b.x_nm)*(a.x_nm-b.x_nm) <= 14400) AS in_roi FROM nodes a",
    "bad_radii": f"WITH {NODES} SELECT body_id, count(*) FILTER (WHERE o_orderkey % 9 = 0 OR o_orderkey % 10 = 0 OR o_orderkey % 11 = 0) AS n_bad FROM nodes GROUP BY body_id",
    "mean_radius": f"WITH {NODES}, {BROKEN}, {ENDS}, {_CABLE}, {_FRUSTA} SELECT body_id, CASE WHEN cable_nm > 0 THEN round(area_nm2 / (2 * pi() * cable_nm), 4) END AS radius_nm FROM frusta JOIN cable USING (body_id)",
    "component_sizes": f"{_COMP} SELECT body_id, component, count(*) AS n FROM tops GROUP BY body_id, component HAVING count(*) >= 5",
}
