"""Queries of volumes in chunks and bricks, of fields and surfaces, and of graphs spread over tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import fields, regions, sweep, volume, wide
from ..sources import bricks, chunks
from ..sources.bind import NODES, VOXELS, read, skeletons, voxels
from ..sources.scratch import folder
from .runs import _DENSE, _dense
from .skeletons import _COMP, rounded

SHAPE = (192, 128, 50)
REGION = (40, 10, 0, 130, 100, 37)
CUBE = (24, 24, 24)
NM = (8.0, 4.0, 2.0)


def _folded(spark, d):
    return voxels(spark, d).select((F.col("z") % SHAPE[0]).alias("z"), (F.col("y") % SHAPE[1]).alias("y"), (F.col("x") % SHAPE[2]).alias("x"), "body_id")


def region_scan(spark, d):
    """Bodies of a region of a volume that is written in chunks and read back."""
    path = folder(spark, "volume")
    chunks.write(_folded(spark, d), path, SHAPE, 64, NM)
    return sweep.boxes(chunks.region(spark, path, REGION))


def two_volumes(spark, d):
    """Voxels by body and label, of two volumes in bricks of one grid: line items', and labels of orders."""
    seg = _folded(spark, d).groupBy("z", "y", "x").agg(F.min("body_id").alias("body_id"))
    month = read(spark, d, "orders").select((F.col("o_orderkey") % SHAPE[0]).cast("int").alias("z"), (F.col("o_custkey") % SHAPE[1]).cast("int").alias("y"), (F.floor("o_totalprice") % SHAPE[2]).cast("int").alias("x"), F.month("o_orderdate").alias("label"))
    sem = month.groupBy("z", "y", "x").agg(F.max("label").alias("label"))
    run = uuid.uuid4().hex
    for name, rows in (("seg", seg), ("sem", sem)):
        bricks.save(rows, f"{name}_{run}", 32, 16)
    return sweep.joint_counts(bricks.labelled(spark, f"seg_{run}", f"sem_{run}"))


def distance_field(spark, d):
    return rounded(fields.distance_field(_dense(spark, d), CUBE, NM), 6)


def radius_against_field(spark, d):
    """Orders as nodes in the folded cube."""
    k = F.col("o_orderkey")
    nodes = read(spark, d, "orders").select((k % 2 + 1).alias("body_id"), (k % 24).cast("double").alias("z"), (F.col("o_custkey") % 24).cast("double").alias("y"), (k % 37 * 0.6).alias("x"), (k % 5).cast("double").alias("radius"))
    return rounded(fields.radius_against_field(nodes, fields.distance_field(_dense(spark, d), CUBE), CUBE), 6)


def closed_surfaces(spark, d):
    return fields.closed_surfaces(_dense(spark, d), CUBE, NM)


def surface_corners(spark, d):
    """How many faces of each body meet in each lattice point."""
    faces = fields.quads(_dense(spark, d), CUBE)
    at = faces.select("body_id", F.explode(F.array(*"abcd")).alias("place")).groupBy("body_id", "place").agg(F.count("*").alias("n"))
    return fields.corners(faces, CUBE).join(at, ["body_id", "place"]).drop("place")


def dense_places(spark, d):
    """Where each body has the most and the fewest voxels within 12 around."""
    rows = _folded(spark, d)
    return fields.extreme_places(rows, fields.box_counts(rows, 12))


def run_region(spark, d):
    """Nodes on runs of the voxels' rows, told by their ends."""
    runs = volume.runs(voxels(spark, d).select(F.lit(0).alias("body_id"), (F.col("z") % 64).alias("z"), (F.col("y") % 64).alias("y"), "x"))
    nodes = skeletons(spark, d)[0].select("body_id", "node_id", F.col("z_nm").alias("z"), F.col("y_nm").alias("y"), F.col("x_nm").alias("x"))
    return regions.in_runs(nodes, runs, (40.0, 8.0, 4.0)).select("body_id", "node_id", "in_roi")


def wide_components(spark, d):
    return wide.components(*skeletons(spark, d, True))


def wide_distances(spark, d):
    """As path_distances, each body over many tasks."""
    nodes, edges = skeletons(spark, d, True)
    return rounded(wide.path_distances(nodes.withColumn("is_source", F.col("node_id") == 1), edges))


def wide_bridges(spark, d):
    return rounded(wide.bridges(*skeletons(spark, d, True), 300.0), 6)


QUERIES = {f.__name__: f for f in (region_scan, two_volumes, distance_field, radius_against_field, closed_surfaces, surface_corners, dense_places, run_region, wide_components, wide_distances, wide_bridges)}

_FOLDED = f"{VOXELS}, folded AS (SELECT z % 192 AS z, y % 128 AS y, x % 50 AS x, min(body_id) AS body_id FROM voxels WHERE {{0}} GROUP BY ALL)"
_OPEN = """sides(axis, side, dz, dy, dx) AS (VALUES ('z', 0, -1, 0, 0), ('z', 1, 1, 0, 0), ('y', 0, 0, -1, 0), ('y', 1, 0, 1, 0), ('x', 0, 0, 0, -1), ('x', 1, 0, 0, 1)),
open AS (SELECT a.body_id, axis, side, a.z, a.y, a.x FROM dense a, sides s WHERE NOT EXISTS (SELECT 1 FROM dense b WHERE b.body_id = a.body_id AND b.z = a.z + dz AND b.y = a.y + dy AND b.x = a.x + dx)),
ring AS (SELECT o.*, i, z + CASE axis WHEN 'z' THEN side WHEN 'y' THEN j ELSE i END AS cz, y + CASE axis WHEN 'y' THEN side WHEN 'x' THEN j ELSE i END AS cy, x + CASE axis WHEN 'x' THEN side WHEN 'z' THEN j ELSE i END AS cx, j FROM open o, range(2) i(i), range(2) j(j))"""
_FIELD = """cube AS (SELECT z, y, x FROM range(24) z(z), range(24) y(y), range(24) x(x)),
field AS (SELECT a.body_id, a.z, a.y, a.x, min(sqrt((a.z-c.z)*(a.z-c.z)*{0} + (a.y-c.y)*(a.y-c.y)*{1} + (a.x-c.x)*(a.x-c.x)*{2})) AS distance
  FROM dense a LEFT JOIN (SELECT k.body_id, q.* FROM (SELECT DISTINCT body_id FROM dense) k, cube q WHERE (k.body_id, q.z, q.y, q.x) NOT IN (SELECT (body_id, z, y, x) FROM dense)) c ON c.body_id = a.body_id GROUP BY a.body_id, a.z, a.y, a.x)"""

SQL = {
    "region_scan": f"WITH {_FOLDED.format('body_id <> 0')} SELECT body_id, min(z)::BIGINT AS z0, min(y)::BIGINT AS y0, min(x)::BIGINT AS x0, max(z)::BIGINT + 1 AS z1, max(y)::BIGINT + 1 AS y1, max(x)::BIGINT + 1 AS x1, count(*) AS voxel_count FROM folded WHERE z >= 40 AND z < 130 AND y >= 10 AND y < 100 AND x < 37 GROUP BY body_id",
    "two_volumes": f"WITH {_FOLDED.format('true')}, sem AS (SELECT o_orderkey % 192 AS z, o_custkey % 128 AS y, CAST(floor(o_totalprice) AS BIGINT) % 50 AS x, max(month(o_orderdate)) AS label FROM orders GROUP BY ALL) SELECT body_id, CAST(coalesce(label, 0) AS INT) AS label, count(*) AS voxel_count FROM folded LEFT JOIN sem USING (z, y, x) WHERE body_id <> 0 GROUP BY ALL",
    "distance_field": f"WITH {_DENSE}, {_FIELD.format(64, 16, 4)} SELECT body_id, z, y, x, round(distance, 6) AS distance FROM field",
    "radius_against_field": f"""WITH {_DENSE}, {_FIELD.format(1, 1, 1)}, nodes AS (SELECT o_orderkey % 2 + 1 AS body_id, o_orderkey % 24 AS z, o_custkey % 24 AS y, least(round_even(o_orderkey % 37 * 0.6::DOUBLE, 0), 23)::INT AS x, (o_orderkey % 5)::DOUBLE AS radius FROM orders),
e AS (SELECT n.body_id, radius, radius - coalesce(distance, 0) AS error FROM nodes n LEFT JOIN field f USING (body_id, z, y, x)), d AS (SELECT body_id, max(distance) AS deepest FROM field GROUP BY body_id)
SELECT body_id, count(*) AS n_nodes, round(avg(error), 6) AS mean_error, round(count(*) FILTER (WHERE error > 2) / count(*)::DOUBLE, 6) AS share_over, max(radius) AS largest_radius, round(quantile_cont(error, 0.5), 6) AS error_p50, round(any_value(deepest), 6) AS deepest FROM e LEFT JOIN d USING (body_id) GROUP BY body_id""",
    "closed_surfaces": f"""WITH {_DENSE}, {_OPEN}, points AS (SELECT body_id, count(DISTINCT (cz, cy, cx)) AS n_vertices FROM ring GROUP BY body_id),
lines AS (SELECT DISTINCT a.body_id, a.cz, a.cy, a.cx, b.cz AS dz, b.cy AS dy, b.cx AS dx FROM ring a JOIN ring b ON a.body_id = b.body_id AND a.axis = b.axis AND a.side = b.side AND a.z = b.z AND a.y = b.y AND a.x = b.x AND abs(a.i - b.i) + abs(a.j - b.j) = 1 AND (a.cz, a.cy, a.cx) < (b.cz, b.cy, b.cx)),
told AS (SELECT body_id, count(*) AS n_faces, sum(CASE axis WHEN 'z' THEN 8.0 WHEN 'y' THEN 16.0 ELSE 32.0 END)::DOUBLE AS area_nm2 FROM open GROUP BY body_id)
SELECT body_id, n_faces, area_nm2, (SELECT count(*) * 64.0::DOUBLE FROM dense v WHERE v.body_id = t.body_id) AS enclosed_nm3, n_vertices, n_edges, n_vertices - n_edges + n_faces AS euler
FROM told t JOIN points USING (body_id) JOIN (SELECT body_id, count(*) AS n_edges FROM lines GROUP BY body_id) USING (body_id)""",
    "surface_corners": f"WITH {_DENSE}, {_OPEN} SELECT body_id, cz::INT AS z, cy::INT AS y, cx::INT AS x, count(*) AS n FROM ring GROUP BY ALL",
    "dense_places": f"""WITH {VOXELS}, rows AS (SELECT DISTINCT body_id, z % 192 AS z, y % 128 AS y, x % 50 AS x FROM voxels WHERE body_id <> 0),
g AS (SELECT z, y, x, (EXISTS (SELECT 1 FROM rows r WHERE r.z = a.z AND r.y = b.y AND r.x = c.x))::BIGINT AS n FROM range(192) a(z), range(128) b(y), range(50) c(x)),
gx AS (SELECT z, y, x, sum(n) OVER (PARTITION BY z, y ORDER BY x RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS n FROM g),
gy AS (SELECT z, y, x, sum(n) OVER (PARTITION BY z, x ORDER BY y RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS n FROM gx),
gz AS (SELECT z, y, x, sum(n) OVER (PARTITION BY y, x ORDER BY z RANGE BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS n FROM gy),
k AS (SELECT body_id, r.z, r.y, r.x, n::BIGINT AS n, row_number() OVER (PARTITION BY body_id ORDER BY n DESC, r.z, r.y, r.x) AS hi, row_number() OVER (PARTITION BY body_id ORDER BY n, r.z, r.y, r.x) AS lo FROM rows r JOIN gz USING (z, y, x))
SELECT a.body_id, a.n AS most, CAST(a.z AS INT) AS most_z, CAST(a.y AS INT) AS most_y, CAST(a.x AS INT) AS most_x, b.n AS least, CAST(b.z AS INT) AS least_z, CAST(b.y AS INT) AS least_y, CAST(b.x AS INT) AS least_x FROM k a JOIN k b ON a.body_id = b.body_id AND a.hi = 1 AND b.lo = 1""",
    "run_region": f"WITH {VOXELS}, {NODES}, m AS (SELECT DISTINCT z % 64 AS z, y % 64 AS y, x FROM voxels) SELECT body_id, node_id, m.z IS NOT NULL AS in_roi FROM nodes LEFT JOIN m ON m.z = floor(z_nm / 40) AND m.y = floor(y_nm / 8) AND m.x = floor(x_nm / 4)",
    "wide_components": f"{_COMP} SELECT body_id, node_id, component FROM tops",
    "wide_distances": f"{_COMP} SELECT body_id, node_id, CASE WHEN component = 1 THEN round(dist, 4) END AS distance_nm, CASE WHEN component = 1 THEN 1 END::BIGINT AS source FROM tops",
}
