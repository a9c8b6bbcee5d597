"""Queries of voxel sweeps, boxes and blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import frames
from ..operators import ledger, sweep, tables, volume
from ..sources.bind import VOXELS, read, voxels

NM = (8.0, 8.0, 8.0)
LABELS = {1: "neuropil", 3: "soma", 5: "nucleus"}
BLOCK = 512
ROI = (512, 100, 5, 4000, 1500, 40)

WITHHELD = "mod(z, 7) <> 3"


def _blocks(spark, d):
    return voxels(spark, d).select(*frames.block_of(BLOCK)).distinct()


def volume_sweep(spark, d):
    return sweep.volumes(voxels(spark, d), NM)


def volume_sweep_keep(spark, d):
    keep = read(spark, d, "supplier").where("s_acctbal > 2000").select(F.col("s_suppkey").alias("body_id"))
    return sweep.volumes(voxels(spark, d), NM, keep=keep)


def index_scan_bbox(spark, d):
    return sweep.boxes(voxels(spark, d), factor=4)


def joint_counts(spark, d):
    at = voxels(spark, d).groupBy("z", "y", "x")
    seg, sem = at.agg(F.min("body_id").alias("body_id")), at.agg(F.max("label").alias("label")).where("label >= 3")
    return sweep.joint_counts(sweep.labelled(seg, sem))


def _counts(spark, d, withheld=False):
    rows = voxels(spark, d)
    return sweep.joint_counts(rows.where("mod(z, 7) <> 3") if withheld else rows)


def compartment_pivot(spark, d):
    out = sweep.pivoted(sweep.volumes(voxels(spark, d), NM), _counts(spark, d), LABELS, 8.0)
    out = sweep.diameters(out, F.col("voxel_count") * 2.0)
    return out.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def verify_compartments(spark, d):
    return sweep.verify_summary(sweep.verify(sweep.volumes(voxels(spark, d), NM), _counts(spark, d, True)))


def verify_worst10(spark, d):
    return sweep.worst(sweep.verify(sweep.volumes(voxels(spark, d), NM), _counts(spark, d, True)))


def bodies_by_size(spark, d):
    return tables.by_size(sweep.volumes(voxels(spark, d), NM), 600, 20).select("body_id", "voxel_count")


def block_grid(spark, d):
    """The blocks of a volume as large as the voxels need."""
    shape = voxels(spark, d).agg(*[F.max(a) + 1 for a in frames.AXES]).first()
    return frames.grid(spark, tuple(shape), BLOCK)


def blocks_roi(spark, d):
    rows = _blocks(spark, d)
    for a in frames.AXES:
        rows = rows.withColumn(f"{a}0", F.col(f"b{a}") * BLOCK).withColumn(f"{a}1", F.col(f"b{a}") * BLOCK + BLOCK)
    return rows.where(frames.overlaps({n: F.col(n) for n in rows.columns}, ROI)).select("bz", "by", "bx")


def occupancy_blocks(spark, d):
    coarse = voxels(spark, d).where("body_id <> 0").select(F.expr("z div 64").alias("z"), F.expr("y div 64").alias("y"), F.expr("x div 64").alias("x"), "body_id")
    return volume.occupied_blocks(coarse, 64.0, 8.0, 128, (200, 40, 2), 1)


def roi_block_mask(spark, d):
    return volume.label_blocks(voxels(spark, d), [7], 256, (60, 8, 1), 1)


def roi_scale_clip(spark, d):
    boxes = voxels(spark, d).groupBy("body_id").agg(*[f(a).alias(f"{a}{e}") for e, f in ((0, F.min), (1, F.max)) for a in frames.AXES])
    boxes = boxes.withColumns({f"{a}1": F.col(f"{a}1") + 1 for a in frames.AXES})
    box = {n: F.col(n) for n in boxes.columns}
    small = frames.scale_box(box, F.lit(3))
    clipped = frames.clip_box(box, (1000, 100, 30))
    aligned = frames.align_box(box, (64, 64, 64), (1000, 2000, 50))
    return boxes.select("body_id", *[c.cast("long").alias(f"s_{n}") for n, c in small.items()], *[c.cast("long").alias(f"c_{n}") for n, c in clipped.items()], *[c.cast("long").alias(f"a_{n}") for n, c in aligned.items()])


def body_crops(spark, d):
    boxes = sweep.boxes(voxels(spark, d))
    out = volume.cropped(boxes, 8, 1, (1200, 200, 6))
    return out.select("body_id", *[F.col(c).cast("long").alias(c) for c in out.columns[1:]])


def cut_faces(spark, d):
    return volume.cut_faces(voxels(spark, d).where("body_id <> 0"), (0, 0, 10, 5000, 1000, 20), (5000, 2000, 51))


def run_lengths(spark, d):
    rows = voxels(spark, d).select("body_id", F.lit(0).alias("z"), F.expr("z div 64").alias("y"), "x")
    return volume.runs(rows)


def local_density(spark, d):
    rows = voxels(spark, d).where("body_id <> 0").select(F.expr("z div 16").alias("z"), F.expr("y div 16").alias("y"), F.expr("x div 16").alias("x"))
    out = volume.local_density(rows, 1)
    return out.withColumn("density", F.round("density", 6))


def export_roi(spark, d):
    fine = voxels(spark, d).groupBy("z", "y", "x").agg(F.max("body_id").alias("body_id")).where("body_id <> 0")
    return volume.export_scales({0: (fine, 8.0), 1: (volume.downsampled(fine, 2), 16.0)}, (100.0, 80.0, 40.0, 9000.0, 4000.0, 300.0))


def scale_cost(spark, d):
    n = voxels(spark, d).agg((F.max("z") + 1).alias("sz"), (F.max("y") + 1).alias("sy"), (F.max("x") + 1).alias("sx"))
    levels = n.select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("level"), "*")
    scales = levels.select("level", (8.0 * F.pow(F.lit(2.0), "level")).alias("nm"), *[F.ceil(F.col(c) / F.pow(F.lit(2.0), "level")).cast("long").alias(c) for c in ("sz", "sy", "sx")])
    return volume.scale_cost(scales, (100.0, 80.0, 40.0, 9000.0, 4000.0, 300.0)).withColumn("gb", F.round("gb", 9))


def populated_columns(spark, d):
    rows = sweep.volumes(voxels(spark, d), NM).withColumn("mesh_verts", F.lit(None).cast("double")).withColumn("n_tips", F.lit(0.0))
    return sweep.populated(rows, ["voxel_count", "volume_nm3", "mesh_verts", "n_tips"])


def _batches(spark, d):
    found = voxels(spark, d)
    rows = found.withColumn("block", F.concat_ws("_", F.expr("z div 512"), F.expr("y div 512"), F.lit(0))).where("body_id <> 0")
    rows = frames.dealt(rows, found.count(), "block")  # all that follows is by block, and a block has few voxels
    lows = [F.min(a).cast("long").alias(f"{a}0") for a in frames.AXES]
    highs = [(F.max(a) + 1).cast("long").alias(f"{a}1") for a in frames.AXES]
    return rows.groupBy("block", "body_id").agg(*lows, *highs, F.count("*").alias("voxel_count"))


def block_merge_upsert(spark, d):
    """A first batch, then one that brings half of it again."""
    blocks = _batches(spark, d)
    first = blocks.where("crc32(cast(block as binary)) % 2 = 0")
    none = first.limit(0)
    bodies = ledger.merge_blocks(none, first.unionByName(first), none.select("block"), 512.0)
    return ledger.merge_blocks(bodies, blocks, first.select("block"), 512.0)


def counts_block_merge(spark, d):
    blocks = _batches(spark, d).select("block", "body_id", "voxel_count")
    first = blocks.where("crc32(cast(block as binary)) % 2 = 0")
    old = first.groupBy("body_id").agg(F.sum("voxel_count").alias("voxel_count"))
    return ledger.merge_counts(old, blocks, first.select("block"), ["body_id"])


QUERIES = {f.__name__: f for f in (volume_sweep, volume_sweep_keep, index_scan_bbox, joint_counts, compartment_pivot, verify_compartments, verify_worst10, bodies_by_size, block_grid, blocks_roi, occupancy_blocks, roi_block_mask, roi_scale_clip, body_crops, cut_faces, run_lengths, local_density, export_roi, scale_cost, populated_columns, block_merge_upsert, counts_block_merge)}

_BOX = "SELECT body_id, min(z) AS z0, min(y) AS y0, min(x) AS x0, max(z) + 1 AS z1, max(y) + 1 AS y1, max(x) + 1 AS x1, count(*) AS voxel_count FROM voxels"
_TOTAL = "bodies AS (SELECT body_id, count(*) AS total FROM voxels WHERE body_id <> 0 GROUP BY body_id), parts AS (SELECT body_id, count(*) AS summed FROM voxels WHERE body_id <> 0 AND z % 7 <> 3 GROUP BY body_id), checked AS (SELECT body_id, total, coalesce(summed, 0) AS summed FROM bodies LEFT JOIN parts USING (body_id))"
_SIX = ("z0", "y0", "x0", "z1", "y1", "x1")
_MOVES = "(VALUES (0,0,0),(1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) m(dz,dy,dx)"

SQL = {
    "volume_sweep": f"WITH {VOXELS} SELECT body_id, count(*) AS voxel_count, count(*) * 512.0::DOUBLE AS volume_nm3 FROM voxels WHERE body_id <> 0 GROUP BY body_id",
    "volume_sweep_keep": f"WITH {VOXELS} SELECT body_id, count(*) AS voxel_count, count(*) * 512.0::DOUBLE AS volume_nm3 FROM voxels WHERE body_id <> 0 AND body_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) GROUP BY body_id",
    "index_scan_bbox": f"WITH {VOXELS} SELECT body_id, min(z)*4::BIGINT AS z0, min(y)*4::BIGINT AS y0, min(x)*4::BIGINT AS x0, (max(z)+1)*4::BIGINT AS z1, (max(y)+1)*4::BIGINT AS y1, (max(x)+1)*4::BIGINT AS x1, count(*) AS voxel_count FROM voxels WHERE body_id <> 0 GROUP BY body_id",
    "joint_counts": f"WITH {VOXELS}, seg AS (SELECT z,y,x,min(body_id) AS body_id FROM voxels GROUP BY z,y,x), sem AS (SELECT z,y,x,max(label) AS label FROM voxels GROUP BY z,y,x HAVING max(label) >= 3) SELECT body_id, coalesce(label, 0) AS label, count(*) AS voxel_count FROM seg LEFT JOIN sem USING (z,y,x) WHERE body_id <> 0 GROUP BY 1, 2",
    "compartment_pivot": f"""WITH {VOXELS}, b AS (SELECT body_id, count(*) AS voxel_count, count(*) FILTER (WHERE label = 1) AS a, count(*) FILTER (WHERE label = 3) AS s, count(*) FILTER (WHERE label = 5) AS n FROM voxels WHERE body_id <> 0 GROUP BY body_id),
        v AS (SELECT *, voxel_count * 512.0::DOUBLE / 1e9 AS v0, (voxel_count - n) * 512.0::DOUBLE / 1e9 AS v1, (voxel_count - n - s) * 512.0::DOUBLE / 1e9 AS v2, voxel_count * 2.0::DOUBLE AS l FROM b)
        SELECT body_id, voxel_count, round(a * 512.0::DOUBLE / 1e9, 6) AS neuropil_um3, round(s * 512.0::DOUBLE / 1e9, 6) AS soma_um3, round(n * 512.0::DOUBLE / 1e9, 6) AS nucleus_um3, round(v0, 6) AS volume_um3_all, round(v1, 6) AS volume_um3_minus_nucleus, round(v2, 6) AS volume_um3_minus_soma_nucleus,
        round(2 * sqrt(v0 * 1e9 / l / pi()), 6) AS diameter_nm_all, round(2 * sqrt(v1 * 1e9 / l / pi()), 6) AS diameter_nm_minus_nucleus, round(2 * sqrt(v2 * 1e9 / l / pi()), 6) AS diameter_nm_minus_soma_nucleus FROM v""",
    "verify_compartments": f"WITH {VOXELS}, {_TOTAL} SELECT count(*) AS n_bodies, count(*) FILTER (WHERE total <> summed) AS n_mismatched, CAST(coalesce(sum(total - summed), 0) AS BIGINT) AS voxels_missing, round(sum(total - summed)::DOUBLE / sum(total), 9) AS fraction_missing FROM checked",
    "verify_worst10": f"WITH {VOXELS}, {_TOTAL} SELECT body_id, total, summed FROM checked WHERE total <> summed ORDER BY total - summed DESC, body_id LIMIT 10",
    "bodies_by_size": f"WITH {VOXELS} SELECT body_id, count(*) AS voxel_count FROM voxels WHERE body_id <> 0 GROUP BY body_id HAVING count(*) >= 600 ORDER BY 2 DESC, 1 LIMIT 20",
    "block_grid": f"WITH {VOXELS}, s AS (SELECT max(z) + 1 AS nz, max(y) + 1 AS ny, max(x) + 1 AS nx FROM voxels), b AS (SELECT *, unnest(range((nx + 511) // 512)) AS bx FROM (SELECT *, unnest(range((ny + 511) // 512)) AS \"by\" FROM (SELECT *, unnest(range((nz + 511) // 512)) AS bz FROM s))) SELECT CAST(bz AS INT) AS bz, CAST(\"by\" AS INT) AS \"by\", CAST(bx AS INT) AS bx, CAST(bz*512 AS INT) AS z0, CAST(\"by\"*512 AS INT) AS y0, CAST(bx*512 AS INT) AS x0, CAST(least(bz*512+512,nz) AS INT) AS z1, CAST(least(\"by\"*512+512,ny) AS INT) AS y1, CAST(least(bx*512+512,nx) AS INT) AS x1 FROM b",
    "blocks_roi": f"WITH {VOXELS}, b AS (SELECT DISTINCT z//512 AS bz, y//512 AS \"by\", x//512 AS bx FROM voxels) SELECT CAST(bz AS INT) AS bz, CAST(\"by\" AS INT) AS \"by\", CAST(bx AS INT) AS bx FROM b WHERE bz*512 < 4000 AND bz*512+512 > 512 AND \"by\"*512 < 1500 AND \"by\"*512+512 > 100 AND bx*512 < 40 AND bx*512+512 > 5",
    "occupancy_blocks": f"WITH {VOXELS}, c AS (SELECT DISTINCT CAST(z//64 AS INT)*8 AS z, CAST(y//64 AS INT)*8 AS y, CAST(x//64 AS INT)*8 AS x FROM voxels WHERE body_id <> 0), b AS (SELECT DISTINCT z//128 AS bz, y//128 AS cy, x//128 AS bx FROM c WHERE z//128 < 200 AND y//128 < 40 AND x//128 < 2) SELECT DISTINCT CAST(bz+dz AS INT) AS bz, CAST(cy+dy AS INT) AS \"by\", CAST(bx+dx AS INT) AS bx FROM b, {_MOVES} WHERE bz+dz BETWEEN 0 AND 199 AND cy+dy BETWEEN 0 AND 39 AND bx+dx BETWEEN 0 AND 1",
    "roi_block_mask": f"WITH {VOXELS}, b AS (SELECT DISTINCT z//256 AS bz, y//256 AS cy, x//256 AS bx FROM voxels WHERE label = 7) SELECT DISTINCT CAST(bz+dz AS INT) AS bz, CAST(cy+dy AS INT) AS \"by\", CAST(bx+dx AS INT) AS bx FROM b, {_MOVES} WHERE bz+dz BETWEEN 0 AND 59 AND cy+dy BETWEEN 0 AND 7 AND bx+dx BETWEEN 0 AND 0",
    "roi_scale_clip": f"WITH {VOXELS}, b AS ({_BOX} GROUP BY body_id) SELECT body_id, "
    + ", ".join([f"CAST({a}0//3 AS BIGINT) AS s_{a}0, CAST(greatest(ceil({a}1/3.0), {a}0//3 + 1) AS BIGINT) AS s_{a}1" for a in "zyx"] + [f"CAST(least(greatest({a}{e},0),{n}) AS BIGINT) AS c_{a}{e}" for a, n in (("z", 1000), ("y", 100), ("x", 30)) for e in (0, 1)] + [f"CAST(({a}0//64)*64 AS BIGINT) AS a_{a}0, CAST(least(ceil({a}1/64.0)*64, {n}) AS BIGINT) AS a_{a}1" for a, n in (("z", 1000), ("y", 2000), ("x", 50))])
    + " FROM b",
    "body_crops": f"WITH {VOXELS}, b AS ({_BOX} WHERE body_id <> 0 GROUP BY body_id) SELECT body_id, " + ", ".join(f"CAST(greatest({a}0//8 - 1, 0) AS BIGINT) AS c{a}0, CAST(least(ceil({a}1/8.0) + 1, {n}) AS BIGINT) AS c{a}1" for a, n in (("z", 1200), ("y", 200), ("x", 6))) + " FROM b",
    "cut_faces": f"WITH {VOXELS} SELECT body_id, max(CAST(y = 999 OR x = 10 OR x = 19 AS INT)) = 1 AS cut FROM voxels WHERE body_id <> 0 AND z < 5000 AND y < 1000 AND x >= 10 AND x < 20 GROUP BY body_id",
    "run_lengths": f"WITH {VOXELS}, r AS (SELECT DISTINCT body_id, 0 AS z, CAST(z//64 AS INT) AS y, x FROM voxels), i AS (SELECT *, x - row_number() OVER (PARTITION BY body_id, z, y ORDER BY x) AS g FROM r) SELECT body_id, z, y, min(x) AS x0, max(x) AS x1 FROM i GROUP BY body_id, z, y, g",
    "local_density": f"WITH {VOXELS}, c AS (SELECT DISTINCT CAST(z//16 AS INT) AS z, CAST(y//16 AS INT) AS y, CAST(x//16 AS INT) AS x FROM voxels WHERE body_id <> 0), m AS (SELECT * FROM range(-1, 2) a(dz), range(-1, 2) b(dy), range(-1, 2) e(dx)), n AS (SELECT c.z + dz AS z, c.y + dy AS y, c.x + dx AS x, count(*) AS n FROM c, m GROUP BY 1, 2, 3) SELECT c.z, c.y, c.x, round(n / 27.0::DOUBLE, 6) AS density FROM c JOIN n USING (z, y, x)",
    "export_roi": f"""WITH {VOXELS}, f AS (SELECT z,y,x,max(body_id) AS body_id FROM voxels GROUP BY z,y,x HAVING max(body_id) <> 0), n AS (SELECT CAST(z//2 AS INT) AS z, CAST(y//2 AS INT) AS y, CAST(x//2 AS INT) AS x, body_id, count(*) AS k FROM f GROUP BY ALL),
        g AS (SELECT z,y,x,body_id FROM (SELECT *, row_number() OVER (PARTITION BY z,y,x ORDER BY k DESC, body_id) AS r FROM n) WHERE r = 1)
        SELECT 0 AS level, 12 AS origin_z, 10 AS origin_y, 5 AS origin_x, z-12 AS z, y-10 AS y, x-5 AS x, body_id FROM f WHERE z>=12 AND z<1125 AND y>=10 AND y<500 AND x>=5 AND x<38
        UNION ALL SELECT 1, 6, 5, 2, z-6, y-5, x-2, body_id FROM g WHERE z>=6 AND z<563 AND y>=5 AND y<250 AND x>=2 AND x<19""",
    "scale_cost": f"""WITH {VOXELS}, n AS (SELECT max(z)+1 AS sz, max(y)+1 AS sy, max(x)+1 AS sx FROM voxels), l AS (SELECT CAST(level AS INT) AS level, 8.0::DOUBLE * pow(2, level) AS nm, CAST(ceil(sz/pow(2,level)) AS BIGINT) AS sz, CAST(ceil(sy/pow(2,level)) AS BIGINT) AS sy, CAST(ceil(sx/pow(2,level)) AS BIGINT) AS sx FROM n, range(5) r(level)),
        v AS (SELECT level, CAST(greatest(least(ceil(9000/nm),sz)-floor(100/nm),0) AS BIGINT) * CAST(greatest(least(ceil(4000/nm),sy)-floor(80/nm),0) AS BIGINT) * CAST(greatest(least(ceil(300/nm),sx)-floor(40/nm),0) AS BIGINT) AS voxels FROM l) SELECT level, voxels, round(voxels*8/1e9, 9) AS gb FROM v""",
    "populated_columns": "SELECT * FROM (VALUES ('voxel_count', true), ('volume_nm3', true), ('mesh_verts', false), ('n_tips', false)) t(name, populated)",
    "block_merge_upsert": f"WITH {VOXELS}, b AS ({_BOX} WHERE body_id <> 0 GROUP BY body_id) SELECT body_id, " + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _SIX) + ", voxel_count, voxel_count * 512.0::DOUBLE AS volume_nm3 FROM b",
    "counts_block_merge": f"WITH {VOXELS} SELECT body_id, count(*) AS voxel_count FROM voxels WHERE body_id <> 0 GROUP BY body_id",
}
