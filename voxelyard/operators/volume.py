"""Operators on voxel tables and meshes: occupancy, runs, density, exports, rasterised tubes, areas."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.frames import AXES, Box, dealt, dilate, in_box
from . import fields


#: Reach up to which the rows around a voxel are looked up one by one.
NARROW = 3


def occupied_blocks(coarse: DataFrame, coarse_nm: float, fine_nm: float, block: int, shape: tuple[int, int, int], rounds: int = 0, keep: DataFrame | None = None) -> DataFrame:
    """Blocks of the fine grid that a foreground voxel of the coarse level touches, and their neighbours.
    Bounds round half to even."""
    rows = coarse.where(F.col("body_id") != 0)
    if keep is not None:
        rows = rows.join(keep.select("body_id").distinct(), "body_id", "left_semi")
    ratio = coarse_nm / fine_nm
    cells = rows
    for a, n in zip(AXES, shape):
        low = F.floor(F.bround(F.col(a) * ratio) / block)
        high = F.floor((F.greatest(F.bround((F.col(a) + 1) * ratio), F.bround(F.col(a) * ratio) + 1) - 1) / block)
        # a sequence whose end lies before its start runs backwards, so what begins beyond the shape goes first
        cells = cells.where(low < n).withColumn(f"b{a}", F.explode(F.sequence(low.cast("int"), F.least(high, F.lit(n - 1)).cast("int"))))
    return dilate(cells.select(*[f"b{a}" for a in AXES]).distinct(), shape, rounds)


def label_blocks(voxels: DataFrame, labels: list[int], factor: int, shape: tuple[int, int, int], rounds: int = 1) -> DataFrame:
    """Cells of factor³ voxels that hold any of the labels, and their neighbours."""
    if factor < 1:
        raise ValueError("a factor is 1 or more")
    cells = voxels.where(F.col("label").isin(labels)).select(*[F.floor(F.col(a) / factor).cast("int").alias(f"b{a}") for a in AXES]).distinct()
    return dilate(cells, shape, rounds)


def runs(voxels: DataFrame) -> DataFrame:
    """Maximal runs along x of each body and row: first and last x. Rows are sorted once, in tasks of a bounded size, and
    none are grouped: a run starts where the x before, which may be the same, isn't next to it, and ends before the next start."""
    row = Window.partitionBy("body_id", "z", "y")
    along = row.orderBy("x")
    rows = dealt(voxels.select("body_id", *AXES), voxels.count(), "body_id", "z", "y")
    starts = rows.withColumns({"before": F.lag("x").over(along), "last": F.max("x").over(row), "place": F.row_number().over(along)})
    starts = starts.where("place = 1 or x is not null and (before is null or x - 1 > before)")
    return starts.select("body_id", "z", "y", F.col("x").alias("x0"), F.when(F.col("x").isNotNull(), F.coalesce(F.lead("before").over(along), "last")).alias("x1"))


def local_density(voxels: DataFrame, reach: int) -> DataFrame:
    """Foreground voxels within reach along all axes, over the cube's size, at each foreground voxel; what
    lies outside the volume counts as empty. Counted by blocks with halos, so a voxel moves about once."""
    kinds = dict(voxels.dtypes)
    count = fields.narrow_counts if reach <= NARROW else fields.box_counts
    found = count(voxels.select(*AXES, F.lit(1).alias("body_id")), reach, max(64, reach))
    return found.select(*[F.col(a).cast(kinds[a]).alias(a) for a in AXES], (F.col("n") / float((2 * reach + 1) ** 3)).alias("density"))


def export_box(voxels: DataFrame, box: Box) -> DataFrame:
    """Voxels of a box with the box's corner as origin."""
    return voxels.where(in_box(box)).select(*[(F.col(a) - box[k]).cast("int").alias(a) for k, a in enumerate(AXES)], "body_id")


def export_scales(levels: dict[int, tuple[DataFrame, float]], box_nm: tuple[float, ...]) -> DataFrame:
    """Each level (voxels, voxel size) cropped to a physical box, with its own origin."""
    out = None
    for level, (voxels, nm) in sorted(levels.items()):
        box = tuple(int(v // nm) for v in box_nm[:3]) + tuple(-int(-v // nm) for v in box_nm[3:])
        own = export_box(voxels, box).select(F.lit(level).alias("level"), *[F.lit(box[k]).alias(f"origin_{a}") for k, a in enumerate(AXES)], *AXES, "body_id")
        out = own if out is None else out.unionByName(own)
    return out


def downsampled(voxels: DataFrame, factor: int) -> DataFrame:
    """A coarser level: each cell has the body with the most voxels, the smallest of equal ones."""
    cell = [F.floor(F.col(a) / factor).cast("int").alias(a) for a in AXES]
    counts = voxels.where(F.col("body_id") != 0).select(*cell, "body_id").groupBy(*AXES, "body_id").agg(F.count("*").alias("n"))
    return counts.groupBy(*AXES).agg(F.min_by("body_id", F.struct(-F.col("n"), F.col("body_id"))).alias("body_id"))


def scale_cost(scales: DataFrame, box_nm: tuple[float, ...]) -> DataFrame:
    """Voxels and raw GB (8 bytes each) of each scale (level, nm, sz, sy, sx) after cropping."""
    n = F.lit(1).cast("long")
    for k, a in enumerate(AXES):
        low, high = F.floor(F.lit(box_nm[k]) / F.col("nm")), F.least(F.ceil(F.lit(box_nm[k + 3]) / F.col("nm")), F.col(f"s{a}"))
        n = n * F.greatest(high - low, F.lit(0))
    return scales.select("level", n.alias("voxels")).withColumn("gb", F.col("voxels") * 8 / 1e9)


def cropped(bodies: DataFrame, factor: int, margin: int, shape: tuple[int, int, int] | None = None) -> DataFrame:
    """Box of each body at a coarser scale with a margin, from 0, and within the shape if given."""
    out = bodies.where(F.col("z0").isNotNull())
    for k, a in enumerate(AXES):
        high: Column = F.ceil(F.col(f"{a}1") / factor) + margin
        out = out.withColumn(f"c{a}0", F.greatest(F.floor(F.col(f"{a}0") / factor) - margin, F.lit(0))).withColumn(f"c{a}1", F.least(high, F.lit(shape[k])) if shape else high)
    return out.select("body_id", *[f"c{a}{e}" for e in (0, 1) for a in AXES])


def cut_faces(voxels: DataFrame, box: Box, shape: tuple[int, int, int]) -> DataFrame:
    """Whether each body touches a face of the box that isn't the volume's own."""
    face = F.lit(False)
    for k, a in enumerate(AXES):
        face = face | ((F.col(a) == box[k]) & F.lit(box[k] > 0)) | ((F.col(a) == box[k + 3] - 1) & F.lit(box[k + 3] < shape[k]))
    return voxels.where(in_box(box)).groupBy("body_id").agg(F.max(face).alias("cut"))


def rasterised(samples: DataFrame, nm: float, shape: tuple[int, int, int]) -> DataFrame:
    """Distinct voxels (body_id, z, y, x) of balls around samples (z_nm ... radius_nm): centre and radius
    round half to even, and balls are cut at the shape."""
    r = F.greatest(F.bround(F.col("radius_nm") / nm), F.lit(0.0)).cast("int")
    balls = samples.select("body_id", *[F.bround(F.col(f"{a}_nm") / nm).cast("int").alias(f"c{a}") for a in AXES], r.alias("r")).distinct()
    for a in AXES:
        balls = balls.withColumn(f"d{a}", F.explode(F.sequence(-F.col("r"), F.col("r"))))
    hit = balls.where(sum((F.col(f"d{a}") * F.col(f"d{a}") for a in AXES), F.lit(0)) <= F.col("r") * F.col("r"))
    cells = hit.select("body_id", *[(F.col(f"c{a}") + F.col(f"d{a}")).alias(a) for a in AXES])
    for a, n in zip(AXES, shape):
        cells = cells.where((F.col(a) >= 0) & (F.col(a) < n))
    return cells.distinct()


def _tiles(voxels: DataFrame, name: str) -> DataFrame:
    """Voxels of each body by tiles of 4 x 4 x 4, a bit each."""
    bit = ((F.pmod("z", F.lit(4)) * 4 + F.pmod("y", F.lit(4))) * 4 + F.pmod("x", F.lit(4))).cast("int").alias("bit")
    cells = voxels.select("body_id", *[F.floor(F.col(a) / 4).alias(f"t{a}") for a in AXES], bit)
    return cells.groupBy("body_id", *[f"t{a}" for a in AXES]).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias(name))


def overlap(tube: DataFrame, mask: DataFrame) -> DataFrame:
    """Coverage (of the mask by the tube) and spill (of the tube outside the mask) of each body. Tiles meet, not voxels."""
    both = _tiles(tube, "t").join(_tiles(mask, "m"), ["body_id", *[f"t{a}" for a in AXES]], "full")
    t, m = F.coalesce("t", F.lit(0).cast("long")), F.coalesce("m", F.lit(0).cast("long"))
    n = both.groupBy("body_id").agg(*[F.sum(F.bit_count(c).cast("long")).alias(name) for name, c in (("n_tube", t), ("n_mask", m), ("n_both", t.bitwiseAND(m)))])
    return n.withColumn("coverage", F.col("n_both") / F.greatest(F.col("n_mask"), F.lit(1))).withColumn("spill", (F.col("n_tube") - F.col("n_both")) / F.greatest(F.col("n_tube"), F.lit(1)))


def neighbour_costs(voxels: DataFrame) -> DataFrame:
    """Steps between neighbours, of 26, of a body's voxels (body_id, z, y, x, cost): each pair once, from the
    first in order of z, y, x, with the cost length * (cost of one + cost of the other)."""
    ahead = [m for m in itertools.product((-1, 0, 1), repeat=3) if m > (0, 0, 0)]
    moves = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, m)], F.lit(float(sum(map(abs, m))) ** 0.5).alias("step")) for m in ahead])).alias("m")
    to = voxels.select("body_id", *AXES, F.col("cost").alias("own"), moves).select("body_id", *AXES, "own", *[(F.col(a) + F.col(f"m.d{a}")).alias(f"to_{a}") for a in AXES], F.col("m.step").alias("step"))
    other = voxels.select("body_id", *[F.col(a).alias(f"to_{a}") for a in AXES], F.col("cost").alias("theirs"))
    keys = ["body_id", *[f"to_{a}" for a in AXES]]
    return to.join(other, keys).select("body_id", *AXES, *keys[1:], (F.col("step") * (F.col("own") + F.col("theirs"))).alias("cost"))


def surface(voxels: DataFrame, nm: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """Open faces of each body's voxels and their area: faces beyond which the body isn't. Each pair of
    neighbours along an axis is found once, by the next voxel of the row, and hides two faces."""
    cells = voxels.where("body_id <> 0").select("body_id", *AXES).distinct()
    sizes = dict(zip(AXES, nm))
    n = cells.groupBy("body_id").agg(F.count("*").alias("n"))
    for a in AXES:
        others = [c for c in AXES if c != a]
        ahead = F.lead(a).over(Window.partitionBy("body_id", *others).orderBy(a))
        hidden = cells.withColumn("next", ahead).groupBy("body_id").agg(F.count_if(F.col("next") == F.col(a) + 1).alias("pairs"))
        n = n.join(hidden, "body_id").withColumn(f"faces_{a}", 2 * (F.col("n") - F.col("pairs"))).drop("pairs")
    area = sum((F.col(f"faces_{a}") * float(np.prod([sizes[c] for c in AXES if c != a])) for a in AXES), F.lit(0.0))
    return n.select("body_id", *[f"faces_{a}" for a in AXES], area.alias("area_nm2"))


def without_dust(voxels: DataFrame, key: list[str], least: int) -> DataFrame:
    """Voxels of groups, such as a body's components, of at least so many."""
    large = voxels.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(*key)
    return voxels.join(large, key, "left_semi")


# ---- meshes ---------------------------------------------------------------------------------------
def mesh_area(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Area of each body's faces (a, b, c) over vertices (body_id, vertex_id, z, y, x)."""
    out = faces
    for side in "abc":
        out = out.join(vertices.select("body_id", F.col("vertex_id").alias(side), *[F.col(x).alias(f"{side}_{x}") for x in AXES]), ["body_id", side])
    u, v = ({x: F.col(f"{s}_{x}") - F.col(f"a_{x}") for x in AXES} for s in "bc")
    cross = [u[p] * v[q] - u[q] * v[p] for p, q in (("y", "x"), ("x", "z"), ("z", "y"))]
    return out.groupBy("body_id").agg((F.sum(F.sqrt(sum((c * c for c in cross), F.lit(0.0)))) / 2).alias("area_nm2"))


def mesh_edges(faces: DataFrame) -> DataFrame:
    """Distinct undirected edges of faces, in the shape of skeleton edges, for components."""
    sides = F.explode(F.array(*[F.struct(F.least(p, q).alias("src"), F.greatest(p, q).alias("dst")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))])).alias("e")
    return faces.select("body_id", sides).select("body_id", "e.*").where("src <> dst").distinct()


def rebased(fragments: DataFrame) -> DataFrame:
    """Of a body's coarsest level, each fragment's first vertex: the running sum of those before.
    fragments has (body_id, lod, fragment, n_vertices)."""
    top = F.max("lod").over(Window.partitionBy("body_id"))
    before = Window.partitionBy("body_id", "lod").orderBy("fragment").rowsBetween(Window.unboundedPreceding, -1)
    return fragments.withColumn("top", top).where(F.col("lod") == F.col("top")).drop("top").withColumn("base", F.coalesce(F.sum("n_vertices").over(before), F.lit(0)))
