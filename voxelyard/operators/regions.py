"""Regions, two ways: as joins that mark points of any number, and as predicates (points to booleans) for the
graph operators, which ask at places that they make up along edges."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.frames import AXES
from . import calibre

Region = Callable[[np.ndarray], np.ndarray]


def voxel_at(nm: tuple[float, float, float], origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> list[Column]:
    """The voxel that a place (z, y, x in nm) lies in."""
    return [F.floor((F.col(a) - F.lit(float(o))) / F.lit(float(n))).cast("long").alias(f"v{a}") for a, n, o in zip(AXES, nm, origin)]


def label_ids(names: DataFrame, wanted: Iterable[int | str]) -> list[int]:
    """Ids of labels given by id or by a name of (name, label); unknown names are refused with those there
    are."""
    wanted = list(wanted)
    asked = [w for w in wanted if isinstance(w, str)]
    by_name = {r["name"]: r["label"] for r in names.where(F.col("name").isin(asked)).collect()} if asked else {}
    if unknown := [w for w in asked if w not in by_name]:
        known = sorted(r[0] for r in names.select("name").distinct().limit(100).collect())
        raise KeyError(f"no label named {unknown}; there are {known}")
    return [by_name[w] if isinstance(w, str) else int(w) for w in wanted]


def in_labels(points: DataFrame, volume: DataFrame, labels: list[int], nm: tuple[float, float, float], origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Points with in_roi: whether the voxel (z, y, x, label) they lie in has one of the labels."""
    cells = volume.where(F.col("label").isin(labels)).select(*[F.col(a).cast("long").alias(f"v{a}") for a in AXES]).distinct().withColumn("hit", F.lit(True))
    keys = [f"v{a}" for a in AXES]
    return points.select("*", *voxel_at(nm, origin)).join(cells, keys, "left").withColumn("in_roi", F.coalesce("hit", F.lit(False))).drop(*keys, "hit")


def near_points(points: DataFrame, centres: DataFrame, radius: float, key: list[str], own: list[str]) -> DataFrame:
    """Points with in_roi: whether a centre (z, y, x) of the same key is within the radius. key tells points
    apart, own are the columns that point and centre share, such as the body."""
    if radius <= 0:
        raise ValueError(f"a radius is over 0, not {radius}")
    a = points.select(*key, *[c for c in own if c not in key], *[F.col(c).alias(f"a_{c}") for c in AXES])
    b = centres.select(*own, *[F.col(c).alias(f"b_{c}") for c in AXES])
    hit = calibre.within(a, b, radius, own).select(*key).distinct().withColumn("hit", F.lit(True))
    return points.join(hit, key, "left").withColumn("in_roi", F.coalesce("hit", F.lit(False))).drop("hit")


def in_runs(points: DataFrame, runs: DataFrame, nm: tuple[float, float, float], origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """Points with in_roi: whether the voxel they lie in is on a run (z, y, x0, x1, both ends included) of a row.

    Points and runs of a row are put in one order, and a point is within a run if the furthest end of those that start
    no later isn't before it. So runs may overlap, and a run of any length is one row."""
    at = [c.alias(n) for c, n in zip(voxel_at(nm, origin), ("rz", "ry", "rx"))]
    names = points.columns
    rows = points.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("point"), *at, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("end"))
    spans = runs.where("x1 >= x0").select(F.lit(None).cast(rows.schema["point"].dataType).alias("point"), *[F.col(a).cast("long").alias(n) for a, n in (("z", "rz"), ("y", "ry"), ("x0", "rx"))], F.lit(0).alias("kind"), F.col("x1").cast("long").alias("end"))
    before = Window.partitionBy("rz", "ry").orderBy("rx", "kind").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.union(spans).withColumn("end", F.max("end").over(before)).where("kind = 1")
    return met.select("point.*", F.coalesce(F.col("end") >= F.col("rx"), F.lit(False)).alias("in_roi"))


# ---- predicates -------------------------------------------------------------------------------------
def mask(cells: np.ndarray, nm: tuple[float, float, float], origin: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> Region:
    """Whether a place lies in one of the voxels, which are those of one region."""
    cells = np.asarray(cells, np.int64).reshape(-1, 3)
    low = cells.min(axis=0) if len(cells) else np.zeros(3, np.int64)
    size = cells.max(axis=0) - low + 1 if len(cells) else np.zeros(3, np.int64)
    key = lambda c: (c[:, 0] * size[1] + c[:, 1]) * size[2] + c[:, 2]
    held = np.unique(key(cells - low))

    def inside(p: np.ndarray) -> np.ndarray:
        at = np.floor((np.asarray(p, float).reshape(-1, 3) - origin) / nm).astype(np.int64) - low
        fits = ((at >= 0) & (at < size)).all(axis=1)
        own = key(at)
        place = np.minimum(np.searchsorted(held, own), len(held) - 1)
        return fits & (held[place] == own) if len(held) else fits

    return inside


def balls(centres: np.ndarray, radius: float) -> Region:
    """Whether a place is within the radius of a centre; only centres of near cells are looked at."""
    if radius <= 0:
        raise ValueError(f"a radius is over 0, not {radius}")
    centres = np.asarray(centres, float).reshape(-1, 3)
    cells: dict[tuple, list[int]] = {}
    for i, c in enumerate(np.floor(centres / radius).astype(np.int64).tolist()):
        cells.setdefault(tuple(c), []).append(i)

    def inside(p: np.ndarray) -> np.ndarray:
        p = np.asarray(p, float).reshape(-1, 3)
        out = np.zeros(len(p), bool)
        for k, (z, y, x) in enumerate(np.floor(p / radius).astype(np.int64).tolist()):
            near = [i for a in (z - 1, z, z + 1) for b in (y - 1, y, y + 1) for c in (x - 1, x, x + 1) for i in cells.get((a, b, c), ())]
            out[k] = bool(near) and bool((((centres[near] - p[k]) ** 2).sum(axis=1) <= radius * radius).any())
        return out

    return inside


def any_of(regions: Iterable[Region]) -> Region:
    regions = list(regions)
    return lambda p: np.logical_or.reduce([np.asarray(r(p), bool) for r in regions]) if regions else np.zeros(len(p), bool)
