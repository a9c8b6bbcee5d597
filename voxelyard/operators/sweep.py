"""Volume, index and compartment sweeps: counts of voxels by body, box and label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import AXES

LABELS = 15  # labels above are refused
#: Variant of a volume: compartments that it leaves out.
VARIANTS = {"all": (), "minus_nucleus": ("nucleus",), "minus_soma_nucleus": ("soma", "nucleus")}


def foreground(voxels: DataFrame, background: int = 0) -> DataFrame:
    return voxels.where(F.col("body_id") != background)


def volumes(voxels: DataFrame, voxel_nm: tuple[float, float, float], background: int = 0, keep: DataFrame | None = None) -> DataFrame:
    """Voxels and volume of each body. keep restricts which bodies are told; an empty one keeps none."""
    found = foreground(voxels, background)
    if keep is not None:
        found = found.join(keep.select("body_id").distinct(), "body_id", "left_semi")
    size = voxel_nm[0] * voxel_nm[1] * voxel_nm[2]
    return found.groupBy("body_id").agg(F.count("*").alias("voxel_count")).withColumn("volume_nm3", F.col("voxel_count") * F.lit(float(size)))


def boxes(voxels: DataFrame, factor: int = 1, background: int = 0) -> DataFrame:
    """Half-open box and voxels of each body, at the scale that the factor leads to."""
    low = [(F.min(a) * factor).cast("long").alias(f"{a}0") for a in AXES]
    high = [((F.max(a) + 1) * factor).cast("long").alias(f"{a}1") for a in AXES]
    return foreground(voxels, background).groupBy("body_id").agg(*low, *high, F.count("*").alias("voxel_count"))


def labelled(seg: DataFrame, sem: DataFrame) -> DataFrame:
    """Segmentation voxels with the label of the semantic volume at the same place; 0 where none."""
    return seg.join(sem.select(*AXES, "label"), list(AXES), "left").na.fill(0, ["label"])


def joint_counts(voxels: DataFrame, background: int = 0) -> DataFrame:
    """Voxels by body and label; label 0 counts, labels above LABELS stop the job."""
    label = F.when(F.col("label") <= LABELS, F.col("label")).otherwise(F.raise_error(F.concat(F.lit("label too large: "), F.col("label").cast("string"))).cast("int"))
    return foreground(voxels, background).groupBy("body_id", label.alias("label")).agg(F.count("*").alias("voxel_count"))


def verify(bodies: DataFrame, compartments: DataFrame, tolerance: int = 0) -> DataFrame:
    """Per body its total, the sum over labels, and whether they differ by more than the tolerance."""
    sums = compartments.groupBy("body_id").agg(F.sum("voxel_count").alias("summed"))
    both = bodies.select("body_id", F.col("voxel_count").alias("total")).join(sums, "body_id", "left")
    both = both.withColumn("summed", F.coalesce("summed", F.lit(0)))
    return both.withColumn("mismatch", F.abs(F.col("total") - F.col("summed")) > tolerance)


def verify_summary(checked: DataFrame) -> DataFrame:
    missing = F.coalesce(F.sum(F.when(F.col("mismatch"), F.col("total") - F.col("summed"))), F.lit(0))
    return checked.agg(F.count("*").alias("n_bodies"), F.count_if("mismatch").alias("n_mismatched"), missing.alias("voxels_missing"), F.coalesce(F.round(F.try_divide(missing.cast("double"), F.sum("total")), 9), F.lit(0.0)).alias("fraction_missing"))


def worst(checked: DataFrame, n: int = 10) -> DataFrame:
    return checked.where("mismatch").orderBy((F.col("total") - F.col("summed")).desc(), "body_id").limit(n).select("body_id", "total", "summed")


def pivoted(bodies: DataFrame, compartments: DataFrame, names: dict[int, str], voxel_nm: float) -> DataFrame:
    """A column of µm³ for each named label, and each volume variant that has all of its compartments."""
    um3 = voxel_nm**3 / 1e9
    sums = compartments.groupBy("body_id").agg(*[F.sum(F.when(F.col("label") == k, F.col("voxel_count")).otherwise(0)).alias(n) for k, n in names.items()])
    wide = bodies.join(sums, "body_id", "left").na.fill(0, list(names.values()))
    out = wide.select("body_id", "voxel_count", *[(F.col(n) * um3).alias(f"{n}_um3") for n in names.values()])
    for v, gone in VARIANTS.items():
        if all(g in names.values() for g in gone):
            out = out.withColumn(f"volume_um3_{v}", F.col("voxel_count") * um3 - sum((F.col(f"{g}_um3") for g in gone), F.lit(0.0)))
    return out


def diameters(df: DataFrame, cable: Column) -> DataFrame:
    """Diameter of a tube of each variant's volume along the whole cable; null without cable."""
    for v in VARIANTS:
        if f"volume_um3_{v}" in df.columns:
            df = df.withColumn(f"diameter_nm_{v}", F.when(cable > 0, 2 * F.sqrt(F.greatest(F.col(f"volume_um3_{v}"), F.lit(0.0)) * 1e9 / cable / F.pi())))
    return df


def populated(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, populated): whether any row has a value other than null and zero."""
    row = df.agg(*[F.coalesce(F.max((F.col(c).isNotNull() & (F.col(c) != 0))), F.lit(False)).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("populated")) for c in columns])).alias("x")).select("x.*")
