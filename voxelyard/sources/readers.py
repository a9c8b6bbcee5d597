"""Readers of files and tables, each to a DataFrame with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import id_of
from ..operators.cohort import checked
from ..operators.skeleton import swc_edges

PROPERTIES = "inline struct<ids:array<string>,properties:array<struct<id:string,type:string,values:array<string>,tags:array<string>,tag_values:array<array<int>>>>>"


def allowlist(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids of the first cell of each line; other lines, such as headers, are skipped, and a file
    without any id is refused."""
    ids = spark.read.text(path).select(id_of(F.col("value")).alias("body_id")).where("body_id is not null").distinct()
    if not ids.take(1):
        raise ValueError(f"no body id in {path}")
    return ids


def cohort(spark: SparkSession, path: str) -> DataFrame:
    """Ids, and attributes where there are any, of a Parquet file, a CSV with a body_id column, or a list."""
    if path.endswith((".parquet", ".pq")):
        return checked(spark.read.parquet(path))
    if path.endswith(".csv"):
        head = spark.read.option("header", True).option("inferSchema", True).csv(path)
        if "body_id" in head.columns and len(head.columns) > 1:
            return checked(head.withColumn("body_id", F.col("body_id").cast("long")))
    return checked(allowlist(spark, path))


def records(lines: DataFrame) -> DataFrame:
    """Records (group, key, status) of JSON text rows (value); torn lines, and lines without a status, are
    skipped, and an old record's level is its group."""
    r = F.from_json("value", "`group` string, level string, key string, status string").alias("r")
    rows = lines.select(r).where("r.status is not null")
    return rows.select(F.coalesce("r.group", "r.level").alias("group"), F.col("r.key").alias("key"), F.col("r.status").alias("status"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return records(spark.read.text(path))


def segment_properties(spark: SparkSession, path: str) -> DataFrame:
    """(body_id, property, type, value, tags) of a properties file: a row per body and property."""
    inline = spark.read.schema(PROPERTIES).option("multiLine", True).json(path).select("inline.*")
    each = inline.select("ids", F.explode("properties").alias("p"))
    rows = each.select("p", F.posexplode("ids").alias("pos", "id"))
    tags = F.transform(F.get("p.tag_values", F.col("pos")), lambda i: F.get(F.col("p.tags"), i))
    return rows.select(F.col("id").cast("long").alias("body_id"), F.col("p.id").alias("property"), F.col("p.type").alias("type"), F.get("p.values", F.col("pos")).alias("value"), tags.alias("tags"))


def swc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return swc_edges(spark.read.text(path))


def scales(spark: SparkSession, path: str) -> DataFrame:
    """(level, nm, sz, sy, sx) of a pyramid's metadata file, finest first."""
    return spark.read.schema("level int, nm double, sz long, sy long, sx long").json(path).orderBy("level")


def level(scales: DataFrame, number: int) -> DataFrame:
    """One level; a number that the pyramid doesn't have is refused."""
    one = scales.where(F.col("level") == number)
    if not one.take(1):
        raise ValueError(f"no level {number}")
    return one


def levels(scales: DataFrame, nm: float, shape: tuple[int, int, int]) -> DataFrame:
    """The pyramid's levels, or where it tells none, one of this voxel size and shape."""
    if scales.take(1):
        return scales
    return scales.sparkSession.createDataFrame([(0, float(nm), *map(int, shape))], "level int, nm double, sz long, sy long, sx long")


# ---- synthetic bodies -------------------------------------------------------------------------------
def solid(spark: SparkSession, shape: tuple[int, int, int], inside: Column, body_id: int = 1) -> DataFrame:
    """Voxels of a volume at which the condition on z, y, x holds."""
    z, y, x = shape
    cells = spark.range(z * y * x).select(F.expr(f"cast(id div {y * x} as int)").alias("z"), F.expr(f"cast((id div {x}) % {y} as int)").alias("y"), F.expr(f"cast(id % {x} as int)").alias("x"))
    return cells.where(inside).withColumn("body_id", F.lit(body_id).cast("long"))


def _off(axis: str, centre: float) -> Column:
    return (F.col(axis) - F.lit(centre)) * (F.col(axis) - F.lit(centre))


def _along(shape: tuple[int, int, int], radius: float) -> Column:
    return _off("y", shape[1] // 2) + _off("x", shape[2] // 2) <= radius * radius


def _ball(shape: tuple[int, int, int], radius: float) -> Column:
    return _off("z", shape[0] // 2) + _off("y", shape[1] // 2) + _off("x", shape[2] // 2) <= radius * radius


def rod(spark: SparkSession, shape: tuple[int, int, int], radius: float, body_id: int = 1) -> DataFrame:
    """A cylinder along z in the middle of a volume."""
    return solid(spark, shape, _along(shape, radius), body_id)


def rod_with_bulb(spark: SparkSession, shape: tuple[int, int, int], radius: float, bulb: float, body_id: int = 1) -> DataFrame:
    """A rod with a ball around its middle."""
    return solid(spark, shape, _along(shape, radius) | _ball(shape, bulb), body_id)


def rod_with_cavity(spark: SparkSession, shape: tuple[int, int, int], radius: float, cavity: float, body_id: int = 1) -> DataFrame:
    """A rod whose middle is hollow."""
    return solid(spark, shape, _along(shape, radius) & ~_ball(shape, cavity), body_id)


def fork(spark: SparkSession, shape: tuple[int, int, int], radius: float, slope: float = 1.0, body_id: int = 1) -> DataFrame:
    """A Y: a rod that splits into two arms, apart along y by the slope, from its middle on."""
    rise = F.greatest(F.col("z") - F.lit(shape[0] // 2), F.lit(0)) * slope
    arm = lambda sign: (F.col("y") - shape[1] // 2 - sign * rise) * (F.col("y") - shape[1] // 2 - sign * rise) + _off("x", shape[2] // 2) <= radius * radius
    return solid(spark, shape, arm(1) | arm(-1), body_id)
