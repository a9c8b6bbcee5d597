"""Coordinates, boxes and blocks as column expressions. Axes are z, y, x; boxes are half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
Box = tuple[int, int, int, int, int, int]


def parse_box(text: str | None) -> Box | None:
    """'z0,y0,x0,z1,y1,x1' to integers; None passes, anything empty or ill-formed is refused."""
    if text is None:
        return None
    cells = [c.strip() for c in text.split(",")]
    if len(cells) != 6:
        raise ValueError(f"a box has six numbers, not {len(cells)}: {text!r}")
    box = tuple(int(c) for c in cells)
    if any(box[k + 3] <= box[k] for k in range(3)):
        raise ValueError(f"a box stops after it starts on each axis: {text!r}")
    return box


def scale_box(box: dict[str, Column], factor: Column) -> dict[str, Column]:
    """To a coarser scale: starts round down, stops round up, at least one wide."""
    out = {}
    for a in AXES:
        low = F.floor(box[f"{a}0"] / factor)
        out[f"{a}0"] = low
        out[f"{a}1"] = F.greatest(F.ceil(box[f"{a}1"] / factor), low + 1)
    return out


def clip_box(box: dict[str, Column], shape: tuple[int, int, int]) -> dict[str, Column]:
    return {f"{a}{e}": F.least(F.greatest(box[f"{a}{e}"], F.lit(0)), F.lit(n)) for a, n in zip(AXES, shape) for e in (0, 1)}


def align_box(box: dict[str, Column], block: tuple[int, int, int], shape: tuple[int, int, int]) -> dict[str, Column]:
    """Out to whole blocks, then into the shape."""
    out = {}
    for a, b, n in zip(AXES, block, shape):
        out[f"{a}0"] = F.floor(box[f"{a}0"] / b) * b
        out[f"{a}1"] = F.least(F.ceil(box[f"{a}1"] / b) * b, F.lit(n))
    return out


def overlaps(low: dict[str, Column], box: Box) -> Column:
    """Whether boxes (z0 ... x1 columns) overlap a fixed one on all axes."""
    out = F.lit(True)
    for k, a in enumerate(AXES):
        out = out & (low[f"{a}0"] < box[k + 3]) & (low[f"{a}1"] > box[k])
    return out


def in_box(box: Box, names: tuple[str, str, str] = AXES) -> Column:
    out = F.lit(True)
    for k, n in enumerate(names):
        out = out & (F.col(n) >= box[k]) & (F.col(n) < box[k + 3])
    return out


def block_of(size: int) -> list[Column]:
    return [F.floor(F.col(a) / size).cast("int").alias(f"b{a}") for a in AXES]


def block_key(prefix: str = "b") -> Column:
    return F.concat_ws("_", *[F.col(f"{prefix}{a}").cast("string") for a in AXES])


def grid(spark, shape: tuple[int, int, int], block: int) -> DataFrame:
    """All blocks of a volume: bz, by, bx and box; the last of an axis is cut at the shape."""
    n = [-(-s // block) for s in shape]
    at = spark.range(n[0] * n[1] * n[2])
    i = {"z": F.expr(f"id div {n[1] * n[2]}"), "y": F.expr(f"(id div {n[2]}) % {n[1]}"), "x": F.expr(f"id % {n[2]}")}
    return at.select(*[i[a].cast("int").alias(f"b{a}") for a in AXES], *[(i[a] * block).cast("int").alias(f"{a}0") for a in AXES], *[F.least(i[a] * block + block, F.lit(s)).cast("int").alias(f"{a}1") for a, s in zip(AXES, shape)])


def distance2(a: str, b: str, suffix: str = "") -> Column:
    """Squared distance between two sets of z, y, x columns with these prefixes."""
    return sum(((F.col(f"{a}{c}{suffix}") - F.col(f"{b}{c}{suffix}")) * (F.col(f"{a}{c}{suffix}") - F.col(f"{b}{c}{suffix}")) for c in AXES), F.lit(0.0))


def dilate(blocks: DataFrame, shape: tuple[int, int, int], rounds: int = 1) -> DataFrame:
    """Adds the six neighbours of each block (bz, by, bx), so many times; nothing wraps round."""
    for _ in range(rounds):
        moves = F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, m)]) for m in ((0, 0, 0), (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1))])
        moved = blocks.select(*[f"b{a}" for a in AXES], F.explode(moves).alias("m")).select(*[(F.col(f"b{a}") + F.col(f"m.d{a}")).alias(f"b{a}") for a in AXES])
        for a, n in zip(AXES, shape):
            moved = moved.where((F.col(f"b{a}") >= 0) & (F.col(f"b{a}") < n))
        blocks = moved.distinct()
    return blocks


def physical_box(box: dict[str, Column], nm: tuple[float, float, float]) -> dict[str, Column]:
    """A voxel box in nm."""
    return {f"{a}{e}_nm": box[f"{a}{e}"] * F.lit(float(n)) for e in (0, 1) for a, n in zip(AXES, nm)}


def to_physical(origin: dict[str, Column], nm: tuple[float, float, float], names: tuple[str, str, str] = ("z_nm", "y_nm", "x_nm")) -> dict[str, Column]:
    """Places within a crop, given in nm from its corner, in the volume: the corner (voxels) is added."""
    return {n: F.col(n) + origin[a] * F.lit(float(s)) for a, n, s in zip(AXES, names, nm)}


def chunk_xyz(block: tuple[int, int, int], nm: tuple[float, float, float]) -> tuple[float, float, float]:
    """A block's size in nm as x, y, z."""
    z, y, x = (b * n for b, n in zip(block, nm))
    return x, y, z


def flat(shape: tuple[int, int, int]) -> Column:
    """The place of z, y, x in a flat array in which z runs fastest."""
    return F.col("z").cast("long") + F.col("y") * F.lit(shape[0]).cast("long") + F.col("x") * F.lit(shape[0] * shape[1]).cast("long")


def unflat(at: Column, shape: tuple[int, int, int]) -> list[Column]:
    z, y = F.lit(shape[0]).cast("long"), F.lit(shape[1]).cast("long")
    whole = lambda c, n: F.floor(c / n).cast("long")
    return [F.pmod(at, z).alias("z"), F.pmod(whole(at, z), y).alias("y"), whole(at, z * y).alias("x")]


#: Rows of a task that sorts or groups all that it reads.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt by keys over so many tasks that each has about TASK_ROWS of its rows, however many there are; later groups by
    more keys, windows and joins by these ones need no other shuffle, and no groups are made before it."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    return df.repartition(tasks, *keys)
