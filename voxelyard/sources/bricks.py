"""Volumes as tables that are bucketed and sorted by block, so that two of the same grid join without a shuffle.

A voxel's bucket is a hash of its block's name.  A join of two such tables by block and place reads bucket by bucket; a
filter on blocks reads the buckets of these alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import AXES, block_key, block_of

BUCKETS = 64


def save(voxels: DataFrame, name: str, block: int, buckets: int = BUCKETS) -> DataFrame:
    """Voxels (z, y, x and other columns) as the table ``name`` of the catalogue, with the block of each."""
    if block < 1:
        raise ValueError("a block's side is 1 or more")
    own = voxels.withColumns(dict(zip(("bz", "by", "bx"), block_of(block)))).withColumn("block", block_key()).drop("bz", "by", "bx")
    own.repartition(buckets, "block").write.bucketBy(buckets, "block").sortBy("block", *AXES).mode("overwrite").format("parquet").option("voxelyard.block", block).saveAsTable(name)
    return voxels.sparkSession.table(name)


def joined(spark: SparkSession, left: str, right: str, how: str = "inner", blocks: Iterable[str] | None = None) -> DataFrame:
    """The voxels of two saved volumes of the same grid, side by side by place, of the asked blocks or all. Rows that share
    a block are in one bucket on both sides; that the join's keys are more than the block doesn't matter for
    that, so Spark is told that a part of the keys is enough."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    sides = [spark.table(t) for t in (left, right)]
    if blocks is not None:
        wanted = sorted(set(blocks))
        sides = [s.where(F.col("block").isin(wanted)) for s in sides]
    return sides[0].join(sides[1], ["block", *AXES], how)


def labelled(spark: SparkSession, seg: str, sem: str, blocks: Iterable[str] | None = None) -> DataFrame:
    """Segmentation voxels with the label of the semantic volume; 0 where it has none."""
    return joined(spark, seg, sem, "left", blocks).na.fill(0, ["label"])
