"""Reads by body: fragments in the folders that sinks.fragments writes, and single skeletons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skeleton import transformed


class OldLayout(ValueError):
    """The folder isn't dealt by body."""


def fragments(spark: SparkSession, path: str, bodies: list[int] | None = None) -> DataFrame:
    """All fragments, or those of the bodies, whose folders alone are read. A folder of flat files is
    refused."""
    rows = spark.read.parquet(path)
    if not {"of", "bucket"} <= {*rows.columns}:
        raise OldLayout(f"{path} has no folders by body")
    if bodies is not None:
        counts = [r[0] for r in rows.select("of").distinct().collect()]  # of folder names, one a write
        asked = F.lit(False)
        for n in counts:
            asked = asked | ((F.col("of") == n) & F.col("bucket").isin(sorted({b % n for b in bodies})))
        rows = rows.where(asked & F.col("body_id").isin(list(bodies)))
    return rows.drop("of", "bucket")


def bodies_of(spark: SparkSession, path: str) -> DataFrame:
    return fragments(spark, path).select("body_id").distinct()


def count_bodies(spark: SparkSession, path: str) -> int:
    return bodies_of(spark, path).count()


def bad_radii(nodes: DataFrame) -> DataFrame:
    """(body_id, n_bad): nodes whose radius is missing, not finite or negative."""
    r = F.col("radius_nm")
    return nodes.groupBy("body_id").agg(F.count_if(r.isNull() | F.isnan(r) | (F.abs(r) == float("inf")) | (r < 0)).alias("n_bad"))


def skeleton(nodes: DataFrame, edges: DataFrame, body: int, matrix: list[list[float]] | None = None, require_radii: bool = True) -> tuple[DataFrame, DataFrame] | None:
    """Nodes and edges of one body under its transform, or None where there is no such body. Unsound
    radii are refused, or null where the centre line is enough."""
    own = nodes.where(F.col("body_id") == body)
    found = bad_radii(own).first()
    if found is None:
        return None
    if found["n_bad"] and require_radii:
        raise ValueError(f"body {body} has {found['n_bad']} missing, negative or infinite radii")
    if found["n_bad"]:
        own = own.withColumn("radius_nm", F.lit(None).cast("double"))
    return (own if matrix is None else transformed(own, matrix, require_radii)), edges.where(F.col("body_id") == body)
