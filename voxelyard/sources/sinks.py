"""Writers. Parquet keeps types; CSV is for people and lists of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table(df: DataFrame, path: str) -> None:
    if path.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def ordered_csv(bodies: DataFrame, path: str) -> None:
    """All columns in order of the body, as a folder of parts in that order."""
    bodies.orderBy("body_id").write.mode("overwrite").option("header", True).csv(path)


def allowlist(bodies: DataFrame, path: str, least: int = 0, limit: int | None = None) -> int:
    """Ids of the largest bodies under a header, largest first; how many."""
    from ..operators.tables import by_size

    by_size(bodies, least, limit).select("body_id").write.mode("overwrite").option("header", True).csv(path)
    return bodies.sparkSession.read.option("header", True).csv(path).count()


def failures(rows: DataFrame, path: str) -> bool:
    """JSON lines of failures; nothing is written where there are none."""
    if not rows.take(1):
        return False
    rows.write.mode("overwrite").json(path)
    return True


def fragments(df: DataFrame, path: str, buckets: int | None = None, split: int = 4) -> None:
    """Fragments dealt to folders by body, so that a body's fragments lie together: of=<buckets>/bucket=<k>.
    There are as many folders as shuffle partitions, and a folder is up to ``split`` files by block, so that a
    body with most of the rows isn't one task's work."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("of", F.lit(buckets)).withColumn("bucket", F.pmod("body_id", F.lit(buckets)).cast("int"))
    dealt.repartition(buckets, "bucket", F.pmod(F.xxhash64("block"), F.lit(split))).write.mode("overwrite").partitionBy("of", "bucket").parquet(path)


def swc_lines(tree: DataFrame) -> DataFrame:
    """SWC text rows (body_id, node_id, value) of rooted nodes (body_id, node_id, parent, z_nm ... radius_nm)."""
    cells = [F.col("node_id"), F.lit(0), F.col("x_nm"), F.col("y_nm"), F.col("z_nm"), F.col("radius_nm"), F.col("parent")]
    return tree.select("body_id", "node_id", F.concat_ws(" ", *[c.cast("string") for c in cells]).alias("value"))


def swc(tree: DataFrame, path: str) -> None:
    """SWC text in a folder per body, a node's parent before it."""
    rows = swc_lines(tree).join(tree.select("body_id", "node_id", "depth"), ["body_id", "node_id"])
    rows.repartition("body_id").sortWithinPartitions("body_id", "depth", "node_id").select("body_id", "value").write.mode("overwrite").partitionBy("body_id").text(path)


def stripes(runs: DataFrame) -> DataFrame:
    """Runs (body_id, z, y, x0, x1) as a row per stripe: the runs of a body at one z and y, in order, as
    [first, last] with both ends inside."""
    each = F.sort_array(F.collect_list(F.struct("x0", "x1")))
    return runs.groupBy("body_id", "z", "y").agg(F.transform(each, lambda r: F.array(r["x0"], r["x1"])).alias("runs"))
