"""Domain tables derived from the star-schema test tables, in Spark and, for oracles, in SQL.

* voxels: a line item is a voxel of body ``l_suppkey`` (0 is background) with the label ``l_linenumber``;
* skeletons: a customer's orders, by date, are the nodes of a binary heap tree, so node n hangs on n / 2;
* points: the first three dimensions of an embedding, in the body of its label;
* ledger: an event is a record of the key ``user_id`` whose type is a status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATUS = {"purchase": "written", "view": "empty", "signup": "dust", "click": "skipped", "error": "failed"}

VOXELS = "voxels AS (SELECT CAST(l_orderkey AS INT) AS z, CAST(l_partkey AS INT) AS y, CAST(l_quantity AS INT) AS x, l_suppkey AS body_id, l_linenumber AS label FROM lineitem)"
NODES = """nodes AS (SELECT o_custkey AS body_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS node_id,
  CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS z_nm, o_totalprice / 1000 AS y_nm,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DOUBLE) AS x_nm, CAST(1 + o_orderkey % 17 AS DOUBLE) AS radius_nm, o_orderkey FROM orders)"""
EDGES = "edges AS (SELECT body_id, node_id AS edge_id, node_id // 2 AS src, node_id AS dst FROM nodes WHERE node_id > 1)"
BROKEN = "edges AS (SELECT body_id, node_id AS edge_id, node_id // 2 AS src, node_id AS dst FROM nodes WHERE node_id > 1 AND o_orderkey % 5 <> 0)"
#: Edges with their length and both ends.
ENDS = """ends AS (SELECT e.body_id, e.edge_id, e.src, e.dst, a.radius_nm AS ra, b.radius_nm AS rb,
  sqrt((a.z_nm - b.z_nm) * (a.z_nm - b.z_nm) + (a.y_nm - b.y_nm) * (a.y_nm - b.y_nm) + (a.x_nm - b.x_nm) * (a.x_nm - b.x_nm)) AS length_nm
  FROM edges e JOIN nodes a ON a.body_id = e.body_id AND a.node_id = e.src JOIN nodes b ON b.body_id = e.body_id AND b.node_id = e.dst)"""
POINTS = "points AS (SELECT vec_id AS point_id, CAST(label AS BIGINT) AS body_id, CAST(embedding[1] AS DOUBLE) AS z, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS x FROM embeddings)"
LEDGER = "ledger AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS key, CASE event_type WHEN 'purchase' THEN 'written' WHEN 'view' THEN 'empty' WHEN 'signup' THEN 'dust' WHEN 'click' THEN 'skipped' ELSE 'failed' END AS status, 'g' || (user_id % 3) AS grp FROM events)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").cast("int").alias("z"), F.col("l_partkey").cast("int").alias("y"), F.col("l_quantity").cast("int").alias("x"), F.col("l_suppkey").alias("body_id"), F.col("l_linenumber").alias("label"))


def skeletons(spark: SparkSession, sf_dir: str, broken: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges; broken drops some edges, which makes forests."""
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    nodes = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("body_id"), F.row_number().over(order).cast("long").alias("node_id"), F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("double").alias("z_nm"),
        (F.col("o_totalprice") / 1000).alias("y_nm"), F.row_number().over(order).cast("double").alias("x_nm"), (1 + F.col("o_orderkey") % 17).cast("double").alias("radius_nm"), "o_orderkey",
    )
    edges = nodes.where(F.col("node_id") > 1)
    if broken:
        edges = edges.where(F.col("o_orderkey") % 5 != 0)
    edges = edges.select("body_id", F.col("node_id").alias("edge_id"), F.expr("node_id div 2").alias("src"), F.col("node_id").alias("dst"))
    return nodes, edges


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = [F.element_at("embedding", k).cast("double").alias(n) for k, n in ((1, "z"), (2, "y"), (3, "x"))]
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), F.col("label").cast("long").alias("body_id"), *dims)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in STATUS.items() for x in p]), F.col("event_type")), F.lit("failed"))
    return read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("key"), status.alias("status"), F.concat(F.lit("g"), F.col("user_id") % 3).alias("grp"))
