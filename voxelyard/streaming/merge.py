"""Streams of block results: exactly-once merges, running counts, a circuit breaker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ledger

BOX = "z0 long, y0 long, x0 long, z1 long, y1 long, x1 long, voxel_count long"
BLOCKS = f"block string, body_id long, {BOX}"


def _there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


class BlockStore:
    """A table of block results by batch. A block counts once however often it comes: a batch leaves out
    the blocks of earlier ones, and is written under its number, so one that is run again replaces itself.

    Beside the rows there are each batch's blocks, which later batches look at, and its sums by body, which
    are all that is read for the bodies."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, part: str, schema: str) -> DataFrame:
        if not _there(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.path}/{part}")

    def write(self, batch: DataFrame, number: int) -> None:
        at = lambda part: f"{self.path}/{part}/batch={number:012d}"
        seen = self._read("blocks", "block string").where(F.col("batch") < number).select("block").distinct()
        fresh = batch.dropDuplicates(["block", "body_id"]).join(seen, "block", "left_anti")
        fresh.write.mode("overwrite").parquet(at("rows"))
        fresh = self.spark.read.schema(BLOCKS).parquet(at("rows"))
        none = fresh.limit(0)
        ledger.merge_blocks(none, fresh, none.select("block"), 1.0).drop("volume_nm3").write.mode("overwrite").parquet(at("bodies"))
        fresh.select("block").distinct().write.mode("overwrite").parquet(at("blocks"))

    def rows(self) -> DataFrame:
        """Each block's rows of its first batch, once."""
        return self._read("rows", BLOCKS)

    def bodies(self, voxel_volume: float) -> DataFrame:
        """Boxes and counts of all bodies, from the sums of the batches."""
        sums = self._read("bodies", f"body_id long, {BOX}")
        own = sums.withColumn("block", F.col("batch").cast("string"))
        return ledger.merge_blocks(sums.limit(0), own, own.limit(0).select("block"), voxel_volume)


def merge(blocks: DataFrame, store: BlockStore, checkpoint: str, also: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Runs a stream of block results into the store until what is there is done."""

    def each(batch: DataFrame, number: int) -> None:
        store.write(batch, number)
        if also:
            also(batch, number)

    return blocks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_counts(records: DataFrame) -> DataFrame:
    """Records by group and status so far, for the update mode."""
    return records.where("status is not null").groupBy("group", "status").agg(F.count("*").alias("n"))


def tail(spark: SparkSession, path: str) -> DataFrame:
    """The records of a growing folder of manifest files, as a stream."""
    from ..sources.readers import records

    return records(spark.readStream.text(path))


class Breaker:
    """Stops a stream whose last records, over all batches, are all failures.

    With a path the streak after each batch is kept there, so a stream that starts again goes on from the
    batch before; a batch that is run again counts once."""

    def __init__(self, limit: int = 10, path: str | None = None):
        self.limit, self.path, self.after = limit, path, {}

    def _before(self, spark: SparkSession, number: int) -> int:
        if self.path and _there(spark, self.path):
            row = spark.read.schema("streak long, batch long").parquet(self.path).where(F.col("batch") < number).agg(F.max_by("streak", "batch")).first()
            return row[0] or 0
        return self.after.get(max((n for n in self.after if n < number), default=None), 0)

    def __call__(self, batch: DataFrame, number: int) -> None:
        good = F.max(F.when(F.col("status") != "failed", F.col("seq")))
        last = batch.agg(good.alias("good"), F.count("*").alias("n")).first()
        if last["good"] is None:
            streak = self._before(batch.sparkSession, number) + last["n"]
        else:
            streak = batch.where(F.col("seq") > F.lit(last["good"])).count()
        self.after = {n: s for n, s in self.after.items() if n >= number - 1} | {number: streak}
        if self.path:
            batch.sparkSession.createDataFrame([(streak,)], "streak long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={number:012d}")
        if streak >= self.limit:
            raise RuntimeError(f"{streak} failures in a row")


def windowed(events: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Events by window and type, with late ones up to the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
