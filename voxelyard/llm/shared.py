"""Helpers of the training-data operators: shared scratch folder, tables, checkpoints."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SCRATCH: list[tuple] = []
#: Bits of a sieve's bitmap: at least, at most 2 to the power of.
SIEVE_BITS = (20, 27)


def _delete(entry: tuple) -> None:
    jvm, conf, path = entry
    with contextlib.suppress(Exception):  # the JVM may be gone
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


@atexit.register
def clear() -> None:
    """Deletes this process's scratch tables; runs when the driver ends, as results may read them until
    then."""
    while _SCRATCH:
        _delete(_SCRATCH.pop())


class Scratch:
    """The scratch tables that are made within it; ``free`` deletes them, once what reads them is written."""

    def __enter__(self) -> "Scratch":
        self.first = len(_SCRATCH)
        return self

    def __exit__(self, *error) -> None:
        self.made = _SCRATCH[self.first :]

    def free(self) -> None:
        for entry in self.made:
            if entry in _SCRATCH:
                _SCRATCH.remove(entry)
                _delete(entry)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir).

    Only where that setting is missing and all runs on one machine, as in tests, a temporary folder is
    set; on a cluster a missing setting is an error."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="voxelyard-"))
        folder = context.getCheckpointDir()
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((context._jvm, context._jsc.hadoopConfiguration(), path))
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again: cuts lineage and survives
    lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(df: DataFrame, name: str, kind: str) -> Column:
    """The column, cast; a null column where the table has none."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def sieve(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key (a 64-bit hash) may be one of keys (one column of such hashes), and the rows whose key
    certainly isn't, so that only the former have to move to a join with what the keys stand for.

    A bitmap decides, of 64 bits for each key and 16 MB at most, which is broadcast. Its false hits are among
    the former: they have to fall out in the join."""
    bits = min(SIEVE_BITS[1], max(SIEVE_BITS[0], (64 * keys.count()).bit_length()))
    marks = keys.toDF("sieve_key").select(F.shiftrightunsigned("sieve_key", 64 - bits).alias("s")).groupBy(F.expr("s div 32768").alias("sieve_block"))
    marks = materialise(marks.agg(F.bitmap_construct_agg(F.expr("cast(s % 32768 as bigint)")).alias("sieve_bits")), "sieve")
    held = rows.withColumn("sieve_slot", F.shiftrightunsigned(key, 64 - bits)).join(F.broadcast(marks), F.expr("sieve_slot div 32768 = sieve_block"), "left")
    byte = F.conv(F.hex(F.substring("sieve_bits", F.expr("cast(sieve_slot % 32768 as int) div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.expr("element_at(array(1, 2, 4, 8, 16, 32, 64, 128), cast(sieve_slot % 8 as int) + 1)").bitwiseAND(byte) != 0, F.lit(False))
    names = [F.col(f"`{c}`") for c in rows.columns]
    return held.where(hit).select(*names), held.where(~hit).select(*names)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
