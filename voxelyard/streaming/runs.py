"""A run of work over keys that can be stopped at any point and goes on where it was, and streaks kept in a state store.

A batch of keys leaves out those that are done, works on the others key by key (a failing key is a row, not the end of the
run), writes what came out under the batch's number, and only then marks its keys.  A run that is killed between
the two does the same batch again, over what it wrote; one killed after finds the marks.  So each key's rows are there
once, however often the run is stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.trace import guarded
from .merge import _there

MARKS = "key string, seq long, status string, error string, batch long"


class Aborted(RuntimeError):
    """A run that was stopped by its breaker."""


class Run:
    """The outputs and marks of a run, in two folders under a path."""

    def __init__(self, spark: SparkSession, path: str, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, limit: int = 10):
        """work takes the rows of one key and returns rows of the schema; after limit failures in a row the run stops."""
        if limit < 1:
            raise ValueError("a breaker needs one failure at least")
        self.spark, self.path, self.work, self.schema, self.limit = spark, path, work, schema, limit

    def marks(self) -> DataFrame:
        """(key, seq, status, error, batch): one row for each time that a key was worked on."""
        if not _there(self.spark, f"{self.path}/marks"):
            return self.spark.createDataFrame([], MARKS)
        return self.spark.read.schema(MARKS).parquet(f"{self.path}/marks")

    def final(self) -> DataFrame:
        """Each key's last mark."""
        last = F.max_by(F.struct("seq", "status", "error", "batch"), F.col("batch")).alias("m")
        return self.marks().groupBy("key").agg(last).select("key", "m.*")

    def outputs(self) -> DataFrame:
        """The rows of keys that are done: what a batch wrote counts once its keys are marked."""
        kind = f"key string, status string, error string, seq long, row struct<{self.schema}>, batch long"
        if not _there(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], kind).select("key", "row.*")
        rows = self.spark.read.schema(kind).parquet(f"{self.path}/rows").where("status = 'written' and row is not null")
        good = self.final().where("status = 'written'").select("key", "batch")
        return rows.join(good, ["key", "batch"], "left_semi").select("key", "row.*")

    def failed(self) -> bool:
        """Whether any key has failed at last: a caller's exit code."""
        return not self.final().where("status = 'failed'").isEmpty()

    def _streak(self, before: DataFrame) -> int:
        """Failures since the last success, in order of batch and sequence."""
        order = F.struct("batch", "seq", "key")
        good = before.agg(F.max(F.when(F.col("status") != "failed", order)).alias("g")).first()["g"]
        if good is None:
            return before.count()
        last = F.struct(*[F.lit(good[n]).cast(t).alias(n) for n, t in (("batch", "long"), ("seq", "long"), ("key", "string"))])
        return before.where(order > last).count()

    def step(self, batch: DataFrame, number: int) -> None:
        """Does the keys (key, seq and other columns) of a batch that aren't done yet."""
        before = self.marks().where(F.col("batch") < number)
        done = before.where("status <> 'failed'").select("key").distinct()
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        work = self.work

        def each(rows: pd.DataFrame) -> pd.DataFrame:
            found = guarded(work, rows)
            head = {"key": rows["key"].iloc[0], "seq": int(rows["seq"].min())}
            if isinstance(found, dict):
                return pd.DataFrame([head | found | {"row": None}], columns=["key", "status", "error", "seq", "row"])
            out = [head | {"status": "written", "error": None, "row": r} for r in found[names].to_dict("records")]
            out = out or [head | {"status": "empty", "error": None, "row": None}]
            return pd.DataFrame(out, columns=["key", "status", "error", "seq", "row"])

        todo = batch.where("key is not null").join(done, "key", "left_anti")
        found = todo.groupBy("key").applyInPandas(each, f"key string, status string, error string, seq long, row struct<{self.schema}>")
        at = f"{self.path}/rows/batch={number:012d}"
        found.write.mode("overwrite").parquet(at)
        told = self.spark.read.parquet(at).select("key", "seq", "status", "error").distinct()
        self.between(number)
        told.write.mode("overwrite").parquet(f"{self.path}/marks/batch={number:012d}")
        if self._streak(self.marks().where(F.col("batch") <= number)) >= self.limit:
            raise Aborted(f"{self.limit} failures in a row, or more")

    def between(self, number: int) -> None:
        """Called after a batch's rows are written and before its keys are marked; tests stop the run here."""

    def start(self, keys: DataFrame, checkpoint: str) -> StreamingQuery:
        """Runs over a stream of keys until what is there is done."""
        return keys.writeStream.foreachBatch(self.step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Streak(StatefulProcessor):
    """Each group's failures since its last success, in a value of the state store."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("streak", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        n = held[0] if held else 0
        frame = pd.concat(list(rows)).sort_values("seq", ignore_index=True)  # one group's records of one batch
        streaks = []
        for status in frame["status"]:
            n = n + 1 if status == "failed" else 0
            streaks.append(n)
        self.state.update((n,))
        yield pd.DataFrame({"group": key[0], "seq": frame["seq"], "streak": streaks, "tripped": [k >= self.limit for k in streaks]})

    def close(self) -> None:
        pass


def streaks(records: DataFrame, limit: int = 10) -> DataFrame:
    """A stream of (group, seq, streak, tripped) of a stream of records (group, seq, status): how many failures in a row
    each one ends. Streaks go on over batches and restarts in the state store; a batch's records count in order of seq."""
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = records.where("status is not null").select("group", "seq", "status")
    return rows.groupBy("group").transformWithStateInPandas(_Streak(limit), "group string, seq long, streak long, tripped boolean", "Append", "None")
