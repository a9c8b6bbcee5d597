"""Runs that are stopped at each point go on to the same tables; streaks live in the state store."""

import pandas as pd
import pytest

from voxelyard.operators import trace
from voxelyard.streaming import runs

KEYS = "key string, seq long, value long"


def work(rows):
    if (rows["value"] % 7 == 3).any():
        raise ValueError(f"no body {rows['key'].iloc[0]}")
    return pd.DataFrame({"total": [int(rows["value"].sum())] * int(rows["value"].iloc[0] % 3), "n": len(rows)})


def put(spark, tmp_path, numbers, name):
    spark.createDataFrame([(f"k{i}", i, i) for i in numbers], KEYS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")


def stream(spark, tmp_path, name):
    return spark.readStream.schema(KEYS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")


def tables(run):
    return sorted(map(tuple, run.outputs().collect())), sorted((r["key"], r["status"]) for r in run.final().collect())


def test_a_run_killed_between_sink_and_mark_goes_on(spark, tmp_path):
    for numbers in (range(8), range(5, 15), range(15, 20)):
        put(spark, tmp_path, numbers, "keys")
    whole = runs.Run(spark, f"{tmp_path}/whole", work, "total long, n long")
    whole.start(stream(spark, tmp_path, "keys"), f"{tmp_path}/c1").awaitTermination()
    rows, marks = tables(whole)
    assert len(marks) == 20 and whole.failed() and sum(s == "failed" for _, s in marks) == 3
    assert {k for k, *_ in rows} == {f"k{i}" for i in range(20) if i % 7 != 3 and i % 3}

    class Killed(runs.Run):
        left = 2

        def between(self, number):
            if number == 1 and Killed.left:
                Killed.left -= 1
                raise RuntimeError("killed")

    run = Killed(spark, f"{tmp_path}/stopped", work, "total long, n long")
    for _ in range(2):
        with pytest.raises(Exception, match="killed"):
            run.start(stream(spark, tmp_path, "keys"), f"{tmp_path}/c2").awaitTermination()
        assert 0 < len(tables(run)[1]) < 20 and len(tables(run)[0]) < len(rows)
    run.start(stream(spark, tmp_path, "keys"), f"{tmp_path}/c2").awaitTermination()
    assert tables(run) == (rows, marks)


def test_done_keys_are_left_out_and_failed_ones_tried_again(spark, tmp_path):
    run = runs.Run(spark, f"{tmp_path}/run", work, "total long, n long")
    rows = lambda v: spark.createDataFrame([("a", 1, v), ("b", 2, 3), (None, 3, 1)], KEYS)
    run.step(rows(1), 0)
    assert tables(run)[1] == [("a", "written"), ("b", "failed")] and run.failed()
    assert "no body b" in run.marks().where("key = 'b'").first()["error"]
    run.step(rows(2).replace(3, 4, "value"), 1)
    assert tables(run) == ([("a", 1, 1), ("b", 4, 1)], [("a", "written"), ("b", "written")]) and not run.failed()
    again = tables(run)
    run.step(rows(2).replace(3, 4, "value"), 1)  # the same batch once more
    assert tables(run) == again


def test_breaker_and_errors_of_the_system(spark, tmp_path):
    run = runs.Run(spark, f"{tmp_path}/run", work, "total long, n long", limit=3)
    bad = lambda a: spark.createDataFrame([(f"x{a}{i}", i, 3) for i in range(2)], KEYS)
    run.step(bad("p"), 0)
    with pytest.raises(runs.Aborted):
        run.step(bad("q"), 1)
    with pytest.raises(ValueError):
        runs.Run(spark, "x", work, "n long", limit=0)

    def full(rows):
        raise OSError(28, "no space")

    with pytest.raises(Exception, match="no space"):
        runs.Run(spark, f"{tmp_path}/full", full, "n long").step(bad("r"), 0)
    assert trace.systemic(MemoryError()) and not trace.systemic(ValueError()) and not trace.systemic(OSError(2, "no file"))


def test_streaks_go_on_over_batches_and_restarts(spark, tmp_path):
    kind = "`group` string, seq long, status string"

    def records(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/records")

    def go():
        source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/records")
        found = runs.streaks(source, 3)
        found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return {(r["group"], r["seq"]): (r["streak"], r["tripped"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}

    records([("g", 3, "failed"), ("g", 1, "failed"), ("g", 2, "written"), ("h", 1, "failed"), ("h", 2, None)])
    assert go() == {("g", 1): (1, False), ("g", 2): (0, False), ("g", 3): (1, False), ("h", 1): (1, False)}
    records([("g", 5, "failed"), ("g", 4, "failed"), ("h", 3, "written")])
    got = go()  # started anew
    assert got[("g", 4)] == (2, False) and got[("g", 5)] == (3, True) and got[("h", 3)] == (0, False)
