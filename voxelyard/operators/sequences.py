"""Windows over ordered paths (key, pos, z_nm, y_nm, x_nm, flags)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def steps(path: DataFrame, key: list[str]) -> DataFrame:
    """Distance of each position from the one before; 0 for the first."""
    order = Window.partitionBy(*key).orderBy("pos")
    square = sum(((F.col(c) - F.lag(c).over(order)) * (F.col(c) - F.lag(c).over(order)) for c in ("z_nm", "y_nm", "x_nm")), F.lit(0.0))
    return path.withColumn("step_nm", F.coalesce(F.sqrt(square), F.lit(0.0)))


def path_length(path: DataFrame, key: list[str]) -> DataFrame:
    return steps(path, key).groupBy(*key).agg(F.sum("step_nm").alias("length_nm"))


def trailing_run(path: DataFrame, key: list[str], valid: Column) -> DataFrame:
    """Positions, and length, of the last run in which all are valid."""
    back = Window.partitionBy(*key).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    rows = steps(path, key).withColumn("ok", F.min(valid.cast("int")).over(back) == 1)
    after = F.lag("ok", 1, False).over(Window.partitionBy(*key).orderBy("pos"))
    rows = rows.withColumn("inner", F.col("ok") & after)  # its step lies in the run
    return rows.groupBy(*key).agg(F.count_if("ok").alias("n_valid"), F.coalesce(F.sum(F.when(F.col("inner"), F.col("step_nm"))), F.lit(0.0)).alias("valid_nm"))


def after_last(path: DataFrame, key: list[str], hit: Column) -> DataFrame:
    """The positions from the last hit on; all of a path without one."""
    last = F.max(F.when(hit, F.col("pos"))).over(Window.partitionBy(*key))
    return path.withColumn("last", last).where(F.col("last").isNull() | (F.col("pos") >= F.col("last"))).drop("last")


def named_labels(names: DataFrame, wanted: list[str]) -> DataFrame:
    """(pos, name, label) of wanted names, in their order; a name that isn't there stops the job."""
    asked = names.sparkSession.createDataFrame(list(enumerate(wanted)), "pos int, name string")
    found = asked.join(names, "name", "left")
    label = F.coalesce("label", F.raise_error(F.concat(F.lit("no label is named "), F.col("name"))).cast("int"))
    return found.select("pos", "name", label.alias("label"))
