"""Progress ledgers and idempotent merges: resume, latest status, streaks, upserts without MERGE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.frames import AXES

BOX = [f"{a}{e}" for e in (0, 1) for a in AXES]


def latest(ledger: DataFrame, key: list[str]) -> DataFrame:
    """The last record of each key; later ones supersede. An aggregate, so hot keys merge early."""
    return ledger.groupBy(*key).agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))


def group_counts(ledger: DataFrame, key: list[str]) -> DataFrame:
    """Keys by their latest status."""
    return latest(ledger, key).groupBy("status").agg(F.count("*").alias("n"))


def record_counts(ledger: DataFrame, group: str) -> DataFrame:
    """All records by group and status: a key that was tried again counts again."""
    return ledger.groupBy(group, "status").agg(F.count("*").alias("n"))


def shares(counts: DataFrame, group: str) -> DataFrame:
    total = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("share", F.round(100 * F.col("n") / total, 6))


def done(ledger: DataFrame, key: list[str], failed_too: bool = False) -> DataFrame:
    """Keys whose latest status is final; a failed one is not, unless asked for."""
    final = latest(ledger, key)
    return (final if failed_too else final.where(F.col("status") != "failed")).select(*key)


def todo(all_keys: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    return all_keys.select(*key).join(done(ledger, key), key, "left_anti")


def streaks(ledger: DataFrame, key: list[str], bad: str = "failed") -> DataFrame:
    """Longest run of consecutive bad records of each key, in order of completion."""
    by_key, by_status = Window.partitionBy(*key).orderBy("seq"), Window.partitionBy(*key, "bad").orderBy("seq")
    marked = ledger.withColumn("bad", F.col("status") == bad).withColumn("island", F.row_number().over(by_key) - F.row_number().over(by_status))
    runs = marked.groupBy(*key, "bad", "island").agg(F.count("*").alias("n"))
    return runs.groupBy(*key).agg(F.coalesce(F.max(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("streak"))


def tripped(ledger: DataFrame, limit: int, bad: str = "failed") -> bool:
    """The circuit breaker: whether the last ``limit`` records, over all keys, are all bad."""
    last = ledger.orderBy(F.desc("seq")).limit(limit).agg(F.count("*").alias("n"), F.count_if(F.col("status") == bad).alias("bad")).first()
    return last["n"] == limit and last["bad"] == limit


def merge_blocks(bodies: DataFrame, batch: DataFrame, seen: DataFrame, voxel_volume: float) -> DataFrame:
    """Bodies after blocks are added: boxes grow (nulls skipped), counts add up, and a block that was
    seen, or comes twice in the batch, changes nothing."""
    fresh = batch.join(seen.select("block").distinct(), "block", "left_anti").dropDuplicates(["block", "body_id"])
    cells = bodies.select("body_id", *BOX, "voxel_count").unionByName(fresh.select("body_id", *BOX, "voxel_count"))
    out = cells.groupBy("body_id").agg(*[F.min(c).alias(c) for c in BOX[:3]], *[F.max(c).alias(c) for c in BOX[3:]], F.sum("voxel_count").alias("voxel_count"))
    return out.withColumn("volume_nm3", F.col("voxel_count") * F.lit(float(voxel_volume)))


def merge_counts(old: DataFrame, batch: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Counts by key after blocks are added; boxes, where old has them, stay as they are."""
    fresh = batch.join(seen.select("block").distinct(), "block", "left_anti").dropDuplicates(["block", *key])
    added = fresh.groupBy(*key).agg(F.sum("voxel_count").alias("added"))
    out = old.join(added, key, "full")
    return out.withColumn("voxel_count", F.coalesce("voxel_count", F.lit(0)) + F.coalesce("added", F.lit(0))).drop("added")


def upsert(old: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """New values of the named columns win where they are not null; other columns, and rows without an
    update, stay; rows that are new are added."""
    renamed = new.select(*key, *[F.col(c).alias(f"new_{c}") for c in columns])
    out = old.join(renamed, key, "full")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"new_{c}", c) if c in old.columns else F.col(f"new_{c}"))
    return out.drop(*[f"new_{c}" for c in columns])


def reset(df: DataFrame, columns: list[str], to: Column) -> DataFrame:
    return df.withColumns({c: to.cast(df.schema[c].dataType) for c in columns})


def reset_sweep(bodies: DataFrame) -> DataFrame:
    """Counts and volumes back to zero; boxes and skeletons stay."""
    return reset(bodies, [c for c in ("voxel_count", "volume_nm3") if c in bodies.columns], F.lit(0))


def reset_skeletons(bodies: DataFrame) -> DataFrame:
    """The skeleton's columns back to null; counts and boxes stay."""
    return reset(bodies, [c for c in ("cable_length_nm", "n_branches", "n_tips", "max_radius_nm") if c in bodies.columns], F.lit(None))


# ---- runs -------------------------------------------------------------------------------------------
def by_status(ledger: DataFrame, group: str, statuses: tuple[str, ...]) -> DataFrame:
    """Records of each group, a column per status."""
    return ledger.groupBy(group).agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in statuses])


def last(ledger: DataFrame, status: str, n: int) -> DataFrame:
    """The last n records of a status."""
    return ledger.where(F.col("status") == status).orderBy(F.desc("seq")).limit(n)


def rates(before: DataFrame, after: DataFrame, key: str, minutes: Column) -> DataFrame:
    """Of two snapshots (key, n), what came between them and how much a minute; a group that wasn't there
    had none, and one that shrank, as after a reset, has no rate."""
    both = after.select(key, F.col("n").alias("now")).join(before.select(key, F.col("n").alias("then")), key, "left")
    came = F.col("now") - F.coalesce("then", F.lit(0))
    return both.select(key, came.alias("n"), F.when(came >= 0, F.try_divide(came.cast("double"), F.nullif(minutes.cast("double"), F.lit(0.0)))).alias("rate"))


def planned(stages: DataFrame, stage: str, n: int) -> DataFrame:
    """The table of stages (stage, n_planned) with this one's number of keys, told before it runs."""
    row = stages.sparkSession.createDataFrame([(stage, n)], "stage string, n_planned long")
    return upsert(stages, row, ["stage"], ["n_planned"])


def progress(stages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Done and failed keys of each stage, by their latest status, of those planned."""
    n = latest(ledger, ["stage", "key"]).groupBy("stage").agg(F.count_if(F.col("status") != "failed").alias("done"), F.count_if(F.col("status") == "failed").alias("failed"))
    return stages.join(n, "stage", "left").na.fill(0, ["done", "failed"])


class StaleManifest(RuntimeError):
    """The ledger says that what isn't there was written."""


def stale(ledger: DataFrame, outputs: DataFrame, key: list[str], written: str = "written") -> DataFrame:
    """Keys whose latest status says written and that have no output."""
    return latest(ledger, key).where(F.col("status") == written).select(*key).join(outputs.select(*key), key, "left_anti")


def refuse_stale(ledger: DataFrame, outputs: DataFrame, key: list[str]) -> None:
    """Stops before a run that would take missing outputs for done."""
    some = stale(ledger, outputs, key).limit(5).collect()
    if some:
        raise StaleManifest(f"written, but not there: {', '.join(str(tuple(r)) for r in some)} ...; reset them or bring them back")
