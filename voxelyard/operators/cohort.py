"""Cohorts and properties: checked id lists, membership, tags as columns, merges that keep types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug


def bad_ids(ids: DataFrame) -> DataFrame:
    """Offending ids (body_id, problem): negative or null ones, and those that come twice."""
    n = ids.groupBy("body_id").agg(F.count("*").alias("n"))
    problem = F.when(F.col("body_id").isNull(), "missing").when(F.col("body_id") < 0, "negative").when(F.col("n") > 1, "duplicate")
    return n.select("body_id", problem.alias("problem")).where(F.col("problem").isNotNull())


def checked(ids: DataFrame) -> DataFrame:
    """The ids, or an error that names up to five offenders. Ids must be integers: floats lose digits."""
    kind = dict(ids.dtypes)["body_id"]
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"body ids must be integers, not {kind}")
    found = bad_ids(ids).orderBy("problem", "body_id").limit(5).collect()
    if found:
        raise ValueError("bad ids: " + ", ".join(f"{r['body_id']} ({r['problem']})" for r in found))
    return ids


def keep_union(sources: list[DataFrame] | None) -> DataFrame | None:
    """Distinct ids of all sources; no sources mean every body, which is None."""
    if not sources:
        return None
    return reduce(DataFrame.unionByName, [s.select(F.col("body_id").cast("long").alias("body_id")) for s in sources]).distinct()


def membership(cohorts: dict[tuple[str, str], DataFrame], spark=None) -> DataFrame:
    """A row per dataset, cohort and body; cohorts may overlap."""
    frames = [ids.select(F.lit(d).alias("dataset"), F.lit(c).alias("cohort"), F.col("body_id").cast("long").alias("body_id")) for (d, c), ids in cohorts.items()]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], "dataset string, cohort string, body_id long")


def tag_list(indices: Column, vocabulary: Column) -> Column:
    """Tags by their places in a vocabulary."""
    return F.transform(indices, lambda i: F.get(vocabulary, i))


def namespaces(tags: DataFrame) -> DataFrame:
    """(body_id, namespace, value, pos) of tags split at their first colon; a bare tag has no namespace."""
    each = tags.select("body_id", F.posexplode("tags").alias("pos", "tag"))
    at = F.instr("tag", ":")
    return each.select("body_id", "pos", F.when(at > 0, F.substr("tag", F.lit(1), at - 1)).alias("namespace"), F.when(at > 0, F.substr("tag", at + 1)).otherwise(F.col("tag")).alias("value"))


def wide(tags: DataFrame, names: list[str], flags: list[str]) -> DataFrame:
    """A column for each namespace with its first value, <name>_all with the list where some body has
    several, and a boolean tags_<slug> for each bare tag. Names are given, or found by discover()."""
    split = namespaces(tags)
    several = {r[0] for r in split.where(F.col("namespace").isin(names)).groupBy("body_id", "namespace").agg(F.count("*").alias("n")).where("n > 1").select("namespace").distinct().collect()} if names else set()
    columns = []
    for n in names:
        own = F.sort_array(F.collect_list(F.when(F.col("namespace") == n, F.struct("pos", "value"))))
        columns.append(F.get(own, F.lit(0))["value"].alias(n))
        if n in several:
            columns.append(own["value"].alias(f"{n}_all"))
    plain = [F.max(F.coalesce(F.col("namespace").isNull() & (F.col("value") == f), F.lit(False))).alias(f"tags_{slug_of(f)}") for f in flags]
    found = split.groupBy("body_id").agg(*columns, *plain)
    return tags.select("body_id").join(found, "body_id", "left").na.fill(False, [f"tags_{slug_of(f)}" for f in flags])


def slug_of(tag: str) -> str:
    import re

    return re.sub("[^0-9A-Za-z]+", "_", tag).strip("_").lower() or "tag"


def discover(tags: DataFrame, most: int = 1000) -> tuple[list[str], list[str]]:
    """Namespaces and bare tags of a vocabulary, which is refused where it has more than ``most``."""
    found = namespaces(tags).select("namespace", F.when(F.col("namespace").isNull(), F.col("value")).alias("flag")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} namespaces and tags")
    return sorted({r["namespace"] for r in found if r["namespace"]}), sorted({r["flag"] for r in found if r["flag"] is not None})


def merge_properties(bodies: DataFrame, properties: DataFrame, how: str = "left") -> DataFrame:
    """Joined by body; boolean properties stay boolean, and are false where absent."""
    flags = [n for n, t in properties.dtypes if t == "boolean"]
    out = bodies.join(properties, "body_id", how)
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})


def outer(frames: list[DataFrame]) -> DataFrame:
    """Full outer join of property tables on the body; a column that is in several gets its table's number."""
    names: list[str] = [n for f in frames for n in f.columns if n != "body_id"]
    out = None
    for k, f in enumerate(frames):
        f = f.select("body_id", *[F.col(n).alias(f"{n}_{k}" if names.count(n) > 1 else n) for n in f.columns if n != "body_id"])
        out = f if out is None else out.join(f, "body_id", "full")
    return out


def slugged(c: Column) -> Column:
    return slug(c)
