"""Places of regex matches by SQL functions alone: splitting a text at a pattern gives the pieces
between its matches, so running sums of lengths are the matches' places, in code points."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Code points before a match that are kept as its context.
CONTEXT = 32
PIECE = "array<struct<kind:int,pos:int,lead:int,own:int,match:string,before:string>>"


def pieces(text: Column, kind: Column, pattern: Column, measure: Callable[[Column], Column] = F.length) -> Column:
    """Array of (kind, pos, lead, own, match, before): each match with what stands between the last
    match and it; the text's tail is an element without a match."""
    both = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)))
    return F.transform(
        both,
        lambda z, i: F.struct(
            kind.cast("int").alias("kind"), i.alias("pos"), measure(z["0"]).cast("int").alias("lead"), measure(z["1"]).cast("int").alias("own"), z["1"].alias("match"), F.right(z["0"], F.lit(CONTEXT)).alias("before")
        ),
    )


def gated(text: Column, gate: Column, kind: int, pattern: str) -> Column:
    """The pieces of the texts that pass a cheap test; none of the others."""
    return F.when(gate, pieces(text, F.lit(kind), F.lit(pattern))).otherwise(F.array().cast(PIECE))


def placed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Adds start and end to exploded pieces; rows without a match keep null ones. Rows of a key must
    lie together; its kinds are summed apart."""
    before = Window.partitionBy(*key, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("lead").cast("long") + F.coalesce("own", F.lit(0))).over(before)
    return rows.withColumn("end", F.when(F.col("match").isNotNull(), end)).withColumn("start", F.col("end") - F.col("own"))


def joined(items: Column, names: list[str]) -> Column:
    """kind:start:end of an array of (start, kind, end), in order, comma-joined."""
    name = F.array(*map(F.lit, names))
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def gathered(flag: Column) -> Column:
    """Aggregate: the distinct (start, kind, end) for which the flag is set."""
    return F.collect_set(F.when(flag, F.struct("start", "kind", "end")))


def counted(items: str, kind: int) -> Column:
    return F.size(F.filter(items, lambda x: x["kind"] == kind)).cast("long")
