"""Tidy tables: quantiles by group, ratios of statistics, histograms, ranks, top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that a task sorts at once, about.
RANGE_ROWS = 1_000_000
#: Statistics that compare() takes by name, beside the median.
STATISTICS = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}


def _value(c: str) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(c), F.col(c))


def _range_of(cuts: list[tuple], columns: list[str], first: int = 0) -> Column:
    """How many cuts are at or below the row: a tree of comparisons, so a row meets log2 of them."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    above = F.lit(True)
    for c, v in reversed(list(zip(columns, cuts[mid]))):
        above = (F.col(c) > F.lit(v)) | ((F.col(c) == F.lit(v)) & above)
    return F.when(above, _range_of(cuts[mid + 1 :], columns, first + mid + 1)).otherwise(_range_of(cuts[:mid], columns, first))


def ranges(df: DataFrame, columns: list[str], rows_each: int = RANGE_ROWS, most: int = 1024) -> tuple[Column, int]:
    """A column that deals rows to ranges of the columns (none null), each of about rows_each, and the number of
    rows. Cuts are those of a sample by hash, of some 20 rows a range: where they lie says how even the ranges
    are, and nothing else. The last column should tell rows apart, so that a hot value is split too."""
    n = df.count()
    parts = min(most, -(-n // rows_each))
    if parts < 2:
        return F.lit(0), n
    every = max(1, n // (20 * parts))
    drawn = df.select(*columns).where(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0)
    sample = sorted(tuple(r) for r in drawn.distinct().limit(200 * parts).collect())
    cuts = sorted({sample[k * len(sample) // parts] for k in range(1, parts)}) if sample else []
    return _range_of(cuts, columns), n


def ranked(df: DataFrame, key: list[str], value: str, rows_each: int = RANGE_ROWS) -> DataFrame:
    """A row for each distinct value of each group (null groups too), which must not be null: n rows, the rows
    ``before`` it, and the ``total`` of the group. Equal values are counted first, and running sums are within
    ranges of the value, whose own sums add up: no task holds a group."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"))
    at, _ = ranges(counted, [value], rows_each)
    counted = counted.withColumn("range", at)
    inner = F.sum("n").over(Window.partitionBy(*key, "range").orderBy(value))
    sums = counted.groupBy(*key, "range").agg(F.sum("n").alias("k"))
    sums = sums.withColumn("base", F.sum("k").over(Window.partitionBy(*key).orderBy("range")) - F.col("k")).withColumn("total", F.sum("k").over(Window.partitionBy(*key)))
    names = {c: f"__{i}" for i, c in enumerate([*key, "range"])}
    sums = sums.select(*[F.col(c).alias(a) for c, a in names.items()], "base", "total")
    same = [F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()]
    return counted.withColumn("inner", inner).join(sums, same).withColumn("before", F.col("base") + F.col("inner") - F.col("n")).select(*key, value, "n", "before", "total")


def _at(rank: Column, value: str) -> Column:
    """The value of ranked() rows at a rank from 0."""
    return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col(value)))


def summarize(df: DataFrame, columns: list[str], by: str | None = None, quantiles: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Group sizes, a null group included, and linear-interpolated quantiles that skip missing values."""
    key = [by] if by else []
    sizes = df.groupBy(*key).agg(F.count("*").alias("n"))
    if not columns:
        return sizes
    if df.count() * len(columns) <= RANGE_ROWS:  # few enough for one task, in one aggregate, to the same numbers
        exact = [F.percentile(_value(c).cast("double"), F.lit(float(q))).alias(f"{c}_p{round(q * 100)}") for c in columns for q in quantiles]
        return df.groupBy(*key).agg(F.count("*").alias("n"), *exact)
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("of"), _value(c).cast("double").alias("cell")) for k, c in enumerate(columns)])).alias("x")
    rows = ranked(df.select(*key, cells).select(*key, "x.*"), [*key, "of"], "cell")
    stats = []
    for k, c in enumerate(columns):
        for q in quantiles:
            place, own = F.lit(float(q)) * (F.col("total") - 1), F.col("of") == k
            low, high = (_at(F.when(own, f(place)), "cell") for f in (F.floor, F.ceil))
            share = F.max(F.when(own, place - F.floor(place)))
            stats.append((low + (high - low) * share).alias(f"{c}_p{round(q * 100)}"))
    found = rows.groupBy(*key).agg(*stats)
    if not by:
        return sizes.join(found, how="left")  # a row each
    return sizes.join(found.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")


def compare(left: DataFrame, right: DataFrame, columns: list[str], labels: tuple[str, str] = ("left", "right"), statistic: str = "median") -> DataFrame:
    """(column, left, right, ratio) of a statistic of either; a missing column is left out, and the ratio
    to zero, or of nothing, is null."""
    shared = [c for c in columns if c in left.columns and c in right.columns]
    if statistic == "median":
        sides = [summarize(df, shared, None, (0.5,)).select(*[F.col(f"{c}_p50").alias(c) for c in shared]) for df in (left, right)]
    else:
        sides = [df.agg(*[STATISTICS[statistic](_value(c)).cast("double").alias(c) for c in shared]) for df in (left, right)]
    rows = [df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(n)) for c in shared])).alias("x")).select("x.*") for df, n in zip(sides, labels)]
    return rows[0].join(rows[1], "column").withColumn("ratio", F.try_divide(F.col(labels[0]), F.nullif(F.col(labels[1]), F.lit(0.0))))


def nearest_rank(df: DataFrame, key: list[str], value: str, quantiles: tuple[float, ...]) -> DataFrame:
    """The value at rank round(q (n - 1)), halves to even, of each group."""
    rows = ranked(df, key, value)
    return rows.groupBy(*key).agg(*[_at(F.bround(F.lit(float(q)) * (F.col("total") - 1)), value).alias(f"p{round(q * 100)}") for q in quantiles])


def equal_width(df: DataFrame, value: str, bins: int) -> DataFrame:
    """(bin, lo, hi, n): the top edge is in the last bin, a constant column has one bin, empty bins are
    there."""
    low, high = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    n = 0 if low is None else 1 if low == high else bins
    width = (high - low) / bins if n > 1 else 0.0
    frame = df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"), (F.lit(low or 0.0) + F.col("id") * width).alias("lo"), (F.lit(low or 0.0) + (F.col("id") + 1) * width).alias("hi"))
    at = F.least(F.floor((F.col(value) - low) * bins / (high - low)), F.lit(bins - 1)) if n > 1 else F.lit(0)
    counted = df.where(F.col(value).isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return frame.join(counted, "bin", "left").na.fill(0, ["n"])


def percent_rank(df: DataFrame, value: str, tie: str, rows_each: int = RANGE_ROWS) -> DataFrame:
    """Rank by value, ties by a key, from 0 to 1, nulls first. Ranks are counted within ranges of both, whose
    sizes add up, so no task sorts the whole table, nor all rows of a hot value."""
    at, _ = ranges(df.where(F.col(value).isNotNull() & F.col(tie).isNotNull()), [value, tie], rows_each)
    parts = df.withColumn("part", F.when(F.col(value).isNull(), -1).otherwise(at))
    sizes = parts.groupBy("part").agg(F.count("*").alias("k"))
    before = sizes.select("part", (F.sum("k").over(Window.orderBy("part")) - F.col("k")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(value, tie)) - 1
    ranked_ = parts.withColumn("own", own).join(F.broadcast(before), "part")  # at most 1,025 ranges
    return ranked_.withColumn("rank", (F.col("own") + F.col("before")) / F.lit(max(df.count() - 1, 1))).drop("part", "own", "before")


def banded(df: DataFrame, rank: str, bands: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows in the half-open rank bands, with the band's name."""
    name = F.lit(None).cast("string")
    for band, (low, high) in bands.items():
        name = F.when((F.col(rank) >= low) & (F.col(rank) < high), band).otherwise(name)
    return df.withColumn("band", name).where(F.col("band").isNotNull())


def by_size(bodies: DataFrame, least: int = 0, limit: int | None = None) -> DataFrame:
    """Bodies of at least so many voxels, largest first; a limit of 0 or None is none."""
    out = bodies.where(F.col("voxel_count") >= least).orderBy(F.desc("voxel_count"), "body_id")
    return out.limit(limit) if limit else out


def paired(rows: DataFrame, baseline: str) -> DataFrame:
    """Rows (body_id, method, seq, nodes, cable) of each method against the baseline's row of the same
    body; of several the first one counts, and rows with an error none."""
    first = rows.where(F.col("error").isNull()).groupBy("body_id", "method").agg(F.min_by(F.struct("nodes", "cable"), "seq").alias("r")).select("body_id", "method", "r.*")
    base = first.where(F.col("method") == baseline).select("body_id", F.col("nodes").alias("base_nodes"), F.col("cable").alias("base_cable"))
    return first.where(F.col("method") != baseline).join(base, "body_id")


def paired_medians(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("method").agg(
        F.count("*").alias("n"), F.median(F.try_divide(F.col("nodes").cast("double"), F.col("base_nodes"))).alias("node_ratio"), F.median(F.col("cable") - F.col("base_cable")).alias("cable_difference"), F.count_if(F.col("cable") > F.col("base_cable")).alias("n_ahead")
    )


def middle(df: DataFrame, key: list[str], value: str, tie: str) -> DataFrame:
    """The middle row of each group, by value and then a key that tells rows apart; the lower of two. Of the
    group's median value, the rows are dealt by the key."""
    rows = ranked(df, key, value)
    place = F.expr("(total + 1) div 2 - 1")
    spot = rows.where((F.col("before") <= place) & (place < F.col("before") + F.col("n"))).select(*key, value, (place - F.col("before")).alias("skip"))
    return ranked_ties(df.join(spot, [*key, value]), key, tie).where("__nth = skip").drop("__nth", "skip")


def ranked_ties(df: DataFrame, key: list[str], tie: str) -> DataFrame:
    places = ranked(df, key, tie).select(*key, tie, F.col("before").alias("__nth"))
    return df.join(places, [*key, tie])


def finite(df: DataFrame, columns: list[str], weight: str | None = None) -> DataFrame:
    """Rows whose values are all numbers, neither missing nor infinite, and whose weight, if any, is over 0."""
    for c in [*columns, *([weight] if weight else [])]:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf")))
    return df.where(F.col(weight) > 0) if weight else df
