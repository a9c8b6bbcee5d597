"""SimHash near-duplicates through deletion-variant signatures.

Fingerprint: of all word shingles (repeats included) the XXH64 hashes; a bit is set if it is in over
half of them.  Documents link at ``max_distance`` or fewer differing bits, and linked documents form
components.

Two fingerprints with at most 3 differing bits, cut into two halves, agree in one half but for at most
one bit.  So each half is indexed under its 32 one-wildcard variants (one bit blanked out, with its
place as a part of the key), and fingerprints that share a key are candidates, verified by a bit
count.  Work is on distinct fingerprints: copies, a third of all rows or more, are one of them.

No key is ever paired out in full.  A key with up to ``PAIR_KEYS`` fingerprints has its pairs compared.
The fingerprints of fuller keys (dense groups of near copies) go a second, exact way: each is indexed
under the whole fingerprint with any ``max_distance`` bits blanked out, so all that share such a key
link without a comparison, and a star to the smallest one suffices.  Rows grow in proportion to
the input in both.

Components are found by alternating star contraction over tables in the shared scratch folder; no
links or components reach the driver.

Defined cases: null and empty texts, and texts of white space alone, have fingerprint zero, and link
like any other; fewer words than a shingle are one shingle; repeated rows are rows of their own in the
result; null ids are the largest, and a component of null ids alone has a null id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, materialise, sieve, table
from .tokens import blocks, released

SEED = 42
SHINGLE, MAX_DISTANCE = 3, 2
#: Distinct fingerprints that a key may have for its pairs to be compared.
PAIR_KEYS = 256
#: Edges that one task may contract by itself, counted before.
FEW_EDGES = 100_000


def hashes(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle of a UTF-8 text, repeats included; none for a text without words."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # of bytes: A-Z alone are lowered, white space is ASCII's
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxh64_intdigest(line, SEED)], np.uint64)
    ends = list(itertools.accumulate([len(w) + 1 for w in words]))
    return np.array([xxh64_intdigest(line[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :])], np.uint64)


def majority(found: np.ndarray) -> int:
    """Unsigned 64-bit SimHash of shingles: the bits that over half of them have; zero for none."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(found), 1 << 16):
        counts += np.unpackbits(found[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(found)).tobytes(), "big")


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    return majority(hashes(text, size))


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) for each document row: text_key is the MD5 of the text, fp the fingerprint as
    a signed 64-bit integer."""

    def work(batches):
        for batch in batches:
            found = np.array([fingerprint(t, size) for _, _, texts in blocks(batch.column(2)) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_key", "fp"])

    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.md5(text).alias("text_key"), text.cast("binary").alias("text"))
    return rows.mapInArrow(released(work), "doc_id long, text_key string, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def segment_keys(fp: Column, max_distance: int) -> Column:
    """Keys of the exact segments (side 2), and of each segment with one bit blanked out (side: the
    bit). Fingerprints that link share an exact key, or one key from the two sides."""
    segments = max_distance // 2 + 1
    bounds = [64 * k // segments for k in range(segments + 1)]
    out = []
    for s, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) if high - low < 64 else fp
        out.append(F.struct(F.lit(s * 100 + 99).alias("place"), part.alias("part"), F.lit(2).alias("side")))
        for bit in range(high - low):
            out.append(F.struct(F.lit(s * 100 + bit).alias("place"), part.bitwiseAND(F.lit(_signed(~(1 << bit) & (1 << 64) - 1))).alias("part"), F.shiftrightunsigned(part, bit).bitwiseAND(F.lit(1)).cast("int").alias("side")))
    return F.array(*out)


def links(prints: DataFrame, max_distance: int = MAX_DISTANCE, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints (column fp) that make up the same
    components as all links do; all links themselves where no key is fuller than pair_keys."""
    from pyspark.sql.window import Window

    if not 0 <= max_distance <= 3:
        raise ValueError("halves with one blank find distances up to 3")
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # rows are few before they are 66-fold
    index = prints.repartition(tasks).select("fp", F.explode(segment_keys(F.col("fp"), max_distance)).alias("k")).select("fp", "k.*")
    index = index.repartition("place", "part")  # counts and join look at all columns, so they share this one shuffle
    several = (F.min("fp") < F.max("fp")) & ((F.min("side") < F.max("side")) | (F.max("side") == 2))
    counts = index.groupBy("place", "part").agg(F.count("*").alias("n"), several.alias("several")).where("several").drop("several")  # no task buffers a dense key
    shared = materialise(index.join(counts, ["place", "part"]).select("fp", "place", "part", "side", "n"), "signatures")
    few = shared.where(F.col("n") <= pair_keys)
    zero, one, same = (few.where(F.col("side") == s).select("place", "part", F.col("fp").alias(n)) for s, n in ((0, "x"), (1, "y"), (2, "x")))
    pairs = zero.join(one, ["place", "part"]).select("x", "y")
    pairs = pairs.union(same.join(same.withColumnRenamed("x", "y"), ["place", "part"]).where("x < y").select("x", "y"))
    near = pairs.where(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_distance)
    found = near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))

    dense = shared.where(F.col("n") > pair_keys).select("fp").distinct()
    bits = prints.sparkSession.range(1).select(F.lit(0).cast("long").alias("bits"), F.lit(-1).cast("long").alias("top"))
    for _ in range(max_distance):  # rows, as thousands of literals fill the driver
        more = prints.sparkSession.range(64).withColumnRenamed("id", "bit")
        bits = bits.crossJoin(more).where("bit > top").select(F.expr("bits | shiftleft(1L, cast(bit as int))").alias("bits"), F.col("bit").alias("top"))
    blanked = dense.crossJoin(F.broadcast(bits)).select("fp", F.col("bits").alias("mask"), F.col("fp").bitwiseAND(F.bitwise_not("bits")).alias("rest"))
    star = blanked.withColumn("a", F.min("fp").over(Window.partitionBy("mask", "rest"))).where("a < fp").select("a", F.col("fp").alias("b"))
    return found.union(star).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), by union-find in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def work(batches):
        root: dict = {}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for a, b in zip(*(batch.column(c).to_pylist() for c in ("a", "b"))):
                a, b = find(root.setdefault(a, a)), find(root.setdefault(b, b))
                root[max(a, b)] = min(a, b)
        nodes = sorted(root)
        arrow = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}[kind]
        for i in range(0, len(nodes), 1 << 14):
            part = nodes[i : i + (1 << 14)]
            yield pa.RecordBatch.from_arrays([pa.array(part, arrow), pa.array([find(x) for x in part], arrow)], ["node", "root"])

    return edges.select("a", "b").coalesce(1).mapInArrow(work, f"node {kind}, root {kind}")


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the smallest node that it reaches. Large-star and
    small-star steps in turn, until the edges stay as they are; edges up to few are contracted in one
    task, to the same result."""

    def star(pairs: DataFrame) -> DataFrame:
        """Joins each node's edges (u, v) to the smallest of u and its v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialise(edges, "edges")
    before = state(now)
    if before[0] <= few:
        return contracted(now)
    while before[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = materialise(large.where("a < b").distinct(), "large-star")
        down = star(large.select(F.col("b").alias("u"), F.col("a").alias("v")))
        small = down.select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a < b").distinct()
        now = materialise(small, "small-star")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_distance: int = MAX_DISTANCE, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) for each document row; root names the component by its
    smallest fingerprint."""
    rows = materialise(fingerprints(docs, size), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    edges = links(prints.select("fp"), max_distance, pair_keys)
    member = prints.join(components(edges), prints.fp == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = materialise(member, "members")
    lowest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(lowest, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest id (null ids come
    last, and are told apart by their texts); of rows that share both, one. Components are those of
    near_duplicates, or else groups (doc_id, text_key, root) has them. Of the texts, those alone move that have
    the id of a row that goes, or of rows that share both id and text."""
    each = materialise((near_duplicates(docs) if groups is None else groups).groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n")), "groups")
    first = each.groupBy("root").agg(F.sum("n").alias("size"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("x")).where("size > 1")
    stays = F.col("doc_id").eqNullSafe(F.col("x.doc_id")) & (F.col("text_key") == F.col("x.text_key"))
    found = each.join(first, "root").select(F.col("doc_id").alias("own"), "text_key", stays.alias("stays"), "n")
    found = materialise(found.where("n > 1 or not stays"), "copies")
    names = [F.col(f"`{c}`") for c in docs.columns]
    may, others = sieve(docs, F.xxhash64(column(docs, "doc_id", "long")), found.select(F.xxhash64("own")))
    key = F.md5(F.coalesce(column(may, "text", "string"), F.lit("")))
    packed = may.select(F.struct(*names).alias("doc"), column(may, "doc_id", "long").alias("own_id"), key.alias("own_key"))
    met = packed.join(found, (F.col("own_key") == F.col("text_key")) & F.col("own_id").eqNullSafe(F.col("own")), "left")
    one = met.where("stays").groupBy("text_key", "own").agg(F.first("doc").alias("doc"))
    return others.union(met.where("stays is null").select("doc.*")).union(one.select("doc.*"))
