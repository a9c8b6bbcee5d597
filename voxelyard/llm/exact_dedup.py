"""Exact dedup of batches against immutable snapshots that static binary-fuse filters stand for.

A text's digest is the SHA-256 of its normalised form: every run of ASCII white space is one space.
Digests, never texts, are kept: of each document row its id and digest.

* A snapshot's digests are grouped, and dealt to shards by a hash.  Each shard gets a binary-fuse filter
  (three positions in neighbouring segments, 16-bit fingerprints), built once and stored with the groups in
  the snapshot's folder (``save``).  A snapshot is never changed: what a later batch adds is a snapshot of its
  own (``append``), and a batch meets the stored filters of all (``meet``).
* Digests of a new batch are grouped among themselves, so that copies within the batch meet whether or
  not the snapshot has them, and go to the shard of their hash.  The filter screens them: negatives are
  new for certain, and positives join the shard's exact digests.
* The byte check: documents whose digest occurs more than once, in either, are read again and grouped
  by digest and whole text.  A digest with two texts would stop the job.  Copies are merged before the
  shuffle, so a hot group is a few rows; a bitmap of a fixed size keeps other texts from moving.

All groups are aggregated with partial sums; no group is collected.  Digests' shards are hashes, so no
shard is hot, and a shard's filter has a size that follows ``SHARD_KEYS``.  Rows learn of the groups of
``HOT`` rows or more, of which there can only be so many, by a broadcast, and of all others by a join.

Defined cases: a null text counts as empty, and all empty texts are copies of each other; of rows with
the same id and text one stays; a null id loses against any other; empty tables give no rows; other
columns are ignored, or kept by ``distinct_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, materialise, scratch, sieve, table

#: Keys of a filter shard, on average.
SHARD_KEYS = 1 << 13
#: Bits of the byte check's bitmap: at least, at most 2 to the power of.
BITS = (20, 27)
#: Rows of a group that is broadcast to its rows: so many, or this share of all rows if that is more, so that
#: there are a hundred thousand such groups at most.
HOT, HOT_SHARE = 1000, 1e-5
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """(row, doc_id, digest, key): a row per document row; key is a 64-bit hash of the digest."""
    found = docs.select(F.monotonically_increasing_id().alias("row"), column(docs, "doc_id", "long").alias("doc_id"), F.unhex(F.sha2(normalised(column(docs, "text", "string")), 256)).alias("digest"))
    return found.withColumn("key", F.xxhash64("digest"))


# ---- binary-fuse filter ---------------------------------------------------------------------------
def _mix(key: np.ndarray, seed: int) -> np.ndarray:
    x = key ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Length of a segment (a power of two), and number of segments, for n keys."""
    if n <= 1:
        return 4, 3
    length = 1 << min(18, max(2, int(np.log(n) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    return length, max(3, -(-int(n * factor) // length) + 2)


def _places(h: np.ndarray, length: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three positions, in three segments that follow each other."""
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2)) >> np.uint64(32)
    base, mask = first * np.uint64(length), np.uint64(length - 1)
    return tuple((base + np.uint64(k * length) + ((h >> np.uint64(11 * k)) & mask)).astype(np.int64) if length <= 2048 else (base + np.uint64(k * length) + (_mix(h, k + 7) & mask)).astype(np.int64) for k in range(3))


def _print(h: np.ndarray) -> np.ndarray:
    return (_mix(h, 3) & np.uint64(0xFFFF)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, bytes]:
    """Seed and fingerprints of a filter of distinct 64-bit keys, by peeling in rounds: all keys that
    have a position to themselves leave together."""
    keys = np.unique(keys.view(np.uint64))
    length, segments = _shape(len(keys))
    for seed in range(1, 1000):
        h = _mix(keys, seed)
        at = np.stack(_places(h, length, segments))
        count = np.bincount(at.ravel(), minlength=length * segments)
        owner = np.zeros(length * segments, np.int64)
        for row in at:
            np.add.at(owner, row, np.arange(len(keys)))
        alive, rounds = np.ones(len(keys), bool), []
        while True:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            k, first = np.unique(owner[single], return_index=True)
            rounds.append((k, single[first]))
            alive[k] = False
            for row in at[:, k]:
                np.subtract.at(count, row, 1)
                np.subtract.at(owner, row, k)
        if not alive.any():
            cells = np.zeros(length * segments, np.uint16)
            for k, own in reversed(rounds):
                cells[own] = 0
                cells[own] = _print(h[k]) ^ cells[at[0, k]] ^ cells[at[1, k]] ^ cells[at[2, k]]
            return seed, cells.tobytes()
    raise RuntimeError("no seed peels")


def screen(keys: np.ndarray, n: int, seed: int, cells: bytes) -> np.ndarray:
    """Whether the filter of n keys may hold each key: always for its own, once in 65,536 for others."""
    table_ = np.frombuffer(cells, np.uint16)
    h = _mix(keys.view(np.uint64), seed)
    a, b, c = _places(h, *_shape(n))
    return table_[a] ^ table_[b] ^ table_[c] == _print(h)


# ---- snapshots ------------------------------------------------------------------------------------
FILTER = "shard long, n long, seed long, cells binary"
GROUP = "digest binary, key long, first struct<no_id: boolean, doc_id: bigint, row: bigint>, n long"


def _first() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest", "key").agg(_first(), F.count("*").alias("n"))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(5)), F.lit(shards)).alias("shard")


def build_filters(groups: DataFrame, shards: int) -> DataFrame:
    """A filter for each shard of a snapshot's groups (digest, key, ...)."""

    def work(group: pa.Table) -> pa.Table:
        keys = np.unique(group.column("key").to_numpy())
        seed, cells = build_filter(keys)
        return pa.table({"shard": [group.column("shard")[0].as_py()], "n": [len(keys)], "seed": [seed], "cells": [cells]})

    return groups.select(_shard(shards), "key").groupBy("shard").applyInArrow(work, FILTER)


def _save(groups: DataFrame, path: str) -> None:
    spark = groups.sparkSession
    groups.write.parquet(f"{path}/groups")
    held = spark.read.schema(GROUP).parquet(f"{path}/groups")
    shards = max(1, -(-held.count() // SHARD_KEYS))
    build_filters(held, shards).write.parquet(f"{path}/filters")
    spark.createDataFrame([(shards,)], "shards long").coalesce(1).write.parquet(f"{path}/meta")


def save(docs: DataFrame, path: str) -> None:
    """Writes a snapshot of the documents: groups of equal texts, filters, number of shards."""
    _save(_groups(digests(docs)), path)


def screened(batch: DataFrame, path: str) -> DataFrame:
    """The batch's groups with ``maybe``: whether the snapshot's stored filters let them pass."""
    spark, fields = batch.sparkSession, ", ".join(f"{n} {t}" for n, t in batch.dtypes)
    shards = spark.read.parquet(f"{path}/meta").first()[0]
    filters = spark.read.schema(FILTER).parquet(f"{path}/filters")

    def work(rows: pa.Table, filter_: pa.Table) -> pa.Table:
        maybe = np.zeros(rows.num_rows, bool)
        if filter_.num_rows and rows.num_rows:
            one = filter_.to_pylist()[0]
            maybe = screen(rows.column("key").to_numpy(), one["n"], one["seed"], one["cells"])
        return rows.drop_columns(["shard"]).append_column("maybe", pa.array(maybe))

    dealt = batch.withColumn("shard", _shard(shards)).groupBy("shard")
    return dealt.cogroup(filters.groupBy("shard")).applyInArrow(work, f"{fields}, maybe boolean")


def met(batch: DataFrame, path: str) -> DataFrame:
    """The batch's groups (digest, key, first, n) with old_first and old_n of the snapshot's group of the
    same digest, null where it has none. Only what the filters let pass is joined."""
    known = batch.sparkSession.read.schema(GROUP).parquet(f"{path}/groups").select("digest", F.col("first").alias("old_first"), F.col("n").alias("old_n"))
    maybe = screened(batch.select("digest", "key", "first", "n"), path)
    passed = maybe.where("maybe").join(known, "digest", "left")
    new = maybe.where("not maybe").withColumns({"old_first": F.lit(None).cast(known.schema["old_first"].dataType), "old_n": F.lit(None).cast("long")})
    return passed.unionByName(new).drop("maybe")


def meet(docs: DataFrame, paths: list[str]) -> DataFrame:
    """(row, doc_id, digest, keep_id, known, kept) for each row of a batch: known, if a snapshot has its
    text, and then keep_id is the smallest id there, else the smallest in the batch; kept, if it is that
    row of the batch and no snapshot has it."""
    rows = materialise(digests(docs), "digests")
    groups = materialise(_groups(rows), "batch")
    old = None
    for path in paths:
        own = met(groups, path).where("old_n is not null").select("digest", "old_first")
        old = own if old is None else old.unionByName(own)
    if old is None:
        out = groups.withColumn("old_first", F.lit(None).cast(groups.schema["first"].dataType))
    else:
        out = groups.join(old.groupBy("digest").agg(F.min("old_first").alias("old_first")), "digest", "left")
    found = told(rows, materialise(out, "groups"))
    known = F.col("old_first").isNotNull()
    return found.select("row", "doc_id", "digest", F.when(known, F.col("old_first.doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"), known.alias("known"), (~known & (F.col("row") == F.col("first.row"))).alias("kept"))


def append(docs: DataFrame, paths: list[str], path: str) -> None:
    """Writes those of a batch's texts that no snapshot has as a snapshot of their own."""
    rows = meet(docs, paths).where("not known").select("row", "doc_id", "digest").withColumn("key", F.xxhash64("digest"))
    _save(_groups(rows), path)


# ---- dedup ----------------------------------------------------------------------------------------
def told(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows (row, doc_id, digest) with the other columns of their digest's group."""
    groups = groups.drop("key")
    many = max(HOT, int(HOT_SHARE * rows.count()))
    hot = F.broadcast(groups.where(F.col("n") >= many))
    rows = rows.select("row", "doc_id", "digest")
    return rows.join(hot, "digest").unionByName(rows.join(hot.select("digest"), "digest", "left_anti").join(groups.where(F.col("n") < many), "digest"))


def dedup(docs: DataFrame, is_snapshot: Column) -> DataFrame:
    """(row, doc_id, digest, keep_id, group_size, kept) for each row. is_snapshot says of the columns
    row, doc_id and digest which rows are stored as a snapshot first; the others are the new batch that
    meets it."""
    rows = materialise(digests(docs).withColumn("old", is_snapshot), "digests")
    path = scratch(docs.sparkSession, "snapshot")
    _save(_groups(rows.where("old")), path)
    batch = materialise(_groups(rows.where("not old")), "batch")
    both = met(batch, path).select("digest", "key", F.least("first", "old_first").alias("first"), (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n"))
    # of a snapshot's group that the batch has too, the sum of both counts
    old = docs.sparkSession.read.schema(GROUP).parquet(f"{path}/groups")
    merged = both.unionByName(old).groupBy("digest", "key").agg(F.min("first").alias("first"), F.max("n").alias("n"))
    merged = materialise(merged, "groups")
    _byte_check(docs, merged.where("n > 1"))
    out = told(rows, merged)
    return out.select("row", "doc_id", "digest", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("first.row")).alias("kept"))


def _byte_check(docs: DataFrame, groups: DataFrame) -> None:
    """Reads the texts of all groups of more than one row, and stops if a digest stands for two."""
    n = groups.count()
    bits = min(BITS[1], max(BITS[0], (64 * n).bit_length()))
    slot = F.shiftrightunsigned("key", 64 - bits)
    marks = groups.select(slot.alias("s")).groupBy(F.expr("s div 32768").alias("block")).agg(F.bitmap_construct_agg(F.expr("cast(s % 32768 as bigint)")).alias("bits"))
    text = normalised(column(docs, "text", "string"))
    hashed = docs.select(text.alias("t")).select("t", F.unhex(F.sha2("t", 256)).alias("digest")).withColumn("key", F.xxhash64("digest"))
    # at most 2^27 bits, or 16 MB
    held = hashed.withColumn("s", slot).join(F.broadcast(marks), F.expr("s div 32768") == F.col("block"))
    byte = F.conv(F.hex(F.substring("bits", F.expr("cast(s % 32768 as int) div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    possible = held.where(F.expr("element_at(array(1, 2, 4, 8, 16, 32, 64, 128), cast(s % 8 as int) + 1)").bitwiseAND(byte) != 0)
    texts = possible.groupBy("digest", "t").agg(F.lit(1).alias("x")).join(groups.select("digest"), "digest", "left_semi")
    clash = texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").limit(1).collect()
    if clash:
        raise ValueError(f"two texts have the digest {clash[0]['digest'].hex()}")


def half() -> Column:
    """A snapshot for a table that comes as one: about half of its digests' rows, by a hash of the id;
    the other half is the new batch. Both are processed in full."""
    return F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)) == 0


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all of their own columns. Of the texts, those alone move that have the id of a
    row that goes, or of rows that share both id and text."""
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = dedup(docs, half()).where("group_size > 1").groupBy("digest", "doc_id").agg(F.first(stays).alias("stays"), (F.count("*") > 1).alias("tied"))
    found = materialise(found.where("tied or not stays").withColumnRenamed("doc_id", "own"), "copies")
    names = [F.col(f"`{c}`") for c in docs.columns]
    may, others = sieve(docs, F.xxhash64(column(docs, "doc_id", "long")), found.select(F.xxhash64("own")))
    packed = may.select(F.struct(*names).alias("doc"), column(may, "doc_id", "long").alias("own_id"), F.unhex(F.sha2(normalised(column(may, "text", "string")), 256)).alias("own_digest"))
    met_ = packed.join(found, (F.col("own_digest") == F.col("digest")) & F.col("own_id").eqNullSafe(F.col("own")), "left")
    one = met_.where("stays").groupBy("digest", "own").agg(F.first("doc").alias("doc")).select("doc")
    return others.union(met_.where("stays is null").select("doc.*")).union(one.select("doc.*"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the whole table: the rows of one half as a snapshot, those of the other as a batch."""
    found = dedup(table(spark, sf_dir, "documents"), half())
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, CAST(count(*) OVER (PARTITION BY h) AS BIGINT) AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
FROM d
"""
