"""Token ids on disk: shards of raw id payloads, and a minimal perfect hash index over them.

Files.  ``<path>/shards/part=<p>`` holds one row per shard, in ascending document order: the ``shard``
number, the keys, their occurrence numbers within the part, the id offsets of its documents, and
``payload``, all ids of its documents in a row as raw little-endian integers of 2 or 4 bytes, as the
vocabulary needs, uncompressed and each in a row group of its own.  ``<path>/index`` holds one row per index
bucket: the seeds of a minimal perfect hash over the bucket's keys (compressed hash-and-displace), and for
each of its positions a stored 32-bit fingerprint and the place: part, shard, and first byte and number of ids
in the shard's payload.  A key is hashed to its bucket, the seed of its group gives its position, the
fingerprint tells absent keys, and the place gives the ids.  Up to ``PRUNE`` buckets and shards are named in
the filters of the two scans, so a key reads one bucket and one shard, whatever the size of the store.
Spark's Parquet writer makes the files, so the store may lie in any file system that Spark can reach, and lost
tasks are run again without traces.

Order.  Documents are encoded first, so that ids move and not texts.  Their part is found by bounds that
Spark's range partitioner gives for the keys alone; rows of a repeated key are told apart by a hash of their
text, so that a hot key is spread over parts.  ``start`` of a document is
a sum of three: the ids of the parts before, of the part's shards before, and of the shard's documents
before.  The same key's rows are numbered likewise, from the part where it begins.

Defined cases: null and empty texts are the end id alone; null keys come first and are looked up as
any other key; a repeated key has a row per occurrence, numbered from 0 in file order; a text of any length
is one document, in a shard of its own beyond ``SHARD_IDS``; an empty table makes an empty store; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import column, materialise, scratch, table
from .tokens import blocks, encoder, released

END_ID = 1
#: Ids of a shard; a longer document has a shard of its own.
SHARD_IDS = 1 << 20
#: Keys of an index bucket, on average.
BUCKET_KEYS = 4096
#: Keys of a displacement group, on average.
GROUP_KEYS = 4
#: Seeds that are tried at a time.
TRIES = np.arange(16, dtype=np.uint64)

#: Parts of the store for each task that writes it.
TASK_PARTS = 2
#: Buckets, and shards, that a scan names in its filter; beyond, it reads all of them.
PRUNE = 1000

SHARDS = "part int, shard int, width int, keys array<long>, occurrences array<long>, offsets array<long>, n_ids long, payload binary"
INDEX = "bucket long, n int, seeds binary, fingerprints binary, places binary"
PLACE = np.dtype([("part", "<i4"), ("shard", "<i4"), ("byte", "<i8"), ("n_tokens", "<i8")])


# ---- writing ------------------------------------------------------------------------------------
def part_bounds(docs: DataFrame, parts: int) -> list[tuple[bool, int, int]]:
    """The smallest (known, doc_id, tie) of each of some parts of about equal numbers of rows. That many rows
    reach the driver; parts is a setting."""
    keys = keyed(docs).select(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "tie")
    ranges = keys.repartitionByRange(parts, "known", "doc_id", "tie")
    lows = ranges.groupBy(F.spark_partition_id()).agg(F.min(F.struct("known", "doc_id", "tie")).alias("low"))
    return sorted(tuple(r["low"]) for r in lows.select("low").collect())


def keyed(docs: DataFrame) -> DataFrame:
    text = column(docs, "text", "string")
    return docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.cast("binary").alias("text"))


def encoded(docs: DataFrame, tokenizer: str, bounds: list[tuple[bool, int, int]], end_id: int = END_ID) -> DataFrame:
    """(part, doc_id, tie, width, ids) of each row: its raw ids with the end id, and a hash of its text."""

    def work(batches):
        coder = encoder(tokenizer)
        width = 2 if coder.tokenizer.get_vocab_size() <= 1 << 16 else 4
        for batch in batches:
            doc_ids, ties = batch.column("doc_id"), batch.column("tie")
            part = [max(0, bisect_right(bounds, (d is not None, d or 0, t)) - 1) for d, t in zip(doc_ids.to_pylist(), ties.to_pylist())]
            for i, j, texts in blocks(batch.column("text")):
                flat, n = coder.encode(texts)
                ends = np.cumsum(n)
                whole = np.insert(flat, ends, np.uint32(end_id)).astype(f"<u{width}")
                cells = pa.array(np.append(0, (ends + np.arange(1, len(n) + 1)) * width), pa.int64())
                ids = pa.Array.from_buffers(pa.large_binary(), len(n), [None, cells.buffers()[1], pa.py_buffer(whole.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(part[i:j], pa.int32()), doc_ids.slice(i, j - i), ties.slice(i, j - i), pa.array(np.full(j - i, width, np.int32)), ids.cast(pa.binary())], ["part", "doc_id", "tie", "width", "ids"])

    return keyed(docs).mapInArrow(released(work, encoders=True), "part int, doc_id long, tie long, width int, ids binary")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encodes all documents and writes shards and index."""
    kinds = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("width", pa.int32()), *[(c, pa.list_(pa.int64())) for c in ("keys", "occurrences", "offsets")], ("n_ids", pa.int64()), ("payload", pa.binary())])

    def work(batches):
        part, shard, width, keys, numbers, ids, ends = -1, 0, 2, [], [], [], [0]

        def flush():
            nonlocal shard, keys, numbers, ids, ends
            row = {"part": part, "shard": shard, "width": width, "keys": keys, "occurrences": numbers, "offsets": ends, "n_ids": ends[-1], "payload": b"".join(ids)}
            shard, keys, numbers, ids, ends = shard + 1, [], [], [], [0]
            return pa.RecordBatch.from_pylist([row], kinds)

        last, number = object(), 0
        for batch in batches:
            for i in range(batch.num_rows):
                own, doc_id, width, cell = (batch.column(c)[i].as_py() for c in ("part", "doc_id", "width", "ids"))
                n = len(cell) // width
                if keys and (own != part or ends[-1] + n > shard_ids):
                    yield flush()
                if own != part:
                    part, shard, last = own, 0, object()
                number = number + 1 if doc_id == last else 0
                last = doc_id
                keys.append(doc_id)
                numbers.append(number)
                ids.append(cell)
                ends.append(ends[-1] + n)
        if keys:
            yield flush()

    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = encoded(docs, tokenizer, part_bounds(docs, tasks * TASK_PARTS), end_id)
    ordered = rows.repartition(tasks, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie")
    shards = ordered.select("part", "doc_id", "width", "ids").mapInArrow(released(work, encoders=True), SHARDS)
    shards.write.partitionBy("part").option("compression", "none").option("parquet.block.size", 1 << 20).parquet(f"{path}/shards")
    write_index(spark, path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(f"{path}/shards")


def first_numbers(shards: DataFrame) -> list[tuple[int, int | None, int]]:
    """(part, key, n) of each part whose first key begins in parts before, which have n rows of it. A
    row per part, whose number is a setting, is all that is looked at."""
    at = F.struct("shard", F.element_at("keys", -1).alias("key"), (F.element_at("occurrences", -1) + 1).alias("n"))
    ends = shards.groupBy("part").agg(F.min_by(F.element_at("keys", 1), "shard").alias("first"), F.max_by(at, "shard").alias("last")).orderBy("part").collect()
    out, key, n = [], object(), 0
    for r in ends:
        base = n if r["first"] == key else 0
        if base:
            out.append((r["part"], r["first"], base))
        whole = r["last"]["key"] == r["first"]  # then the last key's number goes on from the parts before
        key, n = r["last"]["key"], r["last"]["n"] + (base if whole else 0)
    return out


def places(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, occurrence, part, shard, byte, n_tokens) of every stored document, without its payload."""
    shards = stored(spark, path)
    each = F.posexplode(F.arrays_zip("keys", "occurrences"))
    slots = shards.select("part", "shard", "width", "offsets", each.alias("slot", "x"))
    start, end = F.element_at("offsets", F.col("slot") + 1), F.element_at("offsets", F.col("slot") + 2)
    slots = slots.select(F.col("x.keys").alias("doc_id"), F.col("x.occurrences").alias("number"), "part", "shard", (start * F.col("width")).alias("byte"), (end - start).alias("n_tokens"))
    before = spark.createDataFrame(first_numbers(shards), "part int, key long, before long")
    joined = slots.join(F.broadcast(before).withColumnRenamed("part", "at"), (F.col("part") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("key")), "left")
    return joined.select("doc_id", (F.col("number") + F.coalesce("before", F.lit(0))).alias("occurrence"), "part", "shard", "byte", "n_tokens")


def hashed(doc_id: Column, occurrence: Column, buckets: int) -> list[Column]:
    """Bucket, and two independent hashes, of a key."""
    known = F.coalesce(doc_id, F.lit(0)), doc_id.isNull().cast("int"), occurrence.cast("long")
    return [F.pmod(F.xxhash64(*known), F.lit(buckets)).alias("bucket"), F.xxhash64(F.lit(1), *known).alias("h1"), F.xxhash64(F.lit(2), *known).alias("h2")]


def write_index(spark: SparkSession, path: str) -> None:
    total = stored(spark, path).select(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_KEYS))

    def work(group: pa.Table) -> pa.Table:
        h1, h2 = (group.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        seeds, position = displace(h1, h2)
        place, fingerprint = np.zeros(len(h1), PLACE), np.zeros(len(h1), np.uint32)
        for c in PLACE.names:
            place[c][position] = group.column(c).to_numpy()
        fingerprint[position] = (h2 & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.table({"bucket": [group.column("bucket")[0].as_py()], "n": pa.array([len(h1)], pa.int32()), "seeds": [seeds.tobytes()], "fingerprints": [fingerprint.tobytes()], "places": [place.tobytes()]})

    keys = places(spark, path).select(*hashed(F.col("doc_id"), F.col("occurrence"), buckets), *PLACE.names)
    built = keys.groupBy("bucket").applyInArrow(work, INDEX)
    # a row group holds few buckets, so that a scan for one of them skips the others
    built.write.option("compression", "none").option("parquet.block.size", 1 << 17).parquet(f"{path}/index")
    spark.createDataFrame([(buckets,)], "buckets long").coalesce(1).write.parquet(f"{path}/meta")


# ---- the hash -----------------------------------------------------------------------------------
def _mix(h: np.ndarray, seed) -> np.ndarray:
    x = h ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def group_of(h2: np.ndarray, n: int) -> np.ndarray:
    return ((h2 >> np.uint64(32)) % np.uint64(max(1, n // GROUP_KEYS))).astype(np.int64)


def position_of(h1: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    """A seed of 0 or more displaces; a negative one is the position itself, for a group of one key."""
    moved = (_mix(h1, 0) + np.maximum(seed, 0).astype(np.uint64) * (_mix(h1, 1) | np.uint64(1))) >> np.uint64(11)
    return np.where(seed < 0, -1 - seed, (moved % np.uint64(n)).astype(np.int64))


def displace(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds by group (int64), and the position of each key: a permutation of 0 to n - 1.

    Groups are placed by falling size, at the first seed under which all of their keys fall on free
    positions of their own; groups of one key, last, take what is left."""
    n = len(h1)
    if len(np.unique(np.stack([h1, h2]), axis=1).T) != n:
        raise ValueError("two keys have the same 128-bit hash")
    group = group_of(h2, n)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=max(1, n // GROUP_KEYS))
    firsts = np.cumsum(sizes) - sizes
    seeds, taken = np.zeros(len(sizes), np.int64), np.zeros(n, bool)
    position = np.zeros(n, np.int64)
    base, stride = _mix(h1, 0), _mix(h1, 1) | np.uint64(1)
    for g in np.argsort(-sizes, kind="stable"):
        k = order[firsts[g] : firsts[g] + sizes[g]]
        if sizes[g] == 0:
            break
        if sizes[g] == 1:
            rest = order[firsts[np.flatnonzero(sizes == 1)]]
            position[rest] = np.flatnonzero(~taken)
            seeds[group[rest]] = -1 - position[rest]
            break
        seed, own, by = 0, base[k], stride[k]
        while True:
            at = ((own + (TRIES + np.uint64(seed))[:, None] * by) >> np.uint64(11)) % np.uint64(n)
            found = next((t for t in np.flatnonzero(~taken[at].any(axis=1)).tolist() if len({*at[t].tolist()}) == len(k)), None)
            if found is not None:
                break
            seed += len(TRIES)
        seeds[g], position[k] = seed + found, at[found]
        taken[at[found]] = True
    return seeds, position


# ---- reading ------------------------------------------------------------------------------------
def _named(rows: DataFrame, names: list[str], pruned: DataFrame) -> DataFrame:
    """The rows of pruned whose columns names are among those of rows: by a filter that the scan takes
    up, if there are PRUNE values at most, else all rows."""
    asked = rows.select(*names).distinct().limit(PRUNE + 1).collect()
    if len(asked) > PRUNE:
        return pruned
    keep = F.lit(True)
    for n in names:
        keep = keep & F.col(n).isin(sorted({r[n] for r in asked}))
    return pruned.where(keep)


def lookup(keys: DataFrame, path: str) -> DataFrame:
    """The places of the keys (doc_id, occurrence) that the store holds, by way of the index."""
    spark = keys.sparkSession
    buckets = spark.read.parquet(f"{path}/meta").first()[0]

    def work(asked: pa.Table, index: pa.Table) -> pa.Table:
        kinds = {"part": pa.int32(), "shard": pa.int32(), "byte": pa.int64(), "n_tokens": pa.int64()}
        if not index.num_rows or not asked.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "occurrence": pa.array([], pa.int64()), **{c: pa.array([], t) for c, t in kinds.items()}})
        n, (seeds, fingerprints, place) = index.column("n")[0].as_py(), (np.frombuffer(index.column(c)[0].as_py(), t) for c, t in (("seeds", np.int64), ("fingerprints", np.uint32), ("places", PLACE)))
        h1, h2 = (asked.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        at = position_of(h1, seeds[group_of(h2, n)], n)
        held = fingerprints[at] == (h2 & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        found, at = asked.filter(pa.array(held)), at[held]
        return pa.table({"doc_id": found.column("doc_id"), "occurrence": found.column("occurrence"), **{c: pa.array(place[c][at], t) for c, t in kinds.items()}})

    asked = keys.select("doc_id", F.col("occurrence").cast("long").alias("occurrence"), *hashed(F.col("doc_id"), F.col("occurrence"), buckets))
    index = _named(asked, ["bucket"], spark.read.schema(INDEX).parquet(f"{path}/index"))
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(work, "doc_id long, occurrence long, part int, shard int, byte long, n_tokens long")


def bases(shards: DataFrame) -> DataFrame:
    """Ids before each shard. The last window is over one row per part, whose number is a setting."""
    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    before = sums.select("part", (F.sum("n_part").over(Window.orderBy("part")) - F.col("n_part")).alias("before_part"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")
    return shards.select("part", "shard", "width", inside.alias("before_shard")).join(before, "part").select("part", "shard", "width", (F.col("before_part") + F.col("before_shard")).alias("base"))


def payloads(shards: DataFrame, digest: bool = False) -> DataFrame:
    """Per stored document its first byte in the shard's payload, and the ids as little-endian unsigned
    32-bit integers, or their crc32."""

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part, shard, width, offsets, payload = (batch.column(c)[i] for c in ("part", "shard", "width", "offsets", "payload"))
                ids, offsets = np.frombuffer(payload.as_buffer(), f"<u{width.as_py()}").astype("<u4"), offsets.values.to_numpy()
                cells = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                last = pa.array([zlib.crc32(c) for c in cells], pa.int64()) if digest else pa.array([c.tobytes() for c in cells], pa.binary())
                arrays = [pa.array(np.full(len(cells), x.as_py(), np.int32)) for x in (part, shard)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(offsets[:-1] * width.as_py()), last], ["part", "shard", "byte", "ids_crc32" if digest else "ids"])

    return shards.select("part", "shard", "width", "offsets", "payload").mapInArrow(released(work, encoders=True), f"part int, shard int, byte long, {'ids_crc32 long' if digest else 'ids binary'}")


def read(keys: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """The keys' documents: doc_id, occurrence, start, n_tokens, and ids or ids_crc32."""
    spark = keys.sparkSession
    found = materialise(lookup(keys, path), "places")
    own = payloads(_named(found, ["part", "shard"], stored(spark, path)), digest)
    before = bases(stored(spark, path).select("part", "shard", "width", "n_ids"))
    whole = found.join(own, ["part", "shard", "byte"]).join(before, ["part", "shard"])
    start = F.col("base") + (F.col("byte") / F.col("width")).cast("long")
    return whole.select("doc_id", "occurrence", start.alias("start"), "n_tokens", "ids_crc32" if digest else "ids")


def all_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, occurrence) of each row. A key's rows are counted, and its numbers made in runs."""
    n = docs.select(column(docs, "doc_id", "long").alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n"))
    runs = n.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div 4096"))).alias("run"))
    return runs.select("doc_id", F.explode(F.sequence(F.col("run") * 4096, F.least(F.col("run") * 4096 + 4096, "n") - 1)).alias("occurrence"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the whole table's ids, and reads every document back by its key."""
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents"), scratch(spark, "token-store")
    write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read(all_keys(docs), path, digest=True).drop("occurrence")
