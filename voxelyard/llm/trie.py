"""Conversations as a prefix trie: a node for each distinct sequence of first turns, with totals of its subtree.

Turns become digests at once, texts never move.  A node's key is the xor of hashes of its turns with their
places (128 bits), a running aggregate; every node's members are then checked to have the same parent and the same
digest of the last turn, so no two prefixes are taken for one.

Totals go up by leaf peeling.  Each node belongs to the path of its longest member (ties: largest id), which goes on
to a leaf, so chains of nodes with one child are never peeled node by node.  A path holds the number of the
children that hang off it and haven't reported.  In each round the paths that wait for none are complete: totals of
their nodes are sums from the leaf up, and the top's totals go as a message to the node that the path hangs off,
until only the root's path finishes.  Rounds grow with the number of times that a way to a leaf changes paths.

Hot spots: a conversation is numbered by ranges of the whole order and summed in blocks of ``BLOCK`` turns, so
it may hold any share of all rows; children find the parents that have very many of them by a broadcast of these
(10,000 at most); members that end in one node are joined to pieces of text in parallel, and the pieces alone
are hashed in a row, as SHA-256 needs it.

Defined cases: null role and text are empty; rows without a conv_id belong to no conversation and are left out;
turns of the same number (nulls come first) are ordered by the SHA-256 of role and text, and repeated rows are turns
of their own; the remainders of negative ids have their sign; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import column, materialise, table

#: A conversation's first turns come from the first of its group of ids, up to this many less one.
GROUP, HEAD = 5, 9
#: Turns that one window sums.
BLOCK = 4_096
#: A parent is hot from so many children on, and from this share of all nodes on: so the hot ones are few.
HOT_CHILDREN, HOT_SHARE = 64, 10_000
#: Ids that are joined to one piece of text.
PIECE = 512
KEY = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, bytes) of each row that has a conv_id."""
    role, text = (F.coalesce(column(conversations, c, "string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.select(column(conversations, "conv_id", "long").alias("conv_id"), column(conversations, "turn", "long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return rows.where("conv_id is not null")


def head_of(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string")) % HEAD).cast("long")


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows of turns with rank (from 0), n (turns of the conversation) and n_base (of the first of its group)."""
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "row"]
    rows = turns(conversations).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    rows = materialise(rows.select("conv_id", "digest", "bytes", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("k"))
    own = Window.partitionBy("conv_id")
    parts = parts.select("conv_id", "part", "first", (F.sum("k").over(own.orderBy("part")) - F.col("k")).alias("before"), F.sum("k").over(own).alias("n"))
    parts = materialise(parts.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP), "parts")
    bases = parts.groupBy(F.col("conv_id").alias("base")).agg(F.max("n").alias("n_base"))
    parts = parts.join(bases, "base", "left").select("conv_id", "part", "first", "before", "n", F.coalesce("n_base", F.lit(0)).alias("n_base"))
    return rows.join(parts, ["conv_id", "part"]).select("conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "digest", "bytes", "n", "n_base")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, pos, digest, bytes, size) of rebuilt conversations, and all conversations (conv_id, size)."""
    first = F.col("conv_id") % GROUP == 0
    head = F.when(first, F.col("n")).otherwise(head_of(F.col("conv_id")))
    taken = F.least(head, "n_base")
    sized = rows.withColumn("head", head).withColumn("taken", taken)
    size = F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    sized = sized.withColumn("size", size)
    conversations = sized.where("rank = 0").select("conv_id", "size", "taken")
    own = sized.where((F.col("rank") >= F.col("head")) | first)
    own = own.select("conv_id", F.when(first, F.col("rank")).otherwise(F.col("rank") - F.col("head") + F.col("taken")).alias("pos"), "digest", "bytes", "size")
    heads = rows.where((F.col("rank") < HEAD - 1) & first).select(F.col("conv_id").alias("base"), F.col("rank").alias("pos"), "digest", "bytes")
    others = conversations.where(~first).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    shared = others.join(heads, "base").where("pos < taken").select("conv_id", "pos", "digest", "bytes", "size")
    return own.union(shared), conversations.select("conv_id", "size")


def prefixes(rows: DataFrame) -> DataFrame:
    """Adds depth, the key (k1, k2) of the first depth turns and of the turns before (p1, p2)."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumns({f"h{i}": F.xxhash64(F.lit(i), "pos", "digest") for i in (1, 2)})
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.bit_xor(f"h{i}").alias(f"x{i}") for i in (1, 2)])
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"r{i}": F.bit_xor(f"h{i}").over(within) for i in (1, 2)}).join(blocks, ["conv_id", "block"])
    keys = {f"k{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)}
    rows = rows.withColumns(keys).withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"h{i}")) for i in (1, 2)})
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "k1", "k2", "p1", "p2", "digest", "bytes", "size")


def nodes_of(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row per node: key, parent's key, conv_id, n_convs, bytes, path (the id of its longest member)."""
    longest = F.max(F.struct("size", "conv_id"))["conv_id"].alias("path")
    same = [F.min(c) == F.max(c) for c in ("p1", "p2", "digest")]
    checked = F.when(same[0] & same[1] & same[2], F.min("conv_id")).otherwise(F.raise_error(F.lit("two prefixes share a key")))
    nodes = rows.groupBy(*KEY).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), checked.alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), longest)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), longest).where("n_convs > 0")
    return nodes.unionByName(root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), none.alias("p1"), none.alias("p2"), "conv_id", "n_convs", zero.alias("bytes"), "path"))


def with_parents(nodes: DataFrame, hot_children: int = HOT_CHILDREN) -> DataFrame:
    """Adds n_children, parent_conv_id and parent_path (null for the root)."""
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("path").alias("parent_path"), "n_children")
    hot = F.col("n_children") > max(hot_children, nodes.count() // HOT_SHARE)
    few = F.broadcast(parents.where(hot).drop("n_children"))
    on = ["depth", "p1", "p2"]
    met = nodes.join(few, on, "left")
    found, others = met.where("parent_path is not null"), met.where("parent_path is null").drop("parent_conv_id", "parent_path")
    return found.unionByName(others.join(parents.where(~hot).drop("n_children"), on, "left"))


def totals(nodes: DataFrame) -> DataFrame:
    """(depth, k1, k2, n_leaves, saved_tokens) of each node, by rounds over paths that wait for no message."""
    own = nodes.select(*KEY, "path", "parent_path", F.floor(F.col("depth") / BLOCK).alias("block"), "n_children", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    waiting = materialise(own.withColumns({"leaves": (F.col("n_children") == 0).cast("long")}), "waiting")
    top = F.min(F.struct("depth", "parent_path"))
    paths = waiting.groupBy("path").agg(F.sum(F.greatest(F.col("n_children") - 1, F.lit(0))).alias("remaining"), top.alias("top"), F.max("block").alias("last"))
    paths = materialise(paths.select("path", "remaining", F.col("top.depth").alias("first"), F.col("top.parent_path").alias("onto"), "last"), "paths")
    found = []
    while not paths.isEmpty():
        done = paths.where("remaining = 0")
        if done.isEmpty():
            raise ValueError("no path is complete: nodes don't make a tree")
        blocks = done.select("path", "first", "onto", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), "last")).alias("block"))
        now = waiting.join(blocks, ["path", "block"], "left")
        now = materialise(now, "peeled")
        complete, waiting = now.where("first is not null"), now.where("first is null").drop("first", "onto")
        after = Window.partitionBy("path").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
        sums = complete.groupBy("path", "block").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        sums = sums.select("path", "block", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(c) for c in ("l", "s")])
        up = Window.partitionBy("path", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
        summed = complete.withColumns({"leaves": F.sum("leaves").over(up), "saved": F.sum("saved").over(up)}).join(sums, ["path", "block"])
        summed = summed.select(*KEY, "first", "onto", (F.col("leaves") + F.col("l")).alias("n_leaves"), (F.col("saved") + F.col("s")).alias("saved_tokens"))
        summed = materialise(summed, "complete")
        found.append(summed.select(*KEY, "n_leaves", "saved_tokens"))
        messages = summed.where("depth = first and onto is not null").groupBy(F.col("onto").alias("path"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("got"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        messages = materialise(messages, "messages")
        got = messages.groupBy("path").agg(F.sum("got").alias("got"))
        paths = materialise(paths.where("remaining > 0").join(got, "path", "left").select("path", (F.col("remaining") - F.coalesce("got", F.lit(0))).alias("remaining"), "first", "onto", "last"), "paths")
        heard = waiting.join(messages.drop("got"), ["path", "depth"], "left")
        waiting = heard.select(*KEY, "path", "parent_path", "block", "n_children", (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"))
    out = found[0] if found else waiting.select(*KEY, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    for more in found[1:]:
        out = out.union(more)
    return out


def endings(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, k1, k2, ends_sha256) of the nodes in which conversations (key, conv_id) end."""
    kind = "depth long, k1 long, k2 long"
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(batch):
        return zip(*(batch.column(c).to_pylist() for c in batch.schema.names))

    def join(batches):
        """Pieces of text of the ids that follow each other in a node."""
        key, ids = None, []
        for batch in batches:
            out = []
            for *own, i in rows(batch):
                if ids and (own != key or len(ids) == piece):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = own
                ids.append(i)
            if out:
                yield table_of(out, [*KEY, "first", "text"])
        if ids:
            yield table_of([(*key, ids[0], ",".join(map(str, ids)))], [*KEY, "first", "text"])

    def digest(batches):
        """Pieces of a node in order, fed into one digest."""
        key, state = None, None
        for batch in batches:
            out = []
            for *own, _, text in rows(batch):
                if own != key:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if out:
                yield table_of(out, [*KEY, "ends_sha256"])
        if state:
            yield table_of([(*key, state.hexdigest())], [*KEY, "ends_sha256"])

    def table_of(found, names):
        kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    order = [*KEY, "conv_id"]
    pieces = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(join, kind + ", first long, text string")
    return pieces.repartition(tasks, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, kind + ", ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    rows, convs = rebuilt(materialise(ordered(conversations), "ordered"))
    rows, convs = materialise(prefixes(rows), "prefixes"), materialise(convs, "conversations")
    nodes = materialise(with_parents(nodes_of(rows, convs)), "nodes-of-paths")
    zero = F.lit(0).cast("long")
    turnless = convs.where("size = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    ends = endings(rows.where("depth = size").select(*KEY, "conv_id").union(turnless))
    out = nodes.join(totals(nodes), KEY).join(ends, KEY, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the whole table."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
    FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS rank FROM turns),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, hex(encode(CAST(conv_id AS VARCHAR))) AS bytes FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
    SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(regexp_replace(bytes, '(..)', '\\1 ', 'g'), ' ')[:-2],
        lambda b: [CAST('0x' || b AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END), 4294967295) % 9 AS h
    FROM convs),
parts AS (
    SELECT h.conv_id, 0 AS side, r.rank, r.text, r.digest FROM heads h JOIN ranked r ON r.conv_id = h.base AND r.rank < h.h
    UNION ALL SELECT h.conv_id, 1, r.rank, r.text, r.digest FROM heads h JOIN ranked r ON r.conv_id = h.conv_id AND r.rank >= h.h),
placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, rank) AS depth, octet_length(encode(text)) AS bytes, digest FROM parts),
chained AS (
    SELECT conv_id, depth, bytes, sha256(string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS k FROM placed
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM convs),
prefixed AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS p, max(depth) OVER (PARTITION BY conv_id) AS size FROM chained),
nodes AS (
    SELECT k, depth, min(p) AS p, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
    FROM prefixed GROUP BY k, depth),
families AS (SELECT p AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY p),
sized AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families f USING (k)),
above AS (
    SELECT a.k, CAST(sum(CAST(n.n_children = 0 AS BIGINT)) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.bytes) AS BIGINT) AS saved_tokens
    FROM sized n JOIN prefixed a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.k)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM sized n JOIN above USING (k) LEFT JOIN nodes m ON m.k = n.p
"""
