"""Graph operators over bodies of any size: each body is spread over many tasks, by joins and aggregates alone."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from . import calibre
from .paths import AXES

#: Edges whose components one task finds, counted before.
FEW = 200_000


def _labels_at_once(pairs: DataFrame, key: list[str]) -> DataFrame:
    """labels() of few pairs (key, node, least), by union-find in one task."""
    names = [*key, "node", "label"]

    def work(batches):
        root: dict[tuple, tuple] = {}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for batch in batches:
            for *own, a, b in zip(*(batch.column(c).to_pylist() for c in (*key, "node", "least"))):
                a, b = (find(root.setdefault((*own, i), (*own, i))) for i in (a, b))
                root[max(a, b)] = min(a, b)
        found = [(*x, find(x)[-1]) for x in [*root]]
        for i in range(0, len(found), 1 << 15):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[i : i + (1 << 15)])], names)

    return pairs.select(*[F.col(c).cast("long").alias(c) for c in (*key, "node", "least")]).coalesce(1).mapInArrow(work, ", ".join(f"{n} long" for n in names))


def labels(edges: DataFrame, key: list[str], few: int = FEW) -> DataFrame:
    """(key, node, label): of each node of the edges (key, a, b; whole numbers) the smallest one that it reaches, by large
    and small stars in turn: each node's larger neighbours, then its smaller ones, hang on its smallest. Up to few
    edges go through one task, to the same result."""
    names = [*key, "node", "least"]

    def hung(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select(*key, F.col("node"), F.col("least").alias("other"))
        if larger:
            both = both.union(pairs.select(*key, F.col("least"), F.col("node")))
        low = both.groupBy(*key, "node").agg(F.min("other").alias("m")).withColumn("m", F.least("m", "node"))
        met = both.join(low, [*key, "node"])
        moved = met.where(F.col("other") > F.col("node")).select(*key, F.col("other").alias("node"), F.col("m").alias("least")) if larger else met.select(*key, F.explode(F.array("node", "other")).alias("node"), F.col("m").alias("least"))
        return kept(moved.where(F.col("node") > F.col("least")).select(*names).distinct(), "stars")

    def state(pairs: DataFrame):
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64(*names).cast("decimal(38,0)"))).first())

    now = kept(edges.where("a <> b").select(*key, F.greatest("a", "b").alias("node"), F.least("a", "b").alias("least")).distinct(), "links")
    if now.count() <= few:
        return _labels_at_once(now, key)
    before = None
    while (after := state(now)) != before and after[0]:
        before = after
        now = hung(hung(now, True), False)
    tops = now.select(*key, F.col("least").alias("node"), F.col("least").alias("label")).distinct()
    return now.select(*key, "node", F.col("least").alias("label")).union(tops)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(body_id, node_id, component): the smallest node of each node's component; edges without both of their nodes are
    left out."""
    own = nodes.select("body_id", "node_id")
    ends = edges.select("body_id", F.col("src").alias("a"), F.col("dst").alias("b"))
    for c in ("a", "b"):
        ends = ends.join(own.withColumnRenamed("node_id", c), ["body_id", c], "left_semi")
    found = labels(ends, ["body_id"]).withColumnRenamed("node", "node_id")
    return own.join(found, ["body_id", "node_id"], "left").select("body_id", "node_id", F.coalesce("label", "node_id").alias("component"))


def bridges(nodes: DataFrame, edges: DataFrame, gap: float) -> DataFrame:
    """(body_id, src, dst, length_nm): edges that join components at most gap apart to a forest of least length, ties by
    nodes. Of each two components the shortest link counts. In each round every component takes its shortest
    link, and those that are linked become one; there are at least twice as few after it."""
    if gap < 0:
        raise ValueError("a gap isn't negative")
    member = kept(components(nodes, edges), "components")
    placed = nodes.select("body_id", "node_id", *AXES).join(member, ["body_id", "node_id"])
    side = lambda p: placed.select("body_id", F.col("node_id").alias(f"{p}_node"), F.col("component").alias(f"{p}_part"), *[F.col(a).alias(f"{p}_{a[0]}") for a in AXES])
    none = nodes.limit(0).select("body_id", F.col("node_id").alias("src"), F.col("node_id").alias("dst"), F.lit(0.0).alias("length_nm"))
    if gap == 0:
        return none
    near = calibre.within(side("a"), side("b"), gap, ["body_id"]).where("a_node < b_node and a_part <> b_part")
    link = F.struct(F.sqrt("d2").alias("length_nm"), F.col("a_node").alias("src"), F.col("b_node").alias("dst"))
    links = near.groupBy("body_id", F.least("a_part", "b_part").alias("a"), F.greatest("a_part", "b_part").alias("b")).agg(F.min(link).alias("link"))
    links, taken = kept(links, "gap-links"), []
    while not links.isEmpty():
        ways = links.select("body_id", "a", "link").union(links.select("body_id", "b", "link"))
        chosen = ways.groupBy("body_id", "a").agg(F.min("link").alias("link")).select("body_id", "link").distinct()
        picked = kept(chosen.join(links, ["body_id", "link"]), "picked")
        taken.append(picked.select("body_id", "link.src", "link.dst", "link.length_nm"))
        one = kept(labels(picked.select("body_id", "a", "b"), ["body_id"]), "merged")
        for c in ("a", "b"):
            into = one.select("body_id", F.col("node").alias(c), F.col("label").alias("to"))
            links = links.join(into, ["body_id", c], "left").withColumn(c, F.coalesce("to", c)).drop("to")
        links = links.where("a <> b").groupBy("body_id", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("link").alias("link"))
        links = kept(links, "gap-links")
    out = none
    for more in taken:
        out = out.union(more)
    return out


def bridge_gaps(nodes: DataFrame, edges: DataFrame, gap: float) -> DataFrame:
    """All edges with the flag is_bridge, as paths.bridge_gaps has it: bridges are numbered, by length, after the largest
    edge of their body. Only the bridges of a body, not its edges, are put in order in one task."""
    from pyspark.sql.window import Window

    found = bridges(nodes, edges, gap)
    largest = edges.groupBy("body_id").agg(F.max("edge_id").alias("top"))
    number = F.row_number().over(Window.partitionBy("body_id").orderBy("length_nm", "src", "dst"))
    new = found.withColumn("k", number).join(largest, "body_id", "left").select("body_id", (F.coalesce("top", F.lit(0)) + F.col("k")).alias("edge_id"), "src", "dst", F.lit(True).alias("is_bridge"))
    return edges.select("body_id", "edge_id", "src", "dst", F.lit(False).alias("is_bridge")).union(new)


def path_distances(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(body_id, node_id, distance_nm, source): the nearest source (nodes' is_source) along the edges, ties by the smaller
    source; null where none is reached. Rounds of relaxation: only nodes whose distance fell send it on, and runs of
    nodes with two neighbours are one edge, so there are as many rounds as branch points on the longest way."""
    own = nodes.select("body_id", "node_id", "is_source", *AXES)
    at = lambda p: own.select("body_id", F.col("node_id").alias(p), *[F.col(a).alias(f"{p}_{a}") for a in AXES])
    length = F.sqrt(sum(((F.col(f"src_{a}") - F.col(f"dst_{a}")) * (F.col(f"src_{a}") - F.col(f"dst_{a}")) for a in AXES), F.lit(0.0)))
    links = edges.select("body_id", "src", "dst").where("src <> dst").join(at("src"), ["body_id", "src"]).join(at("dst"), ["body_id", "dst"])
    links = links.select("body_id", "src", "dst", length.alias("w"))
    both = kept(links.union(links.select("body_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "w")).groupBy("body_id", "src", "dst").agg(F.min("w").alias("w")), "ways")
    degree = both.groupBy("body_id", F.col("src").alias("node_id")).agg(F.count("*").alias("n"))
    inner = kept(own.where("not is_source").join(degree.where("n = 2"), ["body_id", "node_id"], "left_semi").select("body_id", "node_id"), "inner")

    hops, chains = _shortcuts(both, inner)
    start = F.when(F.col("is_source"), F.struct(F.lit(0.0).alias("d"), F.col("node_id").alias("s")))
    known = kept(own.join(inner, ["body_id", "node_id"], "left_anti").where("is_source").select("body_id", "node_id", start.alias("best")), "sources")
    front = known
    while not front.isEmpty():
        sent = front.join(hops.withColumnRenamed("src", "node_id"), ["body_id", "node_id"]).select("body_id", F.col("dst").alias("node_id"), F.struct((F.col("best.d") + F.col("w")).alias("d"), F.col("best.s").alias("s")).alias("best"))
        got = sent.groupBy("body_id", "node_id").agg(F.min("best").alias("new"))
        met = kept(known.join(got, ["body_id", "node_id"], "full").select("body_id", "node_id", F.least("best", "new").alias("best"), (F.col("best").isNull() | (F.col("new") < F.col("best"))).alias("fell")), "relaxed")
        known, front = met.select("body_id", "node_id", "best"), met.where("fell").select("body_id", "node_id", "best")
    # nodes of runs: over either end
    along = chains.join(known.withColumnRenamed("node_id", "end"), ["body_id", "end"]).select("body_id", "node_id", F.struct((F.col("best.d") + F.col("w")).alias("d"), F.col("best.s").alias("s")).alias("best"))
    best = known.union(along.groupBy("body_id", "node_id").agg(F.min("best").alias("best")))
    return own.select("body_id", "node_id").join(best, ["body_id", "node_id"], "left").select("body_id", "node_id", F.col("best.d").alias("distance_nm"), F.col("best.s").alias("source"))


def _shortcuts(both: DataFrame, inner: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges between nodes that aren't inner (src, dst, w), runs of inner nodes being one edge, and of each inner node the
    ends of its run (node_id, end, w). A way along a run is a directed edge; its next one is that which leaves its
    end for elsewhere, and ways double in length until all end outside of runs."""
    on = lambda c: inner.select("body_id", F.col("node_id").alias(c), F.lit(True).alias(f"{c}_in"))
    ways = both.join(on("dst"), ["body_id", "dst"], "left").select("body_id", "src", "dst", "w", F.coalesce("dst_in", F.lit(False)).alias("open"))
    ways = kept(ways.withColumns({"first": F.col("dst"), "last": F.col("src")}), "ways")  # first node, and the one before the end
    for _ in range(inner.count().bit_length() + 1):  # what is open then goes round in a ring that nothing reaches
        if ways.where("open").isEmpty():
            break
        step = ways.select("body_id", F.col("src").alias("dst"), F.col("first").alias("after"), F.col("dst").alias("to"), F.col("w").alias("more"), F.col("open").alias("still"), F.col("last").alias("to_last"))
        moved = ways.where("open").join(step, ["body_id", "dst"]).where(F.col("after") != F.col("last"))
        moved = moved.select("body_id", "src", F.col("to").alias("dst"), (F.col("w") + F.col("more")).alias("w"), F.col("still").alias("open"), "first", F.col("to_last").alias("last"))
        ways = kept(ways.where("not open").select("body_id", "src", "dst", "w", "open", "first", "last").union(moved), "ways")
    ends = ways.where("not open").join(on("src"), ["body_id", "src"], "left").join(on("dst"), ["body_id", "dst"], "left")
    hops = ends.where("src_in is null and dst_in is null").groupBy("body_id", "src", "dst").agg(F.min("w").alias("w"))
    chains = ends.where("src_in is not null and dst_in is null").groupBy("body_id", F.col("src").alias("node_id"), F.col("dst").alias("end")).agg(F.min("w").alias("w"))
    return kept(hops, "hops"), kept(chains, "chains")
