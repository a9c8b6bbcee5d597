"""Near copies by whole-text similarity, for the pipeline: Jaccard of five-word shingle sets of 0.8 or more.

Candidates come from operator 8's method on five-word shingles: fingerprints that are at most
``DISTANCE`` bits apart, by one-wildcard variants of their halves and bit counts.  These distances say little at
that similarity (pairs over 0.8 are up to 14 bits apart), so MinHash adds what they don't reach: ``BANDS`` keys
of ``ROWS`` minima each, of which a pair at 0.8 shares one with a probability of 0.9996.  Each candidate
pair is verified on the whole shingle sets, so nothing below the similarity links.  Linked texts form
components, by operator 8's star contraction.

The texts of a key are compared with one of them, the leader, first.  Only what is then in different
components is compared further, so a group of near copies has no more comparisons than texts.  A key with
up to ``PAIR_KEYS`` texts has its pairs of different components compared.  Those of a fuller key (a dense group of
copies with changes of their own, or of texts with a common passage) go another, exact way.  They get a second
leader, the central text: the one that differs least from the shingles that most of them have.  Each is compared with
that.  Let D(x) be the shingles in which x differs from it.
Two texts differ in D(x) xor D(y), so texts that are alike have most of D in common, though one at least is
not alike with the leader: the rarest shingles of D, as many as that bound leaves, must meet (a prefix
filter).  Few do, as what most texts have, or lack, is in few D.  Shingles that stand in the same texts of a group meet as one.
Where more than ``PAIR_KEYS`` texts meet at a shingle (a group in a group), and more than ``PAIRS_A_TEXT`` pairs for each text of
the input would be compared for that, these form a group with a central text of their own, up to ``ROUNDS`` times; else all
that meet are compared.  So the components are the same as if all pairs of
a key were compared, and neither a group of copies with changes of their own nor a common passage makes pairs of all
its texts.

Texts go by the 16 bytes of their MD5, and the keys of all texts are shuffled once, for their counts and for the join with these.
Of the texts themselves, a sieve lets those alone move that are compared.

Defined cases: fewer words than a shingle are one shingle; texts without words (null, empty, white space)
are equal to each other and to nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .shared import column, materialise, sieve
from .simhash import SEED, components
from .tokens import blocks, released

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
#: Differing bits of fingerprints up to which texts are compared.
DISTANCE = simhash.MAX_DISTANCE
#: Texts that a key may have for its pairs to be compared; the way of fuller keys is as exact.
PAIR_KEYS = 16
#: Central texts, one after another, that a group's texts are compared with before all pairs that meet are.
ROUNDS = 6
#: Pairs for each text of the input that fuller meetings may have to be compared without a further central text.
PAIRS_A_TEXT = 2
_FLIP, _ODD = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * ROWS, 1), np.uint64)
_ODD |= np.uint64(1)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the word shingles of a UTF-8 text."""
    return np.unique(simhash.hashes(text, size))


def band_keys(own: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band, with its number mixed in."""
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 1 << 11):
        low = np.minimum(low, ((own[i : i + (1 << 11)] ^ _FLIP) * _ODD).min(axis=1))
    out = np.arange(BANDS, dtype=np.uint64)
    for part in low.reshape(BANDS, ROWS).T:
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    return docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.unhex(F.md5(text)).alias("text_key"), text.cast("binary").alias("text"))


def _mapped(rows: DataFrame, make, names: list[str], kind: str) -> DataFrame:
    """The columns of names, and what make gives of each text, as signed 64-bit integers."""

    def work(batches):
        for batch in batches:
            found = [pa.array(make(t).view(np.int64)) for _, _, texts in blocks(batch.column("text")) for t in texts]
            ends = np.cumsum([0, *map(len, found)])
            held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(found or [pa.array([], pa.int64())]))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], held], [*names, "held"])

    return rows.select(*names, "text").mapInArrow(released(work), kind + ", held array<long>")


def asked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(text_key, text) of the asked texts."""
    may, _ = sieve(_texts(docs), F.xxhash64("text_key"), keys.select(F.xxhash64("text_key")))
    return may.join(keys, "text_key").groupBy("text_key").agg(F.first("text").alias("text"))


def sets_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(text_key, held): the shingle sets of the asked texts."""
    return materialise(_mapped(asked(docs, keys), shingles, ["text_key"], "text_key binary"), "shingle-sets")


def verified(docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of text keys whose shingle sets are that similar."""
    sets = sets_of(docs, materialise(pairs.select(F.explode(F.array("a", "b")).alias("text_key")).distinct(), "compared"))
    both = pairs.join(sets.select(F.col("text_key").alias("a"), F.col("held").alias("x")), "a").join(sets.select(F.col("text_key").alias("b"), F.col("held").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    whole = F.size("x") + F.size("y") - common
    return materialise(both.where((whole == 0) | (common >= similarity * whole)).select("a", "b"), "near-links")


def _differ(similarity: float) -> float:
    """The share of two similar texts' shingles, both counted, in which they differ at most."""
    return (1 - similarity) / (1 + similarity)


def _pairs(x: DataFrame, y: DataFrame, on: list[str], similarity: float) -> DataFrame:
    """(a, b) of different texts (text_key, n), and of different components if there is a root, that agree in on
    and whose numbers of shingles let them be that similar."""
    same, x, y = x is y, x.alias("x"), y.alias("y")
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in on])
    m, n = F.col("x.n"), F.col("y.n")
    alike = (F.least(m, n) >= similarity * F.greatest(m, n)) & (F.col("x.text_key") < F.col("y.text_key") if same else F.col("x.text_key") != F.col("y.text_key"))
    if "root" in x.columns:
        alike = alike & (F.col("x.root") != F.col("y.root"))
    if "at" in x.columns:  # what can follow the first shingle in common
        rest = F.least(F.col("x.d") - F.col("x.at"), F.col("y.d") - F.col("y.at"))
        needed = (F.col("x.d") + F.col("y.d") - _differ(similarity) * (m + n)) / 2
        alike = alike & (rest >= needed - 1e-9)
    return met.where(alike).select(F.least("x.text_key", "y.text_key").alias("a"), F.greatest("x.text_key", "y.text_key").alias("b"))


def differences(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(lead, text_key, n, b, differ) of members (lead, text_key): both texts' numbers of shingles, and those in which
    they differ."""
    sets = sets_of(docs, materialise(members.select(F.explode(F.array("lead", "text_key")).alias("text_key")).distinct(), "apart"))
    own, lead = sets.select("text_key", F.col("held").alias("x")), sets.select(F.col("text_key").alias("lead"), F.col("held").alias("y"))
    both = members.join(own, "text_key").join(lead, "lead")
    return both.select("lead", "text_key", F.size("x").alias("n"), F.size("y").alias("b"), F.concat(F.array_except("x", "y"), F.array_except("y", "x")).alias("differ"))


def centred(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(lead, text_key) of groups (lead, text_key) with the central text of each group as its leader: the one that
    differs least from the shingles that more than half of the group's texts have."""
    both = materialise(differences(docs, members), "group-differences")
    each = both.select("lead", "text_key", F.explode("differ").alias("token"))
    usual = each.groupBy("lead", "token").agg(F.count("*").alias("f")).join(both.groupBy("lead").agg(F.count("*").alias("texts")), "lead").where("2 * f > texts")
    shared = each.join(usual.select("lead", "token"), ["lead", "token"], "left_semi").groupBy("lead", "text_key").agg(F.count("*").alias("usual"))
    unusual = F.struct((F.size("differ") - 2 * F.coalesce("usual", F.lit(0))).alias("d"), "text_key")
    central = both.join(shared, ["lead", "text_key"], "left").groupBy("lead").agg(F.min(unusual).alias("least")).select("lead", F.col("least.text_key").alias("central"))
    return members.join(central, "lead").where("central <> text_key").select(F.col("central").alias("lead"), "text_key").distinct()


def meetings(docs: DataFrame, members: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(lead, token, text_key, root, n, d, near, narrow, at): the shingles at which members (lead, text_key) meet, by
    what they differ in from their leader: two that may be that similar have one in common.

    Of two similar texts t and u, of n and m shingles, d and e of them (or of the leader's b) in D, at
    most c * (n + m) differ, c = (1 - similarity) / (1 + similarity). So they share (d + e - c * (n + m)) / 2 of
    D or more, which is d - c * n * (1 + 1 / similarity) at least, as m is n / similarity at most. Where u isn't
    similar to the leader, e is over c * (m + b), and they share more than (d + c * (b - n)) / 2."""
    both = differences(docs, members).join(roots, "text_key", "left").withColumn("root", F.coalesce("root", "text_key"))
    both = materialise(both.withColumn("d", F.size("differ")).where("d > 0"), "differences")
    n, b, d, c = F.col("n"), F.col("b"), F.col("d"), _differ(similarity)
    common = (n + b - d) / 2
    near = common >= similarity * (n + b - common)
    least = F.greatest(F.lit(1), F.ceil(d - c * n * (1 + 1 / similarity) - 1e-9))
    other = F.greatest(least, F.floor((d + c * (b - n)) / 2 - 1e-9) + 1)
    each = both.select("lead", "text_key", "root", "n", "d", near.alias("near"), (d - least + 1).cast("int").alias("wide"), (d - other + 1).cast("int").alias("narrow"), F.explode("differ").alias("token"))
    # where: names the texts that a token stands in, in 128 bits
    where = F.struct(*[F.bit_xor(F.xxhash64("text_key", F.lit(i))).alias(f"h{i}") for i in range(2)])
    common_ = each.groupBy("lead", "token").agg(F.count("*").alias("f"), where.alias("where")).where("f > 1")
    held = each.join(common_, ["lead", "token"], "left")
    held = held.groupBy("lead", "text_key", "root", "n", "d", "near", "wide", "narrow").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "where", "token"))).alias("order"))
    prefix = F.slice("order", F.lit(1), F.when(F.col("near"), F.col("narrow")).otherwise(F.col("wide")))
    held = held.withColumn("order", prefix).select("lead", "text_key", "root", "n", "d", "near", "narrow", "order", F.posexplode("order").alias("at", "o"))
    first = F.get("order", F.col("at") - 1)  # of the tokens of the same texts, which follow each other, the first one
    held = held.where((F.col("o.f") > 1) & ~F.coalesce(first["where"] == F.col("o.where"), F.lit(False)))
    return materialise(held.select("lead", F.col("o.token").alias("token"), "text_key", "root", "n", "d", "near", "narrow", "at"), "rarest")


def apart(docs: DataFrame, members: DataFrame, roots: DataFrame, found: DataFrame, similarity: float, pair_keys: int, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Links beside found, and pairs (a, b) that may be that similar, which make up the components of all links between
    members (lead, text_key) of the same leader, whose components so far are in roots; None without members. Fuller
    meetings of up to most pairs are compared as they are."""
    members = materialise(members, "members")
    if members.isEmpty():
        return found, None
    texts = materialise(asked(docs, members.select(F.explode(F.array("lead", "text_key")).alias("text_key")).distinct()), "apart-texts")
    texts = texts.select("text", F.lit(None).cast("long").alias("doc_id"))
    on, pairs = ["lead", "token"], None
    for k in range(1, ROUNDS + 1):
        members = materialise(centred(texts, members), "central")
        to_lead = members.select(F.least("lead", "text_key").alias("a"), F.greatest("lead", "text_key").alias("b")).distinct()
        found = found.union(verified(texts, materialise(to_lead, "candidates"), similarity))
        roots = materialise(components(found).withColumnRenamed("node", "text_key"), "roots")
        of = members.join(roots, "text_key", "left").withColumn("root", F.coalesce("root", "text_key"))
        split = of.groupBy("lead").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("lead")
        held = meetings(texts, materialise(members.join(split, "lead"), "members"), roots, similarity)
        other = F.min_by("text_key", F.xxhash64("text_key", F.lit(k))).alias("other")
        met = held.groupBy(*on).agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"), other).where("low < high").drop("low", "high")
        held = materialise(held.join(met, on), "meetings")
        full = held.where(F.col("size") > pair_keys)
        last = k == ROUNDS or (full.agg(F.sum(F.col("size") - 1)).first()[0] or 0) <= 2 * most
        few = held if last else held.where(F.col("size") <= pair_keys)
        far, strict = few.where("not near"), few.where("not near and at < narrow")
        own = _pairs(strict, strict, on, similarity).union(_pairs(few.where("near"), far, on, similarity))
        own = materialise(own.distinct(), "pairs-apart")
        pairs = own if pairs is None else pairs.union(own)
        if last:
            return found, pairs
        members = materialise(full.select(F.col("other").alias("lead"), "text_key").distinct(), "members")


def by_fingerprint(each: DataFrame) -> DataFrame:
    """(x, y) of texts (text_key, n, fp) as structs: each text and the leader of its fingerprint, and the leaders of
    linked fingerprints (operator 8's links)."""
    leaders = materialise(each.groupBy("fp").agg(F.min_by(F.struct("text_key", "n"), F.xxhash64("text_key")).alias("lead")), "fingerprint-leaders")
    same = each.join(leaders, "fp").select(F.struct("text_key", "n").alias("x"), F.col("lead").alias("y"))
    linked = simhash.links(leaders.select("fp"), DISTANCE)
    a, b = (leaders.select(F.col("fp").alias(side), F.col("lead").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    return same.union(linked.join(a, "a").join(b, "b").select("x", "y")).where("x.text_key <> y.text_key")


def links(docs: DataFrame, similarity: float = SIMILARITY, pair_keys: int = PAIR_KEYS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key) of each document row, and links (a, b) between text keys that make up the same
    components as all links of texts with a common key do."""

    def work(text: bytes | None) -> np.ndarray:
        found = simhash.hashes(text, SHINGLE)
        own = np.unique(found)
        return np.append(band_keys(own), np.array([len(own), simhash.majority(found)], np.uint64))

    rows = materialise(_mapped(_texts(docs), work, ["doc_id", "text_key"], "doc_id long, text_key binary"), "bands")
    each = rows.groupBy("text_key").agg(F.first("held").alias("held"))
    each = materialise(each.select("text_key", F.element_at("held", BANDS + 1).alias("n"), F.element_at("held", BANDS + 2).alias("fp"), F.slice("held", 1, BANDS).alias("held")), "texts")
    index = each.select("text_key", "n", F.explode("held").alias("key")).repartition("key")
    full = index.groupBy("key").agg(F.count("*").alias("size"), F.min_by(F.struct("text_key", "n"), F.xxhash64("text_key")).alias("lead")).where("size > 1")
    shared = materialise(index.join(full, "key").select("key", "text_key", "n", "size", "lead"), "shared-bands")

    # each text with the leaders of its keys
    to_lead = by_fingerprint(each).union(shared.select(F.struct("text_key", "n"), "lead").where("text_key <> lead.text_key").toDF("x", "y"))
    to_lead = to_lead.where(F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n")).select(F.least("x.text_key", "y.text_key").alias("a"), F.greatest("x.text_key", "y.text_key").alias("b")).distinct()
    found = verified(docs, materialise(to_lead, "candidates"), similarity)

    # and with each other, where a key still has more than one component
    roots = materialise(components(found).withColumnRenamed("node", "text_key"), "roots")
    left = shared.where("size > 2").join(roots, "text_key", "left").withColumn("root", F.coalesce("root", "text_key"))
    split = left.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    left = materialise(left.join(split, "key").where("lead.text_key <> text_key"), "apart-bands")
    few = left.where(F.col("size") <= pair_keys).select("key", "text_key", "n", "root")
    pairs = _pairs(few, few, ["key"], similarity)
    members = left.where(F.col("size") > pair_keys).select(F.col("lead.text_key").alias("lead"), "text_key").distinct()
    found, more = apart(docs, members, roots, found, similarity, pair_keys, PAIRS_A_TEXT * each.count())
    pairs = pairs if more is None else pairs.union(more)
    found = found.union(verified(docs, materialise(pairs.distinct(), "candidates"), similarity))
    return rows.select("doc_id", "text_key"), found


def grouped(docs: DataFrame, similarity: float = SIMILARITY, pair_keys: int = PAIR_KEYS) -> DataFrame:
    """(doc_id, text_key, root) of each document row; root names the component by its smallest text key. Both keys are
    MD5 in hexadecimal digits."""
    rows, found = links(docs, similarity, pair_keys)
    every = rows.join(components(found).withColumnRenamed("node", "text_key"), "text_key", "left")
    return every.select("doc_id", *[F.lower(F.hex(c)).alias(n) for c, n in (("text_key", "text_key"), (F.coalesce("root", "text_key"), "root"))])
