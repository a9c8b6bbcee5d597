"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The model's units are UTF-8 bytes, so any language and any junk has a finite perplexity, and an n-gram
of up to ``ORDER`` bytes is exactly one 64-bit integer.

1. n-grams of all trusted documents (label quality 1) but for a held-out part are counted, merged per
   block before the shuffle.
2. Count joins, sharded by n-gram: lower orders count distinct left neighbours, discounts come from the
   counts of counts, and each order's probabilities join those of the order below.
3. Every document is scored once: log probability per byte, shrunk to the language's mean for short texts
   (``SHRINK`` bytes of the mean are added), as a perplexity.
4. A document stays if its perplexity lies between two quantiles of its language: the lower one of
   all trusted documents, the upper one of those held out, which the model hasn't seen, each moved out
   by one standard error.  Text that is too surprising is junk, text that is too predictable repeats
   itself.

The model's logarithms are whole numbers (``SCALE`` to the unit), so sums don't depend on their order.
A model of up to ``MODEL_ROWS`` rows, counted before, is replicated to the tasks, twelve bytes a row and
an index.  A larger one is cut into parts of about that size, by the two bytes before an n-gram's last, and the texts
are read once a part (``by_parts``), so what is written are a few numbers of each text and part; one of more than
``PARTS`` parts is joined by n-gram (``by_join``).  All give the same numbers to the last digit.

Defined cases: null and empty texts have no bytes and the language's mean perplexity, and stay;
a language's thresholds are widened toward those of all the more, the fewer held-out documents it has
(``widened``), and a language without any, or null, takes those of all; without any trusted text the perplexity is null and all stay; labels of a document that contradict each other count
as not trusted; a perplexity that equals a threshold stays; repeated rows are scored each; a text of any
length is worked on in blocks; an empty table gives no rows; other columns are kept by
``good_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import column, materialise, sieve, table
from .tokens import blocks, released

ORDER = 6
#: Quantiles of the trusted documents' perplexity between which documents stay.
LOW, HIGH = 0.001, 0.995
#: Bins of a unit of the log perplexity, in which quantiles are counted.
BINS = 1000
#: Parts of a unit in which the model's natural logarithms are rounded.
SCALE = 1 << 20
#: Bytes of the language's mean that each document's score is mixed with.
SHRINK = 100
#: One trusted document in so many is held out of training, by a hash of its text, so that the upper
#: quantile is one of texts that the model has not seen.
HELD_OUT = 4
#: Held-out documents at which a language's own thresholds weigh as much as those of all languages.
PRIOR = 8
#: Rows of n-grams and contexts that may be replicated at once.
MODEL_ROWS = 3_000_000
#: Parts of a model that may be replicated one after another.
PARTS = 32
#: Values of the two bytes before an n-gram's last one, which all that its score looks up has in common.
PAIRS = 1 << 16
#: Labels, and languages, that may be broadcast.
BROADCAST_LABELS, BROADCAST_LANGUAGES = 1_000_000, 10_000
#: Bytes that a task works on at a time.
BLOCK = 1 << 18
#: Stands before a text, in the place of the bytes that the first n-grams lack.
START = b"\x02" * (ORDER - 1)


def _codes(line: bytes) -> np.ndarray:
    """The n-gram that ends at each byte but the first ORDER - 1, as a number."""
    raw = np.frombuffer(line, np.uint8)
    n = max(len(raw) - ORDER + 1, 0)
    code = np.zeros(n, np.int64)
    for k in range(ORDER):
        code <<= 8
        code |= raw[k : k + n]
    return code


def _pieces(texts: pa.Array):
    """(n-grams, lengths, whether the last text goes on in the next piece) of a column of texts, of about
    BLOCK bytes each; longer texts are cut."""
    for _, _, part in blocks(texts, BLOCK):
        part = [t or b"" for t in part]
        if len(part) == 1 and len(part[0]) > BLOCK:
            line = START + part[0]
            for i in range(0, len(part[0]), BLOCK):
                code = _codes(line[i : i + BLOCK + ORDER - 1])
                yield code, np.array([len(code)]), i + BLOCK < len(part[0])
            continue
        length = np.array([len(t) for t in part], np.int64)
        code = _codes(b"".join(START + t for t in part))
        inside = np.ones(len(code), bool)  # but for n-grams that end in the start marks of a text
        for end in (np.cumsum(length + len(START))[:-1]).tolist():
            inside[end - len(START) : end] = False
        yield code[inside], length, False


# ---- training -------------------------------------------------------------------------------------
def count_ngrams(docs: DataFrame) -> DataFrame:
    """(code, n) of all n-grams of the highest order."""

    def work(batches):
        for batch in batches:
            for own, _, _ in _pieces(batch.column(0)):
                code, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    texts = docs.select(column(docs, "text", "string").cast("binary").alias("text"))
    return texts.mapInArrow(released(work), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> list[float]:
    """Discounts of n-grams seen once, twice, and more often; zero for none."""
    n = grams.agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).first()
    if not all(n):  # too little text for the formulas
        return [0.0, 0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))]


def train(docs: DataFrame) -> DataFrame:
    """The model: (level, code, value). At level k are the log probabilities of the k-byte n-grams, at
    level -k the log weights that a context of k bytes leaves to the order below, in parts of SCALE."""
    counts = {ORDER: materialise(count_ngrams(docs), "ngrams")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))
        counts[k] = materialise(counts[k + 1].select(suffix.alias("code")).groupBy("code").agg(F.count("*").alias("n")), f"ngrams{k}")
    out = below = None
    for k in range(1, ORDER + 1):
        d = _discounts(counts[k])
        grams = counts[k].withColumn("d", F.element_at(F.array(*map(F.lit, d)), F.least(F.col("n"), F.lit(3)).cast("int") + 1)).withColumn("context", F.shiftright("code", 8))
        # whole numbers are summed, whose order doesn't matter
        seen = [F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)]
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), sum((c * x for c, x in zip(seen, d[1:])), F.lit(0.0)).alias("left"))
        rows = grams.join(contexts, "context")
        weight = F.col("left") / F.col("total")
        if k == 1:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        else:
            rows = rows.withColumn("suffix", F.col("code").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below.select(F.col("code").alias("suffix"), F.col("p").alias("lower")), "suffix")
        below = materialise(rows.select("code", ((F.col("n") - F.col("d")) / F.col("total") + weight * F.col("lower")).alias("p")), f"p{k}")
        whole = lambda x: F.round(F.log(x) * SCALE).cast("int").alias("value")
        level = below.select(F.lit(k).alias("level"), "code", whole(F.col("p")))
        level = level.union(contexts.select(F.lit(1 - k).alias("level"), F.col("context").alias("code"), whole(weight)))
        out = level if out is None else out.union(level)
    return materialise(out, "model")


# ---- scoring --------------------------------------------------------------------------------------
class Lookup:
    """Numbers to values. Each layer is a table of places in the arrays; what collides is in the next one,
    so an empty slot tells that a number is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values, self.layers = keys, values, []
        left = np.arange(len(keys), dtype=np.int32)
        while len(left) or not self.layers:
            bits = max(4, int(2 * len(left)).bit_length())
            slot = self._slot(keys[left], bits, len(self.layers))
            own = np.full(1 << bits, -1, np.int32)
            own[slot] = left  # the last one stays
            self.layers.append((bits, own))
            left = left[own[slot] != left]

    @staticmethod
    def _slot(keys: np.ndarray, bits: int, layer: int) -> np.ndarray:
        odd = np.uint64((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC4CEB9FE1A85EC53)[layer % 3])
        return ((keys.view(np.uint64) * odd) >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the places of the numbers that are missing."""
        out, found = np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
        if not len(self.keys):
            return out, np.arange(len(asked))
        left, at = None, asked
        for layer, (bits, own) in enumerate(self.layers):
            place = own[self._slot(at, bits, layer)]
            hit = self.keys[place] == at  # place -1, an empty slot, is the last key: never by mistake
            hits = np.flatnonzero(hit) if left is None else left[hit]
            out[hits], found[hits] = self.values[place[hit]], True
            on = ~hit & (place >= 0)
            left, at = np.flatnonzero(on) if left is None else left[on], at[on]
            if not len(at):
                break
        return out, np.flatnonzero(~found)


#: What an unknown byte's even chance of 1 in 256 is.
EVEN = -round(float(np.log(256)) * SCALE)


def log_probabilities(code: np.ndarray, model: dict[int, Lookup]) -> np.ndarray:
    """Logarithm, in parts of SCALE, of each n-gram's last byte, given those before it."""
    out, at = np.zeros(len(code), np.int64), np.arange(len(code))
    for k in range(ORDER, 0, -1):
        own = code[at] & ((1 << 8 * k) - 1)
        found, missing = model[k].get(own)
        out[at] += found
        at, own = at[missing], own[missing]
        if not len(at):
            return out
        out[at] += model[1 - k].get(own >> 8)[0]  # an unseen context leaves all to the order below
    out[at] += EVEN
    return out


def score(docs: DataFrame, model: DataFrame, replicate: bool) -> DataFrame:
    """The columns of docs but text (binary), and n_bytes and log_sum, in parts of SCALE, of the text."""
    return looked_up(docs, model) if replicate else by_join(docs, model)


def looked_up(docs: DataFrame, model: DataFrame, low: int = 0, high: int = PAIRS, sent: list | None = None) -> DataFrame:
    """The same by a replicated model. With bounds, by that part of it alone: of the n-grams whose two bytes before the
    last are from low to below high. What is broadcast is added to sent."""
    names = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.drop("text").dtypes)
    whole = (low, high) == (0, PAIRS)
    if not whole:
        model = model.where(_pair().isNull() | _pair().between(low, high - 1))
    held = {}
    for k in range(1 - ORDER, ORDER + 1):  # one at a time, so that the driver holds no second copy of all
        rows = model.where(F.col("level") == k).select("code", "value").toArrow()
        held[k] = rows.column("code").to_numpy(), rows.column("value").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(held)
    if sent is not None:
        sent.append(shared)

    def work(batches):
        tables = {k: Lookup(*x) for k, x in shared.value.items()}
        for batch in batches:
            sums, lengths, more = [], [], False
            for code, length, goes_on in _pieces(batch.column("text")):
                each = np.zeros(len(code) + 1, np.int64)
                if whole:
                    each[:-1] = log_probabilities(code, tables)
                else:
                    pair = code >> 8 & PAIRS - 1
                    own = np.flatnonzero((pair >= low) & (pair < high))
                    each[own] = log_probabilities(code[own], tables)
                found = np.where(length > 0, np.add.reduceat(each, np.cumsum(length) - length), 0)
                if more:
                    sums[-1] += found
                    lengths[-1] += length
                else:
                    sums.append(found)
                    lengths.append(length)
                more = goes_on
            totals = [pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in (lengths, sums)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *totals], [*names, "n_bytes", "log_sum"])

    return docs.select(*names, "text").mapInArrow(released(work), f"{kinds}, n_bytes long, log_sum long")


def _pair():
    """The two bytes before the last of a model's n-grams, or the last two of its contexts; null for shorter ones, which
    all parts have."""
    level, code = F.col("level"), F.col("code")
    return F.when(level >= 3, F.shiftright(code, 8).bitwiseAND(F.lit(PAIRS - 1))).when(level <= -2, code.bitwiseAND(F.lit(PAIRS - 1)))


def parts_of(model: DataFrame, rows: int) -> list[tuple[int, int]]:
    """Bounds of pairs that cut the model into parts of up to rows rows and a pair's."""
    found = model.where(_pair().isNotNull()).groupBy(_pair().alias("pair")).agg(F.count("*").alias("n")).toArrow()  # PAIRS rows at most
    n = np.zeros(PAIRS, np.int64)
    n[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    cuts = np.flatnonzero(np.diff((np.cumsum(n) - n) // rows)) + 1
    ends = [0, *cuts.tolist(), PAIRS]
    return [*zip(ends, ends[1:])]


def by_parts(docs: DataFrame, model: DataFrame, rows: int) -> DataFrame:
    """The same by a replicated model, a part after another; equal texts have equal sums."""
    key = F.unhex(F.md5(F.coalesce("text", F.lit(b"")))).alias("text_")
    texts, found = docs.select(key, "text"), []
    for k, (low, high) in enumerate(parts_of(model, rows)):
        sent: list = []
        own = looked_up(texts, model, low, high, sent)
        found.append(materialise(own.withColumn("part", F.lit(k)), f"scores{k}"))
        sent.pop().destroy()
    every = found[0]
    for own in found[1:]:
        every = every.union(own)
    each = [F.max(F.when(F.col("part") == k, F.col("log_sum"))) for k in range(len(found))]
    sums = every.groupBy("text_").agg(F.max("n_bytes").alias("n_bytes"), sum(each[1:], each[0]).alias("log_sum"))
    return docs.withColumn("text_", key).drop("text").join(sums, "text_").drop("text_")


def by_join(docs: DataFrame, model: DataFrame) -> DataFrame:
    """The same by joins: distinct n-grams look up their probability order by order, and documents join
    their counts of n-grams."""
    names = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{n}` {t}" for n, t in docs.drop("text").dtypes)

    def work(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            codes, counts, sizes, more = [], [], [], False
            for code, length, goes_on in _pieces(batch.column("text")):
                ends = np.cumsum(length)
                for a, b in zip((ends - length).tolist(), ends.tolist()):
                    own, n = np.unique(code[a:b], return_counts=True)
                    if more:  # a long text's n-grams may be listed once a piece
                        codes[-1], counts[-1], sizes[-1] = np.append(codes[-1], own), np.append(counts[-1], n), sizes[-1] + b - a
                    else:
                        codes.append(own)
                        counts.append(n)
                        sizes.append(b - a)
                    more = False
                more = goes_on
            starts = pa.array(np.cumsum([0, *map(len, codes)]), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate(x or [np.zeros(0, np.int64)]), pa.int64())) for x in (codes, counts)]
            row = pa.array(np.arange(first, first + len(sizes)), pa.int64())
            first += len(sizes)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], row, pa.array(sizes, pa.int64()), *lists], [*names, "row_", "n_bytes", "codes_", "counts_"])

    rows = docs.select(*names, "text").mapInArrow(released(work), f"{kinds}, row_ long, n_bytes long, codes_ array<long>, counts_ array<long>")
    rows = materialise(rows, "document-ngrams")
    each = rows.select("row_", F.explode(F.arrays_zip("codes_", "counts_")).alias("g")).select("row_", F.col("g.codes_").alias("code"), F.col("g.counts_").alias("n"))
    asked = each.select("code").distinct().withColumns({"sum": F.lit(0).cast("long"), "done": F.lit(False)})
    for k in range(ORDER, 0, -1):
        own = F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))
        p = model.where(F.col("level") == k).select(F.col("code").alias("g"), F.col("value").alias("p"))
        w = model.where(F.col("level") == 1 - k).select(F.col("code").alias("c"), F.col("value").alias("w"))
        asked = asked.join(p, own == p.g, "left").join(w, F.shiftright(own, 8) == w.c, "left")
        step = F.when(F.col("done"), 0).otherwise(F.coalesce("p", "w", F.lit(0)))
        asked = asked.select("code", (F.col("sum") + step).alias("sum"), (F.col("done") | F.col("p").isNotNull()).alias("done"))
    known = asked.select("code", (F.col("sum") + F.when(F.col("done"), 0).otherwise(EVEN)).alias("log_p"))
    sums = each.join(known, "code").groupBy("row_").agg(F.sum(F.col("n") * F.col("log_p")).alias("log_sum"))
    return rows.join(sums, "row_", "left").select(*names, "n_bytes", F.coalesce("log_sum", F.lit(0)).cast("long").alias("log_sum"))


def quantile(bins: DataFrame, key: list[str], q: float) -> DataFrame:
    """The bin (of key, bin, n) up to which q of all lie. Bins merge in any order to the same counts, and
    there are only so many of them."""
    whole = bins.groupBy(*key, "bin").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy(*key).orderBy("bin"))
    rows = whole.withColumn("so_far", so_far).withColumn("all", F.sum("n").over(Window.partitionBy(*key)))
    return rows.where(F.col("so_far") >= q * F.col("all")).groupBy(*key).agg(F.min("bin").alias("bin"))


# ---- classifying ----------------------------------------------------------------------------------
def limits_of(bins: DataFrame, key: list[str]) -> DataFrame:
    """(key, n, low, high) from counts of log perplexities (key, held, bin, n): quantiles, moved out by
    the standard error of the held-out ones. Sums are of whole numbers."""
    b = F.when(F.col("held"), F.col("bin").cast("decimal(38,0)"))
    n = F.when(F.col("held"), F.col("n"))
    sums = bins.groupBy(*key).agg(F.sum(n).alias("n"), F.sum(b * n).cast("double").alias("s"), F.sum(b * b * n).cast("double").alias("ss"))
    error = F.sqrt(F.greatest(F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), F.lit(2)), F.lit(0.0)) / F.col("n"))
    low, high = quantile(bins, key, LOW).withColumnRenamed("bin", "low_bin"), quantile(bins.where("held"), key, HIGH).withColumnRenamed("bin", "high_bin")
    both = sums.where("n > 0").join(low, key).join(high, key)
    return both.select(*key, "n", F.exp((F.col("low_bin") - error) / BINS).alias("low"), F.exp((F.col("high_bin") + 1 + error) / BINS).alias("high"))


def widened(own: DataFrame, low: float, high: float) -> DataFrame:
    """(lang, low, high): a language's own limits moved toward those of all languages, by n against PRIOR, where
    that moves them out. No number of documents switches between the two."""
    share = F.col("n") / (F.col("n") + PRIOR)
    mixed = lambda c, of_all: F.exp(share * F.log(c) + (1 - share) * F.log(F.lit(of_all)))
    return own.select("lang", F.least("low", mixed("low", low)).alias("low"), F.greatest("high", mixed("high", high)).alias("high"))


def judge(docs: DataFrame, labels: DataFrame, replicate: bool | None = None) -> DataFrame:
    """doc_id, lang, text_key (the MD5 of the text), n_bytes, log_prob, perplexity, low, high, keep of each
    row."""
    text = column(docs, "text", "string")
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "lang", "string").alias("lang"), F.md5(F.coalesce(text, F.lit(""))).alias("text_key"), (F.pmod(F.xxhash64(text), F.lit(HELD_OUT)) == 0).alias("held"), text.cast("binary").alias("text"))
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("worst")).where("worst = 1").select("doc_id")
    good = materialise(good, "trusted")
    if good.count() <= BROADCAST_LABELS:
        good = F.broadcast(good)

    model = train(rows.join(good, "doc_id", "left_semi").where("not held").select("text"))
    n = model.count()
    if replicate is None and MODEL_ROWS < n <= PARTS * MODEL_ROWS:
        scored = by_parts(rows, model, MODEL_ROWS)
    else:
        scored = score(rows, model, n <= MODEL_ROWS if replicate is None else replicate)
    scored = materialise(scored, "scores")
    known = scored.join(good, "doc_id", "left_semi").where("n_bytes > 0").select("lang", "held", "n_bytes", "log_sum")
    mean = known.agg(F.try_divide(F.sum("log_sum"), F.sum("n_bytes")) / SCALE).first()[0]
    log_prob = (F.col("log_sum") / SCALE).alias("log_prob")
    if mean is None:
        blank = F.lit(None).cast("double")
        return scored.select("doc_id", "lang", "text_key", "n_bytes", blank.alias("log_prob"), blank.alias("perplexity"), blank.alias("low"), blank.alias("high"), F.lit(True).alias("keep"))
    means = known.where("lang is not null").groupBy("lang").agg((F.sum("log_sum") / F.sum("n_bytes") / SCALE).alias("mean"))
    means = materialise(means, "means")
    small = F.broadcast if means.count() <= BROADCAST_LANGUAGES else (lambda df: df)

    def with_perplexity(df: DataFrame, by_lang: DataFrame) -> DataFrame:
        mixed = (F.col("log_sum") / SCALE + SHRINK * F.coalesce("mean", F.lit(mean))) / (F.col("n_bytes") + SHRINK)
        return df.join(small(by_lang), "lang", "left").withColumn("perplexity", F.exp(-mixed))

    bins = with_perplexity(known, means).groupBy("lang", "held", F.floor(F.log("perplexity") * BINS).alias("bin")).agg(F.count("*").alias("n"))
    bins = materialise(bins, "trusted-bins")
    overall = limits_of(bins.withColumn("whole", F.lit("all")), ["whole"]).first()
    low, high = (overall["low"], overall["high"]) if overall else (0.0, float("inf"))
    limits = materialise(means.join(widened(limits_of(bins, ["lang"]), low, high), "lang", "left"), "limits")
    out = with_perplexity(scored, limits).withColumns({"low": F.coalesce("low", F.lit(low)), "high": F.coalesce("high", F.lit(high))})
    keep = F.col("perplexity").between(F.col("low"), F.col("high")) | (F.col("n_bytes") == 0)
    return out.select("doc_id", "lang", "text_key", "n_bytes", log_prob, "perplexity", "low", "high", keep.alias("keep"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns. A verdict depends on language and text alone. Of the
    texts, those alone move that have the id of one that goes."""
    bad = materialise(judge(docs, labels).where("not keep").select("doc_id", F.col("lang").alias("bad_lang"), F.col("text_key").alias("bad_key")).distinct(), "rejected")
    may, others = sieve(docs, F.xxhash64(column(docs, "doc_id", "long")), bad.select(F.xxhash64("doc_id")))
    bad = bad.select("bad_lang", "bad_key").distinct()
    key = F.md5(F.coalesce(column(may, "text", "string"), F.lit("")))
    return others.union(may.join(bad, (key == bad.bad_key) & column(may, "lang", "string").eqNullSafe(bad.bad_lang), "left_anti"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table."""
    docs = table(spark, sf_dir, "documents")
    return judge(docs, table(spark, sf_dir, "labels")).drop("text_key").withColumn("log_prob", F.round("log_prob", 3))
