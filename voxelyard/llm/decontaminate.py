"""Benchmark decontamination by a prefix-filtered join of word shingles.

A benchmark item is contained in a document where a window of it, ``WINDOW`` consecutive words (an
item of fewer words is one window), stands in the document.  A window is a set of shingles of
``SHINGLE`` words with their positions; the whole window must be there, so of its shingles, ordered
by rarity, the first one is the necessary prefix: a document without it can't hold the window.

1. All documents are read for the counts of the benchmark's shingles in the corpus.
2. Each window's rarest shingle is its prefix token.  Documents are read again, and only places with a
   prefix token become candidates; they join the windows by the token's hash.
3. Positional and length bounds: the token's place in the window fixes where the window would start
   and end; it must lie within the document.  Then the words themselves are compared, so hashes
   decide nothing.

In both passes a bitmap of a fixed size keeps other shingles from leaving the task; its false hits
fall out in the joins.  Nothing else that grows with the data is sent to executors, but for windows
up to ``BROADCAST_WINDOWS``, counted before; beyond that the join shuffles.

Defined cases: null and empty texts have no words and are clean; an item without words has no windows;
items with equal texts each count; null items' ids are left out of ``item_ids``; repeated rows and
repeated or null document ids are judged row by row; an empty benchmark leaves all documents clean;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, column, materialise, sieve, table
from .tokens import blocks, released

WINDOW, SHINGLE = 10, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows that may be broadcast: some 200 bytes each.
BROADCAST_WINDOWS = 100_000
#: Bits of the bitmap by window: at least, at most 2 to the power of.
BITS = (20, 27)
#: Bytes that a task works on at a time; below a power of two, as the table of powers is.
BLOCK = 250_000

_IS_WORD = np.ones(256, bool)
_IS_WORD[0x00:0x30] = _IS_WORD[0x3A:0x61] = _IS_WORD[0x7B:0x80] = False
_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        _POWERS[:] = [np.multiply.accumulate(np.array([1] + [b] * (size - 1), np.uint64)) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


class Words:
    """The words of a block of binary texts: start and end bytes, text of each, 64-bit hashes."""

    def __init__(self, texts: list[bytes | None]):
        self.block = b"\n".join([t or b"" for t in texts]).lower() + b"\n"
        raw = np.frombuffer(self.block, np.uint8)
        inside = np.concatenate([[False], _IS_WORD[raw]])
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = turns[0::2], turns[1::2]
        bounds = np.cumsum([len(t or b"") + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(self.start, bounds)])  # of each text
        power, inverse = _powers(len(raw) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[raw] * power[: len(raw)])])
        h = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = h ^ (h >> np.uint64(29))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash, and first word, of each shingle that lies in one text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = (h ^ self.hash[k : k + n]) * np.uint64(_STEP)
            h ^= h >> np.uint64(32)
        text = np.searchsorted(self.first, np.arange(n), side="right") - 1
        whole = np.arange(n) + size <= self.first[text + 1]
        return h.view(np.int64)[whole], np.flatnonzero(whole)

    def word(self, i: int) -> str:
        return self.block[self.start[i] : self.end[i]].decode("utf-8", "replace")


def bitmap(hashes: DataFrame, column_name: str, n: int):
    """A broadcast bitmap of the hashes: 64 bits for each, within fixed bounds of its size."""
    bits = min(BITS[1], max(BITS[0], int(max(1, 64 * n) - 1).bit_length()))
    slot = F.shiftrightunsigned(column_name, 64 - bits)
    rows = hashes.select(slot.alias("s")).groupBy(F.expr("s div 32768").alias("b")).agg(F.bitmap_construct_agg(F.expr("cast(s % 32768 as bigint)")).alias("m")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, m in rows:
        out[b * 4096 : (b + 1) * 4096] = np.frombuffer(m, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast((bits, out))


def _held(found, hashes: np.ndarray) -> np.ndarray:
    bits, marks = found
    slot = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (marks[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, words) of all windows. Benchmark texts are split by SQL, the documents by numpy."""
    words = F.regexp_extract_all(F.coalesce(ascii_lower(column(items, "text", "string")), F.lit("")), F.lit(WORD), F.lit(0))
    rows = items.select(column(items, "item_id", "string").alias("item_id"), words.alias("w")).where(F.size("w") > 0)
    at = F.expr(f"sequence(0, greatest(size(w) - {WINDOW}, 0))")
    return rows.select("item_id", F.explode(F.transform(at, lambda i: F.slice("w", i + 1, WINDOW))).alias("words"))


def _window_shingles(windows: DataFrame) -> DataFrame:
    """(words, size, p, h): every shingle of every distinct window."""

    def work(batches):
        for batch in batches:
            out = [[], [], [], []]
            for words in batch.column(0).to_pylist():
                own, size = Words([" ".join(words).encode()]), min(SHINGLE, len(words))
                for h, p in zip(*(x.tolist() for x in own.shingles(size))):
                    for c, v in zip(out, (words, size, p, h)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.list_(pa.string())), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int64())], ["words", "size", "p", "h"])

    return windows.select("words").distinct().mapInArrow(work, "words array<string>, size int, p int, h long")


def _counts(texts: DataFrame, sizes: list[int], found) -> DataFrame:
    def work(batches):
        for batch in batches:
            for _, _, own in blocks(batch.column(0), BLOCK):
                words = Words(own)
                for size in sizes:
                    h, _ = words.shingles(size)
                    seen, n = np.unique(h[_held(found.value, h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), size, np.int32)), pa.array(seen), pa.array(n)], ["size", "h", "n"])

    return texts.select("text").mapInArrow(released(work), "size int, h long, n long").groupBy("size", "h").agg(F.sum("n").alias("n"))


def _candidates(texts: DataFrame, sizes: list[int], found) -> DataFrame:
    """A row per document: row id, doc_id, key of the text, number of words, places of prefix tokens."""
    around = WINDOW - 1

    def work(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        place = pa.struct([("size", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("from", pa.int32()), ("near", pa.list_(pa.string()))])
        for batch in batches:
            doc_ids, keys = (batch.column(k).to_pylist() for k in range(2))
            for i, j, own in blocks(batch.column(2), BLOCK):
                words = Words(own)
                places: list[list] = [[] for _ in range(i, j)]
                for size in sizes:
                    h, at = words.shingles(size)
                    for k in np.flatnonzero(_held(found.value, h)).tolist() if len(h) else []:
                        t = int(np.searchsorted(words.first, at[k], side="right")) - 1
                        first, last = int(words.first[t]), int(words.first[t + 1])
                        a, b = max(first, int(at[k]) - around), min(last, int(at[k]) + WINDOW)
                        places[t].append({"size": size, "h": int(h[k]), "at": int(at[k]) - first, "from": a - first, "near": [words.word(x) for x in range(a, b)]})
                yield pa.RecordBatch.from_arrays([pa.array(range(row, row + j - i), pa.int64()), pa.array(doc_ids[i:j], pa.int64()), pa.array(keys[i:j], pa.string()), pa.array(np.diff(words.first)), pa.array(places, pa.list_(place))], ["row", "doc_id", "text_key", "n_words", "places"])
                row += j - i

    return texts.select("doc_id", "text_key", "text").mapInArrow(released(work), "row long, doc_id long, text_key string, n_words long, places array<struct<size:int,h:long,at:int,`from`:int,near:array<string>>>")


def decontaminate(docs: DataFrame, items: DataFrame, keep_key: bool = False) -> DataFrame:
    """A row per document row: doc_id, n_words, n_hit, item_ids (sorted strings), contaminated; with
    keep_key also text_key, the md5 of the text, by which a filter finds the documents again."""
    spark = docs.sparkSession
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), (F.md5(text) if keep_key else F.lit(None).cast("string")).alias("text_key"), text.cast("binary").alias("text"))

    windows = materialise(item_windows(items), "windows")
    shingles = materialise(_window_shingles(windows), "shingles")
    sizes = [r[0] for r in shingles.select("size").distinct().collect()]  # at most SHINGLE sizes
    n_windows = shingles.where("p = 0").count()
    counts = _counts(texts, sizes, bitmap(shingles, "h", shingles.count()))
    ranked = shingles.join(counts, ["size", "h"], "left").groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "p", "size")).alias("x"))
    prefixes = materialise(ranked.select("words", "x.h", "x.p", "x.size"), "prefixes")

    rows = materialise(_candidates(texts, sizes, bitmap(prefixes, "h", n_windows)), "candidates")
    places = rows.select("row", "n_words", F.explode("places").alias("c")).select("row", "n_words", "c.*")
    known = F.broadcast(prefixes) if n_windows <= BROADCAST_WINDOWS else prefixes
    begin = F.col("at") - F.col("p")
    length = F.size("words")
    hits = places.join(known, ["size", "h"]).where((begin >= 0) & (begin + length <= F.col("n_words")) & (begin >= F.col("from")))
    hits = hits.where(F.slice("near", begin - F.col("from") + 1, length) == F.col("words")).select("row", begin.alias("start"), (begin + length).alias("stop"), "words")
    hits = materialise(hits, "hits")

    merged = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "stop"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct((a.n + F.greatest(s.stop - F.greatest(s.start, a.reach), F.lit(0))).alias("n"), F.greatest(a.reach, s.stop).alias("reach")),
    ).n
    covered = hits.groupBy("row").agg(merged.alias("n_hit"))
    own = windows.distinct()
    own = F.broadcast(own) if n_windows <= BROADCAST_WINDOWS and windows.count() <= BROADCAST_WINDOWS else own
    items_ = hits.select("row", "words").distinct().join(own, "words").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    out = rows.select("row", "doc_id", "text_key", "n_words").join(covered, "row", "left").join(items_, "row", "left")
    return out.select(
        "doc_id", *(["text_key"] if keep_key else []), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table against every item."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of an item, with their own columns. Of the texts, those alone move that
    have the id of one that goes."""
    bad = materialise(decontaminate(docs, items, keep_key=True).where("contaminated").select("doc_id", "text_key").distinct(), "contaminated")
    may, others = sieve(docs, F.xxhash64(column(docs, "doc_id", "long")), bad.select(F.xxhash64("doc_id")))
    bad = bad.select("text_key").distinct()
    return others.union(may.join(bad, F.md5(F.coalesce(column(may, "text", "string"), F.lit(""))) == bad.text_key, "left_anti"))


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + {WINDOW} - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT dw.doc_id, dw.i, dw.n, win.item_id FROM dw JOIN win ON dw.s = win.s AND dw.n = win.n
), cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)
"""
