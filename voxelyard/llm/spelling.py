"""Spelling variants of frequent words: near words, the form that a word is a variant of, and the root of forms.

Words are near if they differ by one inserted, deleted or replaced code point.  Let a word's mask tell, for each
letter, whether it holds it an odd number of times.  One edit flips at most two bits of the mask, so of
three bands of bits, each with every third letter, one at least stays as it is.  One edit also leaves the first or the
last half of the shorter word as it is.  So words are indexed under each band with each half, near words share
a key, and what shares one is verified: at most two bits apart, then the edit distance.  Lengths that
differ by more than one never share a key.

Keys with more than ``HOT_KEY`` words have one side of their join dealt out over slices and the other side given
to each of them, so no task gets a key in whole.

Forms are followed by pointer doubling: n grows five-fold at each step, so few rounds end it.

Defined cases: null texts have no words; a null doc_id counts as an empty one; repeated rows are rows; a table
without frequent words gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, column, materialise, table
from .tokens import released

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: How many times as frequent as its variant a form is.
FORM_TIMES = 5
#: One run in so many has a code point deleted.
DELETED = 199
BANDS = 3
MASKS = [f"mask{b}" for b in range(BANDS)]
#: Code points beyond which a word is compared by halving.
LONG_WORD = 64
#: Words of a key beyond which its join is sliced, and hot keys beyond which their list isn't broadcast.
HOT_KEY, BROADCAST_KEYS = 2_048, 100_000


def frequent_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of whole texts that are long and frequent enough."""
    runs = docs.select(F.coalesce(column(docs, "doc_id", "long").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(column(docs, "text", "string"), F.lit(RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= least_length)
    low = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), ascii_lower(F.col("run"))).otherwise(F.col("run")).alias("run"))
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % DELETED == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def parities(word: str) -> list[int]:
    """For each band, the letters that the word holds an odd number of times, as bits."""
    bits = [0] * BANDS
    for letter, n in Counter(word).items():
        if n % 2:
            place = ord(letter) - 97 if letter < "\x80" else ord(letter) - 192 + 26
            bits[place % BANDS] |= 1 << place // BANDS
    return bits


def masked(words: DataFrame) -> DataFrame:
    """Words with their masks, one long a band."""

    def work(batches):
        for batch in batches:
            found = np.array([parities(w) for w in batch.column("word").to_pylist()], np.int64).reshape(-1, BANDS)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found.T)], ["word", "n", *MASKS])

    return words.select("word", "n").mapInArrow(released(work), "word string, n long, " + ", ".join(f"{m} long" for m in MASKS))


def index(words: DataFrame) -> DataFrame:
    """(key, longer, word, n, mask): a row for each band and half, as the shorter or equally long word of a pair
    and as the longer one."""
    masks = [F.col(m) for m in MASKS]
    out, n = [], F.length("word")
    for longer in (False, True):
        short = n - int(longer)
        half = F.floor(short / 2).cast("int")
        for side, part in enumerate((F.substring(F.col("word"), F.lit(1), half), F.substring(F.col("word"), n - half + 1, half))):
            out += [F.struct(F.xxhash64(F.lit(2 * b + side), mask, short, part).alias("key"), F.lit(longer).alias("longer")) for b, mask in enumerate(masks)]
    return masked(words).select("word", "n", F.array(*masks).alias("mask"), F.explode(F.array(*out)).alias("k")).select("k.*", "word", "n", "mask")


def one_edit(a: Column, b: Column) -> Column:
    """Whether b, as long as a or longer by one, is another word by one edit. Words of some length are parted where they
    first differ, found by halving, as the built-in distance takes time with the square of the length."""
    alike = lambda n: (n <= F.length(a)) & (F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n))
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    common = F.aggregate(steps, F.lit(0), lambda n, step: F.when(alike(n + step), n + step).otherwise(n))
    rest = F.length(b)
    parted = F.substring(a, common + 2 - (F.length(b) - F.length(a)), rest) == F.substring(b, common + 2, rest)
    return (a != b) & F.when(F.length(a) <= LONG_WORD, F.levenshtein(a, b, 1) == 1).otherwise(parted)


def near_pairs(words: DataFrame, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words once, with a the shorter or, of equal lengths, the smaller."""
    rows = materialise(index(words), "spelling-index")
    hot = materialise(rows.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > hot_key), "hot-keys")
    hot = hot.select("key", F.ceil(F.col("size") / hot_key).cast("int").alias("slices"))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot
    rows = rows.join(hot, "key", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    left = rows.where("not longer").withColumn("slice", F.pmod(F.xxhash64("word"), "slices").cast("int"))
    right = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    x, y = left.alias("x"), right.alias("y")
    flips = sum(F.bit_count(F.col("x.mask")[b].bitwiseXOR(F.col("y.mask")[b])) for b in range(BANDS))
    ordered = F.col("y.longer") | (F.col("x.word") < F.col("y.word"))
    near = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.slice") == F.col("y.slice")) & ordered & (flips <= 2) & one_edit(F.col("x.word"), F.col("y.word")))
    return near.select(F.col("x.word").alias("a"), F.col("x.n").alias("a_n"), F.col("y.word").alias("b"), F.col("y.n").alias("b_n")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word with a form: the last of its forms, by doubling the steps that a row stands for."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialise(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        now = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = FORM_TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each frequent word."""
    words = materialise(frequent_words(docs, least_length, least_count), "words")
    pairs = materialise(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).union(pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    known = words.join(best, "word", "left").withColumn("fits", -F.col("best.less") >= times * F.col("n"))
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("fits"), F.col("best.other")).alias("form"), F.when(F.col("fits"), -F.col("best.less")).alias("form_n"))
    known = materialise(known, "forms-of-words")
    found = known.join(roots(known.where("form is not null")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table."""
    return variants(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH lowered AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) AS run
    FROM documents),
runs AS (SELECT id, run, count(*) AS n FROM lowered WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(regexp_replace(hex(encode(id || ':' || run)), '(..)', '\\1 ', 'g'), ' ')[:-2],
        lambda b: [CAST('0x' || b AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END), 4294967295) AS h
    FROM runs),
cut AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
keyed AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word AS a, b.word AS b FROM keyed a JOIN keyed b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT k.word, w.word FROM keyed k JOIN words w ON k.rest = w.word
    UNION SELECT w.word, k.word FROM keyed k JOIN words w ON k.rest = w.word),
ranked AS (
    SELECT a AS word, b AS other, n AS other_n, count(*) OVER (PARTITION BY a) AS n_near,
           row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS r
    FROM pairs JOIN words ON b = words.word),
known AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
steps AS (
    WITH RECURSIVE s AS (
        SELECT word, word AS last_form, form AS next FROM known
        UNION ALL SELECT s.word, k.word, k.form FROM s JOIN known k ON s.next = k.word)
    SELECT word, last_form AS root FROM s WHERE next IS NULL)
SELECT word, form, root, n, n_near, form_n FROM known JOIN steps USING (word)
"""
