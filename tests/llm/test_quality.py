"""Operator 4 against the formulas in plain Python, and on held-out labels."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxelyard.llm import quality as q

N = q.ORDER


def grams(text):
    raw = q.START + (text or "").encode()
    return [raw[i : i + N] for i in range(len(raw) - N + 1)] if text else []


class Model:
    """Interpolated modified Kneser-Ney, straight from the formulas."""

    def __init__(self, texts):
        self.counts = {N: Counter(g for t in texts for g in grams(t))}
        for k in range(N - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.left = {}, defaultdict(float), defaultdict(float)
        for k, c in self.counts.items():
            n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1]) if all(n) else 0
            self.d[k] = [0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3))] if all(n) else [0, 0.5, 0.75, 0.9]
            for g, v in c.items():
                self.total[k, g[:-1]] += v
                self.left[k, g[:-1]] += self.d[k][min(v, 3)]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / 256
        below = self.p(g[1:])
        if not self.total[k, g[:-1]]:
            return below
        c = self.counts[k][g]
        return (max(c - self.d[k][min(c, 3)], 0) + self.left[k, g[:-1]] * below) / self.total[k, g[:-1]]

    def log_prob(self, text):
        return sum(math.log(self.p(g)) for g in grams(text))


TRAIN = ["the cat sat on the mat. " * 3, "a dog and a cat met é", "the end", "", None, "mat cat the " * 5]
ASK = ["the cat", "zzz!!", "", None, "é the mat \U0001F600", "dog " * 50]


def scored(spark, model, texts, replicate):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", F.col("text").cast("binary").alias("text"))
    return {r["i"]: (r["n_bytes"], r["log_sum"]) for r in q.score(rows, model, replicate).collect()}


@pytest.mark.parametrize("block", [q.BLOCK, 16])
def test_log_probabilities(spark, monkeypatch, block):
    monkeypatch.setattr(q, "BLOCK", block)  # of the driver's process: what follows is by the formulas' own code
    own = Model(TRAIN)
    lookups = {k: {} for k in range(1 - N, N + 1)}
    for k in own.counts:
        for g in own.counts[k]:
            lookups[k][int.from_bytes(g, "big")] = round(math.log(own.p(g)) * q.SCALE)
            c = g[:-1]
            lookups[1 - k][int.from_bytes(c, "big")] = round(math.log(own.left[k, c] / own.total[k, c]) * q.SCALE)
    tables = {}
    for k, d in lookups.items():
        keys = np.array(sorted(d), np.int64)
        tables[k] = q.Lookup(keys, np.array([d[x] for x in keys.tolist()], np.int32))
    texts = pa.array([None if t is None else t.encode() for t in ASK], pa.binary())
    total = sum(int(q.log_probabilities(code, tables).sum()) for code, _, _ in q._pieces(texts))
    assert sum(int(length.sum()) for _, length, _ in q._pieces(texts)) == sum(len((t or "").encode()) for t in ASK)
    assert total / q.SCALE == pytest.approx(sum(own.log_prob(t) for t in ASK), rel=1e-4)


@pytest.mark.parametrize("replicate", [True, False])
def test_scores(spark, replicate):
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string")
    model = q.train(train.select(F.col("text").cast("binary").alias("text")))
    got, own = scored(spark, model, ASK, replicate), Model(TRAIN)
    for i, t in enumerate(ASK):
        assert got[i][0] == len((t or "").encode()) and got[i][1] / q.SCALE == pytest.approx(own.log_prob(t), rel=1e-4, abs=1e-6)


def test_very_long_texts(spark):
    """Cut into blocks, a text scores as it does in one; both ways agree on it."""
    long = "the cat sat on the mat. é " * 60_000  # 1.6 MB, several blocks
    model = q.train(spark.createDataFrame([("the cat sat on the mat",), (long[:5000],)], "text string").select(F.col("text").cast("binary").alias("text")))
    texts = ["a", long, "", long[:300]]
    one, two = scored(spark, model, texts, True), scored(spark, model, texts, False)
    assert one == two and one[1][0] == len(long.encode())
    near = scored(spark, model, [long[:26_000]], True)[0]
    assert one[1][1] / one[1][0] == pytest.approx(near[1] / near[0], rel=0.01)


def test_probabilities_sum_to_one(spark):
    own = Model(TRAIN)
    for context in (b"the ", b"zzzz", b" cat", b"\x02\x02\x02\x02"):
        assert sum(own.p(context + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 40, 50_000))
    table = q.Lookup(keys, np.arange(len(keys), dtype=np.int32))
    values, missing = table.get(keys)
    assert not len(missing) and (values == np.arange(len(keys))).all()
    values, missing = table.get(np.array([-5, keys[3], 1 << 50, keys[-1]]))
    assert missing.tolist() == [0, 2] and values[[1, 3]].tolist() == [3, len(keys) - 1]
    assert q.Lookup(keys[:0], np.zeros(0, np.int32)).get(keys[:2])[1].tolist() == [0, 1]


def test_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(5, 1), (6, 1), (7, 1), (11, 1), (11, 0), (None, 1)], "doc_id long, quality int")
    rows = q.judge(odd, labels).collect()
    assert len(rows) == odd.count() and all(r["keep"] for r in rows if not r["n_bytes"])
    left = q.good_documents(odd, labels)
    assert left.columns == odd.columns and left.count() == sum(r["keep"] for r in rows)
    assert q.judge(none, labels).count() == 0
    blind = q.judge(odd, labels.limit(0)).collect()
    assert all(r["keep"] and r["perplexity"] is None for r in blind) and len(blind) == odd.count()


def test_both_ways_agree(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (sorted(tuple(r) for r in q.judge(docs, labels, replicate=way).drop("lang").collect()) for way in (True, False))
    assert one == two


def test_a_large_model_is_replicated_by_parts(spark, small, odd, monkeypatch):
    """A model over MODEL_ROWS doesn't make a row of each document and n-gram; the numbers stay the same."""
    labels = spark.read.parquet(f"{small}/labels.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs = docs.select("doc_id", "text", "lang").unionByName(odd.select("doc_id", "text", "lang"))
    one = sorted((repr(tuple(r)) for r in q.judge(docs, labels, replicate=True).collect()))
    monkeypatch.setattr(q, "MODEL_ROWS", 100)
    monkeypatch.setattr(q, "PARTS", 1 << 20)

    def refused(*_):
        raise AssertionError("joined")

    monkeypatch.setattr(q, "by_join", refused)
    cut, own = [], q.parts_of
    monkeypatch.setattr(q, "parts_of", lambda model, rows: cut.extend(own(model, model.count() // 3)) or cut)
    assert sorted(repr(tuple(r)) for r in q.judge(docs, labels).collect()) == one
    assert len(cut) > 2 and cut[0][0] == 0 and cut[-1][1] == q.PAIRS and all(a[1] == b[0] for a, b in zip(cut, cut[1:]))


def test_thresholds_are_inclusive(spark):
    """A document whose perplexity is the limit itself stays."""
    rows = [("a", True, 10, 1), ("a", True, 20, 1), ("a", False, 5, 1), ("b", True, 7, 400), ("b", False, 7, 1)]
    got = {r["lang"]: r for r in q.limits_of(spark.createDataFrame(rows, "lang string, held boolean, bin long, n long"), ["lang"]).collect()}
    assert got["b"]["n"] == 400 and got["b"]["low"] == pytest.approx(math.exp(7 / q.BINS)) and got["b"]["high"] == pytest.approx(math.exp(8 / q.BINS))
    error = 5 / math.sqrt(2)
    assert got["a"]["low"] == pytest.approx(math.exp((5 - error) / q.BINS)) and got["a"]["high"] == pytest.approx(math.exp((21 + error) / q.BINS))


def test_held_out_labels(spark):
    """Half of the labels train; on the other half clean documents stay and junk goes."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    known, hidden = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    rows = q.judge(spark.read.parquet(f"{d}/documents.parquet"), known).select("doc_id", "keep").join(hidden, "doc_id")
    got = {r["quality"]: r["keep"] for r in rows.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("keep")).collect()}
    print("clean and junk documents that stay:", got[1], got[0])
    assert got[1] > 0.985 and got[0] < 0.1


def test_six_bytes_tell_texts_apart(spark):
    """After five bytes the next one is known, after the last four it isn't."""
    train = spark.createDataFrame([("1abcdX " * 20 + "2abcdY " * 20,)], "text string").select(F.col("text").cast("binary").alias("text"))
    model = q.train(train)
    assert {r["level"] for r in model.select("level").distinct().collect()} == set(range(-5, 7))
    got = scored(spark, model, ["1abcdX", "1abcdY"], True)
    assert got[0][1] - got[1][1] > q.SCALE


def test_few_documents_widen_limits_smoothly(spark):
    """Limits move out only, by n against PRIOR, without a number at which they switch."""
    rows = [("few", 1, 4.0, 8.0), ("some", 8, 4.0, 8.0), ("many", 10_000, 4.0, 8.0), ("wide", 1, 1.0, 99.0)]
    got = {r["lang"]: r for r in q.widened(spark.createDataFrame(rows, "lang string, n long, low double, high double"), 2.0, 32.0).collect()}
    assert got["some"]["low"] == pytest.approx(8**0.5) and got["some"]["high"] == pytest.approx(16)
    assert got["few"]["high"] == pytest.approx(8 ** (1 / 9) * 32 ** (8 / 9)) and got["many"]["high"] == pytest.approx(8, rel=0.01)
    assert (got["wide"]["low"], got["wide"]["high"]) == (1.0, 99.0)
    ends = [(str(n), n, 4.0, 8.0) for n in range(1, 40)]
    highs = [r["high"] for r in q.widened(spark.createDataFrame(ends, "lang string, n long, low double, high double"), 2.0, 32.0).orderBy(F.col("lang").cast("int")).collect()]
    assert all(a > b for a, b in zip(highs, highs[1:]))
    nothing = q.widened(spark.createDataFrame(rows, "lang string, n long, low double, high double"), 0.0, float("inf")).collect()
    assert {r["high"] for r in nothing} == {float("inf")}
