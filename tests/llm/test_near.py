"""Near copies of the pipeline's stage against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tests.llm.test_dedup import norm
from voxelyard.llm import near, simhash


def sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Ids that stay: the smallest of each component of texts with a Jaccard of 0.8 or more."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    each, at = {i: sets(t) for i, t in rows}, {}
    for i, s in each.items():
        for h in s:
            at.setdefault(h, []).append(i)
    tried = {x for ids in at.values() for x in itertools.combinations(sorted(ids), 2)}
    for a, b in sorted(tried):
        common = len(each[a] & each[b])
        if common >= 0.8 * (len(each[a]) + len(each[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {find(i) for i in root}


def variants(n, count, changes, seed=3):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(n)]
    out = []
    for i in range(count):
        words = list(base)
        for k in draw.sample(range(n), changes(draw)):
            words[k] = f"x{i}-{k}"
        out.append((i, " ".join(words)))
    return out


def test_stage_takes_near_copies_of_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    first = {}
    for r in sorted(docs.select("doc_id", "text").collect()):
        first.setdefault(norm(r["text"]), r["doc_id"])
    docs = docs.where(F.col("doc_id").isin([*first.values()]))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert len(want) < len(rows)
    assert {r["doc_id"] for r in p.simhash_stage(spark, docs, medium).select("doc_id").collect()} == want


@pytest.mark.parametrize("pair_keys", [256, 3])
def test_dense_groups_lose_nothing(spark, pair_keys):
    rows = variants(200, 40, lambda d: d.randrange(6))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.representatives(docs, near.grouped(docs, pair_keys=pair_keys))
    assert {r["doc_id"] for r in found.collect()} == brute(rows)


def test_a_common_passage_makes_no_pairs(spark, monkeypatch):
    """Texts that share a long passage, and little else, share keys but no rare shingle."""
    draw, passage = random.Random(5), " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"w{draw.randrange(10**9)}" for _ in range(60))) for i in range(60)]
    rows += [(100 + i, t) for i, t in variants(150, 20, lambda d: d.randrange(8), seed=9)]
    asked, plain = [], near.verified
    monkeypatch.setattr(near, "verified", lambda docs, pairs, similarity: asked.append(pairs.count()) or plain(docs, pairs, similarity))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.representatives(docs, near.grouped(docs, pair_keys=4))
    assert {r["doc_id"] for r in found.collect()} == brute(rows)
    assert asked[1] < 60 * 59 / 4


def test_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  b"), (6, "a c")], "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.representatives(docs, near.grouped(docs)).collect()} == {1, 4, 6}
