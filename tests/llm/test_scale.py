"""What only larger tables show."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from tests.llm.test_near import brute, variants
from voxelyard.llm import exact_dedup, near, simhash
from voxelyard.llm.shared import sieve


def test_links_make_no_list_of_masks_in_the_driver(spark, monkeypatch):
    prints = spark.createDataFrame([(i,) for i in range(40)], "fp long")
    made, plain = [], simhash.F.lit
    monkeypatch.setattr(simhash.F, "lit", lambda x: made.append(x) or plain(x))
    simhash.links(prints, 2, 4)
    assert len(made) < 500  # there are 2,016 masks of two bits


@pytest.mark.parametrize("pair_keys", [256, 5])
def test_a_group_of_near_copies_has_no_more_comparisons_than_texts(spark, monkeypatch, pair_keys):
    rows = variants(200, 40, lambda d: d.randrange(4))
    asked, plain = [], near.verified
    monkeypatch.setattr(near, "verified", lambda docs, pairs, similarity: asked.append(pairs.count()) or plain(docs, pairs, similarity))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.representatives(docs, near.grouped(docs, pair_keys=pair_keys))
    assert {r["doc_id"] for r in found.collect()} == brute(rows)
    assert sum(asked) < 40 * 39 / 4


def test_the_stage_asks_operator_8_for_links(spark, monkeypatch):
    rows = variants(200, 12, lambda d: d.randrange(2))
    asked, plain = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda prints, *rest: asked.append(prints.count()) or plain(prints, *rest))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in p.simhash_stage(spark, docs, "").collect()} == brute(rows)
    assert asked == [len({simhash.fingerprint(t.encode(), 5) for _, t in rows})]


def test_keys_are_shuffled_once(spark, monkeypatch):
    """The counts of keys and the join with them share a shuffle, of texts and of fingerprints."""
    plans, plain = {}, near.materialise

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(near, "materialise", kept)
    monkeypatch.setattr(simhash, "materialise", kept)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        docs = spark.createDataFrame(variants(60, 12, lambda d: d.randrange(2)), "doc_id long, text string")
        near.links(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert all("ReusedExchange" in plans[name] for name in ("shared-bands", "signatures"))


def families(groups, texts, n=150):
    """Texts of a common passage, and in each group one of its own, too short to make them alike, with words of each."""
    draw = random.Random(11)
    passage = [f"p{i}" for i in range(n)]
    return [(g * 1000 + i, " ".join(passage + [f"g{g}-{k}" for k in range(20)] + [f"w{draw.randrange(10**9)}" for _ in range(30)])) for g in range(groups) for i in range(texts)]


def test_texts_apart_meet_at_few_shingles(spark, monkeypatch):
    """A leader with much of its own made all texts of its group meet at what they lack of it."""
    draw, rows = random.Random(2), families(1, 80)
    words = rows[0][1].split()
    rows += [(5000 + i, " ".join(words[:120] + [f"l{draw.randrange(10**9)}" for _ in range(60)])) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made, plain = [], near._pairs

    def pairs(x, y, on, similarity):
        out = plain(x, y, on, similarity)
        made.extend([out.count()] if on == ["lead", "token"] else [])
        return out

    monkeypatch.setattr(near, "_pairs", pairs)
    keys = near._texts(docs).select("doc_id", "text_key").collect()
    lead = next(bytes(r["text_key"]) for r in keys if r["doc_id"] == 5000)
    members = spark.createDataFrame([(bytearray(lead), r["text_key"]) for r in keys if bytes(r["text_key"]) != lead], "lead binary, text_key binary")
    nothing = spark.createDataFrame([], "a binary, b binary")
    roots = spark.createDataFrame([], "text_key binary, root binary")
    near.apart(docs, members, roots, nothing, 0.8, 16, 10**6)
    assert sum(made) < 84


@pytest.mark.parametrize("rounds", [1, 3])
def test_groups_in_groups_lose_nothing(spark, monkeypatch, rounds):
    monkeypatch.setattr(near, "PAIRS_A_TEXT", 0)
    monkeypatch.setattr(near, "ROUNDS", rounds)
    rows = [(1000 * g + i, t) for g, s in enumerate((3, 4)) for i, t in variants(150, 12, lambda d: d.randrange(9), seed=s)]
    rows += [(5000 + i, t + " " + rows[0][1]) for i, t in variants(60, 15, lambda d: d.randrange(6), seed=8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.representatives(docs, near.grouped(docs, pair_keys=2))
    assert {r["doc_id"] for r in found.collect()} == brute(rows)


def test_documents_that_stay_do_not_move(spark, tmp_path):
    """Of the texts, those alone reach a join that may have to go."""
    docs = spark.createDataFrame([(i, f"text {i % 190} of some words") for i in range(200)], "doc_id long, text string")
    may, others = sieve(docs, F.xxhash64("doc_id"), docs.where("doc_id >= 190").select(F.xxhash64("doc_id")))
    assert {r["doc_id"] for r in may.collect()} >= set(range(190, 200)) and may.count() < 20
    assert may.count() + others.count() == 200 and may.columns == docs.columns
    assert "Exchange hash" not in others._jdf.queryExecution().executedPlan().toString()
    assert {r["doc_id"] for r in exact_dedup.distinct_documents(docs).collect()} == set(range(190))
    none, every = sieve(docs, F.xxhash64("doc_id"), docs.limit(0).select(F.xxhash64("doc_id")))
    assert none.count() == 0 and every.count() == 200
