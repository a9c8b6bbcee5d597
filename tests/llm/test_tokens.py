"""Operators 2 and 6, and the encoder that they share."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import TEXTS
from voxelyard.llm import packing, token_store
from voxelyard.llm.shared import scratch
from voxelyard.llm.tokens import ChunkEncoder, blocks

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


def whole(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


CODER = ChunkEncoder(PATH, cache_chunks=50)
ALPHABET = st.sampled_from(list("aAbzZ09 \t\n.,;:!?'-_éÉßİςΣ´́  \x1c\x85<|>") + ["don't", " the", "'s", "<|endoftext|>", "Å", "\U0001F600"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), max_size=5))
def test_chunks_give_the_ids_of_whole_texts(texts):
    ids, n = CODER.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])][: len(texts)] == whole(texts)


def test_odd_texts():
    ids, n = CODER.encode([None if t is None else t.encode() for t in TEXTS])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == whole(TEXTS)
    column = pa.array([b"abc", None, b"", b"x" * 50, b"y"], pa.binary())
    assert [(i, j) for i, j, _ in blocks(column, 10)] == [(0, 3), (3, 4), (4, 5)] and list(blocks(column[:0])) == []
    assert [t for _, _, texts in blocks(column.slice(1), 10) for t in texts] == column.to_pylist()[1:]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def store_rows(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=repr)


def test_store_of_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = [], 0
    for r, ids in zip(docs, whole([r["text"] for r in docs])):
        want.append((r["doc_id"], start, len(ids) + 1, crc([*ids, 1])))
        start += len(ids) + 1
    assert store_rows(token_store.op2_token_ids(spark, medium)) == sorted(want, key=repr)


def test_store_of_odd_table(spark, odd, none):
    path = scratch(spark, "store")
    token_store.write(odd, path, PATH, shard_ids=64)
    keys = token_store.places(spark, path).select("doc_id", "occurrence")
    rows = token_store.read(keys, path).collect()
    assert len(rows) == odd.count()
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r["doc_id"]].append(r["text"])
    got = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append(np.frombuffer(r["ids"], "<u4").tolist())
    for key, own in texts.items():
        assert sorted(got[key]) == sorted([*ids, 1] for ids in whole(own))
    order = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in rows)
    assert [o[0] for o in order] == [0, *np.cumsum([o[1] for o in order])[:-1].tolist()]
    ids = [o[2] for o in order]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    absent = spark.createDataFrame([(10**9 + i, 0) for i in range(200)] + [(7, 5)], "doc_id long, occurrence long")
    assert token_store.lookup(absent, path).count() == 0
    empty = scratch(spark, "store")
    token_store.write(none, empty, PATH)
    assert token_store.read(none.select("doc_id", F.lit(0).alias("occurrence")), empty).count() == 0


def test_a_key_reads_one_bucket_and_one_shard(spark, small, monkeypatch):
    monkeypatch.setattr(token_store, "BUCKET_KEYS", 16)
    docs, path = spark.read.parquet(f"{small}/documents.parquet"), scratch(spark, "store")
    token_store.write(docs, path, PATH, shard_ids=2000)
    assert token_store.stored(spark, path).count() > 20 and spark.read.parquet(f"{path}/index").count() > 10
    text = docs.where("doc_id = 77").first()["text"]
    asked = spark.createDataFrame([(77, 0)], "doc_id long, occurrence long")
    assert np.frombuffer(token_store.read(asked, path).first()["ids"], "<u4").tolist() == [*whole([text])[0], 1]
    (place,) = token_store.lookup(asked, path).collect()
    one = token_store._named(token_store.lookup(asked, path), ["part", "shard"], token_store.stored(spark, path))
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or f"(part#" in plan and "PartitionFilters: []" not in plan
    assert f"EqualTo(shard,{place['shard']})" in plan or f"In(shard, [{place['shard']}])" in plan
    assert one.count() == 1
    index = token_store._named(asked.select(*token_store.hashed(F.col("doc_id"), F.col("occurrence"), spark.read.parquet(f"{path}/meta").first()[0])), ["bucket"], spark.read.parquet(f"{path}/index"))
    assert index.count() == 1 and "PushedFilters: [" in index._jdf.queryExecution().toString() and "bucket" in index._jdf.queryExecution().toString().split("PushedFilters: [")[1].split("]")[0]


def test_a_hot_key_is_numbered_over_parts(spark):
    """Null and repeated keys that fill several parts: each row is found once by its number."""
    rows = [(None, f"null {i}") for i in range(70)] + [(5, f"five {i % 40}") for i in range(90)] + [(i, "x") for i in range(10, 20)]
    docs, path = spark.createDataFrame(rows, "doc_id long, text string"), scratch(spark, "store")
    token_store.write(docs, path, PATH, shard_ids=30)
    assert token_store.stored(spark, path).where(F.array_contains("keys", 5)).select("part").distinct().count() > 1
    keys = token_store.all_keys(docs)
    assert keys.count() == keys.distinct().count() == len(rows)
    got = token_store.read(keys, path).collect()
    assert Counter((r["doc_id"], np.frombuffer(r["ids"], "<u4").tobytes()) for r in got) == Counter((i, np.array([*whole([t])[0], 1], "<u4").tobytes()) for i, t in rows)
    assert len({r["start"] for r in got}) == len(rows)


def test_a_very_long_text(spark):
    long = "Some words, again and again. " * 500_000  # 14.5 MB
    docs, path = spark.createDataFrame([(1, "a"), (2, long), (3, "b")], "doc_id long, text string"), scratch(spark, "store")
    token_store.write(docs, path, PATH, shard_ids=1000)
    got = {r["doc_id"]: r for r in token_store.read(token_store.all_keys(docs), path).collect()}
    once = whole(["Some words, again and again. "])[0]
    assert np.frombuffer(got[2]["ids"], "<u4").tolist() == once * 500_000 + [1]
    assert got[3]["start"] == got[2]["start"] + 500_000 * len(once) + 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 5000])
def test_hash_is_minimal_and_perfect(n):
    h1, h2 = np.random.default_rng(n).integers(0, 1 << 63, (2, n), np.uint64)
    seeds, position = token_store.displace(h1, h2)
    assert sorted(position) == list(range(n))
    assert (token_store.position_of(h1, seeds[token_store.group_of(h2, n)], n) == position).all()


def check_pieces(rows, texts, tiers=packing.TIERS):
    """Each id in exactly one piece, windows gapless; gives the padded share."""
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    ids = {k: [*i, 1] for k, i in zip(texts, whole(list(texts.values())))}
    assert set(docs) == set(ids)
    for k, pieces in docs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[k]) and r["ids_crc32"] == crc(ids[k][at : at + r["length"]])
            at += r["length"]
        assert at == len(ids[k])
    padding = total = 0
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= tiers[-1]
        padding += 0 if at & (at - 1) == 0 else tiers[-1] - at
        total += at
    return padding / total


def test_packing_of_whole_table(spark, medium):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    assert check_pieces(packing.op6_packing(spark, medium).collect(), texts) < 0.01


@pytest.mark.parametrize("block", [1, 500, 1 << 20])
def test_packing_by_blocks(spark, small, block):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_pieces(packing.digest(packing.pack(docs.coalesce(1), PATH, block_ids=block)).collect(), texts)


def test_packing_of_odd_table(spark, odd, none):
    once = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.digest(packing.pack(once, PATH)).collect(), {r["doc_id"]: r["text"] for r in once.collect()})
    rows = packing.pack(odd, PATH).collect()
    assert sum(r["length"] for r in rows) == sum(len(i) + 1 for i in whole([r["text"] for r in odd.collect()]))
    assert packing.pack(none, PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, PATH, tiers=(100, 300))


def test_step_groups_are_even():
    sizes = [2048] * 50 + [1024] * 31 + [256] * 17
    step = packing.groups(sizes, 20_000)
    sums = [sum(s for s, g in zip(sizes, step) if g == k) for k in set(step)]
    assert max(sums) - min(sums) <= 2048
