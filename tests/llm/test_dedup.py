"""Operators 8 and 9 against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import same
from voxelyard.llm import exact_dedup, simhash


def lowest(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


# ---- simhash ----------------------------------------------------------------------------------------
def slow_fingerprint(text):
    import xxhash

    low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, limit=2):
    names = sorted(set(prints))
    root = {p: p for p in names}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    values = np.array(names, np.uint64)
    for i, p in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= limit):
            a, b = sorted((find(p), find(names[i + 1 + j])))
            root[b] = a
    return {p: find(p) for p in names}


def expected(rows):
    prints = [slow_fingerprint(t) for _, t in rows]
    root = slow_components(prints)
    ids = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        ids[root[p]].append(i)
    return sorted(((i, f"{p:016x}", lowest(ids[root[p]])) for (i, _), p in zip(rows, prints)), key=repr)


def shown(df):
    return sorted(((r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in df.collect()), key=repr)


def test_simhash_of_odd_table(spark, odd, none):
    assert shown(simhash.near_duplicates(odd)) == expected([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert shown(simhash.near_duplicates(none)) == []
    left = simhash.representatives(odd)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    root = slow_components([slow_fingerprint(t) for _, t in rows])
    assert left.columns == odd.columns and left.count() == len(set(root.values()))
    blind = simhash.representatives(odd.withColumn("doc_id", F.lit(None).cast("long")))
    assert blind.count() == len(set(root.values()))


def test_simhash_of_whole_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.op8_simhash(spark, medium).collect()), key=repr)
    assert got == expected([tuple(r) for r in docs])


@pytest.mark.parametrize("limit", [0, 1, 2, 3])
@pytest.mark.parametrize("pair_keys", [256, 2])
def test_links_lose_nothing(spark, limit, pair_keys):
    if limit == 3 and pair_keys == 2:
        pytest.skip("41,664 blanks a fingerprint are for rare cases")
    random = np.random.default_rng(limit)
    centres = random.integers(0, 1 << 63, 12, np.uint64)
    values = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            flips = random.integers(0, 64, random.integers(1, 5))
            values.add(int(c) ^ sum(1 << int(b) for b in set(flips.tolist())))
    prints = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.links(prints, limit, pair_keys)).collect()}
    want = slow_components(sorted(values), limit)
    groups = defaultdict(set)
    for v in values:
        groups[found.get(simhash._signed(v), simhash._signed(v))].add(v)
    own = defaultdict(set)
    for v, r in want.items():
        own[r].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, own.values()))


@pytest.mark.parametrize("few", [simhash.FEW_EDGES, 0])
def test_components_of_chains_and_stars(spark, few):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(201, 203), (202, 203)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long"), few).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 140)} == {100} and {found[i] for i in (201, 202, 203)} == {201}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- exact dedup --------------------------------------------------------------------------------------
def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_of_odd_table(spark, odd, none):
    for split in (exact_dedup.half(), F.lit(True), F.lit(False), F.col("row") % 2 == 0):
        rows = exact_dedup.dedup(odd, split).collect()
        groups = defaultdict(list)
        for r in odd.collect():
            groups[norm(r["text"])].append(r["doc_id"])
        want = sorted(((i, lowest(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids), key=repr)
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in rows), key=repr) == want
        kept = [r for r in rows if r["kept"]]
        assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_dedup.dedup(none, exact_dedup.half()).count() == 0
    left = exact_dedup.distinct_documents(odd)
    assert left.columns == odd.columns and left.count() == len(groups)


@pytest.mark.parametrize("size", ["small", "medium"])
def test_exact_matches_sql(spark, size, request):
    same(spark, exact_dedup.op9_exact_dedup, exact_dedup.OP9_SQL, request.getfixturevalue(size))


def test_batches_meet_stored_snapshots(spark, odd, none, tmp_path):
    """A snapshot that one session has stored is met by batches of others, and never changed."""
    first, second, third = (f"{tmp_path}/{n}" for n in "abc")
    schema = "doc_id long, text string"
    exact_dedup.save(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b  c"), (4, None)], schema), first)
    before = {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*")}
    later = spark.newSession()
    batch = later.createDataFrame([(10, "b c"), (11, "new"), (12, "new"), (13, ""), (None, "a"), (14, "x" * 3_000_000)], schema)
    got = {(r["doc_id"], r["keep_id"], r["known"], r["kept"]) for r in exact_dedup.meet(batch, [first]).collect()}
    assert got == {(10, 3, True, False), (11, 11, False, True), (12, 11, False, False), (13, 4, True, False), (None, 1, True, False), (14, 14, False, True)}
    exact_dedup.append(batch, [first], second)
    assert {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*") if str(p) in before} == before
    assert later.read.parquet(f"{second}/groups").count() == 2
    last = spark.newSession().createDataFrame([(20, "new"), (21, "a"), (22, "z")], schema)
    got = {(r["doc_id"], r["keep_id"], r["known"], r["kept"]) for r in exact_dedup.meet(last, [first, second]).collect()}
    assert got == {(20, 11, True, False), (21, 1, True, False), (22, 22, False, True)}
    exact_dedup.append(none, [first, second], third)
    assert exact_dedup.meet(odd, [third]).where("kept").count() == exact_dedup.meet(odd, []).where("kept").count() == len({norm(r["text"]) for r in odd.collect()})


def test_hot_groups_are_broadcast(spark, odd, monkeypatch):
    want = sorted(map(tuple, exact_dedup.dedup(odd, exact_dedup.half()).drop("row").collect()), key=repr)
    monkeypatch.setattr(exact_dedup, "HOT", 2)
    assert sorted(map(tuple, exact_dedup.dedup(odd, exact_dedup.half()).drop("row").collect()), key=repr) == want


@pytest.mark.parametrize("n", [0, 1, 2, 10, 1000, 70000])
def test_filter(n):
    keys = np.random.default_rng(n).integers(-(1 << 63), 1 << 63, n)
    seed, cells = exact_dedup.build_filter(keys)
    size = len(np.unique(keys))
    assert exact_dedup.screen(keys, size, seed, cells).all()
    others = np.random.default_rng(n + 1).integers(-(1 << 63), 1 << 63, 100_000)
    assert exact_dedup.screen(others, size, seed, cells).mean() < 0.001
    if n > 1000:  # two bytes a cell
        assert len(cells) < 2.6 * n


def test_byte_check_sees_a_clash(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    digest = exact_dedup.digests(docs).where("doc_id = 1").select("digest", "key").withColumn("n", F.lit(2))
    exact_dedup._byte_check(docs, digest)
    try:
        clash = spark.createDataFrame([(bytearray(32),)], "digest binary").withColumn("key", F.xxhash64("digest")).withColumn("n", F.lit(2))
        sha2 = F.sha2
        F.sha2 = lambda c, n: F.lit("00" * 32)
        with pytest.raises(ValueError, match="two texts"):
            exact_dedup._byte_check(docs, clash)
    finally:
        F.sha2 = sha2
