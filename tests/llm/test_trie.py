"""The prefix trie against SQL on given tables and brute force on made-up conversations."""

import hashlib
import random
import zlib

import pytest

from tests.oracle import same
from voxelyard.llm import trie as t


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        full[c] = tuple(own.get(base, [])[:h] + v[h:])
    members = {}
    for c, v in full.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        kids = children.get(k, [])
        leaves[k] = sum(leaves[x] for x in kids) or 1
        saved[k] = sum(saved[x] for x in kids) + (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(full[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted((tuple(r) for r in t.prefix_trie(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


KIND = "conv_id long, turn long, role string, text string"


def made_up(seed, n=60):
    """Shared starts of all lengths, copies, branches at each depth, some long ones."""
    draw, rows = random.Random(seed), []
    for c in range(-7, n):
        length = draw.choice([1, 2, 3, 9, 14, 14, 40])
        for k in range(length):
            rows.append((c, k, "user" if k % 2 else "bot", f"é{k}" if draw.random() < 0.9 else draw.choice("xyz")))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_against_brute_force(spark, monkeypatch, hot):
    """With small blocks and pieces, and every parent hot, too."""
    if hot:
        monkeypatch.setattr(t, "BLOCK", 3)
        monkeypatch.setattr(t.endings, "__defaults__", (2,))
        monkeypatch.setattr(t.with_parents, "__defaults__", (0,))
    rows = made_up(int(hot))
    assert run(spark.createDataFrame(rows, KIND)) == brute(rows)


def test_odd_tables(spark):
    rows = [
        (0, None, None, None), (0, None, "a", ""), (0, 1, "ab", "c"), (0, 1, "a", "bc"), (0, 1, "a", "bc"), (1, 5, "user", "x"), (None, 1, "user", "lost"), (2, 0, None, ""),
        (3, 0, "", None), (7, 0, "user", "y"), (8, 0, "user", "y"), (11, 3, "u", "z" * 3_000_000), (12, 3, "u", "z" * 3_000_000), (10, 0, "u", "é"), (-3, 0, "u", "é"), (-5, 0, "u", "é"),
    ]
    df = spark.createDataFrame([(*r, 7, "k") for r in rows], KIND + ", depth int, k1 string")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == []
    assert run(df.where("conv_id is null")) == []
    alone = [(4, 0, "u", "t")]  # its group's first conversation is missing
    assert run(spark.createDataFrame(alone, KIND)) == brute(alone)


def test_a_comb_of_paths(spark):
    """Every conversation parts from the longest one a turn later."""
    rows = [(5 * c, k, "u", "same" if k < c else f"own{c}") for c in range(40) for k in range(c + 1)]
    assert run(spark.createDataFrame(rows, KIND)) == brute(rows)


def test_copies_and_a_conversation_of_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK", 64)
    rows = [(0, k, "u", f"t{k % 7}") for k in range(1500)] + [(5 * c, k, "u", f"t{k}") for c in range(1, 500) for k in range(3)]
    assert run(spark.createDataFrame(rows, KIND)) == brute(rows)


@pytest.mark.parametrize("size", ["small", "medium"])
def test_matches_sql(spark, size, request):
    same(spark, t.op11_prefix_trie, t.OP11_SQL, request.getfixturevalue(size))
