"""Spelling variants: SQL on given tables, brute force on made-up words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from tests.oracle import same
from voxelyard.llm import spelling as s

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(docs):
    found = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            at = h % len(low)
            found[low[:at] + low[at + 1 :] if h % 199 == 0 else low] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    n = counted(docs)
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, own in others.items():
        best = min(own, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(others[w]), n.get(form[w])) for w in n}


def run(docs, **options):
    return {tuple(r) for r in s.variants(docs, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def made_up(seed):
    draw = random.Random(seed)
    base = ["abcdef", "wörter", "aaaaaaaa", "Straße", "ÀÿÉèxy", "ababababab"]
    texts = []
    for i in range(400):
        words = []
        for _ in range(40):
            w = draw.choice(base)
            for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice("abAéÿ×") + w[at:], w[:at] + draw.choice("abAéÿ÷") + w[at + 1 :]])
            words.append(w)
        texts.append((i, draw.choice([" ", "1", ", "]).join(words)))
    return texts


@pytest.mark.parametrize("hot", [s.HOT_KEY, 3])
def test_against_brute_force(spark, monkeypatch, hot):
    """Dense keys too: most words differ by an edit, and hot keys are sliced, in one list or by a join; short words
    compared as long ones are."""
    monkeypatch.setattr(s, "LONG_WORD", 0 if hot == 3 else s.LONG_WORD)
    monkeypatch.setattr(s.near_pairs, "__defaults__", (hot,))
    monkeypatch.setattr(s, "BROADCAST_KEYS", 100 if hot == 3 else s.BROADCAST_KEYS)
    docs = made_up(hot)
    want = brute(docs)
    assert len(want) > 300 and any(f and r != f for _, f, r, *_ in want)
    assert run(spark.createDataFrame(docs, "doc_id long, text string")) == want


def test_every_edit_shares_a_key(spark):
    """Each single edit of a word at each place is found."""
    word, letters = "kqéxbzàm", "aqzéÿ"
    edits = {word[:i] + word[i + 1 :] for i in range(8)} | {word[:i] + c + word[i:] for i in range(9) for c in letters} | {word[:i] + c + word[i + 1 :] for i in range(8) for c in letters}
    edits.discard(word)
    rows = spark.createDataFrame([(w, 5) for w in [word, *sorted(edits)]], "word string, n long")
    got = {frozenset((r["a"], r["b"])) for r in s.near_pairs(rows).collect()}
    assert got == {frozenset(p) for p in itertools.combinations([word, *edits], 2) if near(*p)}


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("x", "w21")], "word string, form string")
    assert {tuple(r) for r in s.roots(forms).collect()} == {(f"w{i}", "w21") for i in range(21)} | {("x", "w21")}


def test_odd_tables(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert run(odd, least_length=6, least_count=5) == brute(docs)
    five = odd.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(odd.select("doc_id", "text"))
    assert run(five) == brute(docs * 3)
    assert run(none) == set()


def test_long_words(spark):
    """A run of a megabyte, five times, and one edit of it."""
    long = "ab" * 500_000
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([long] * 30 + [long[:-1] + "x"] * 5)], "doc_id long, text string")
    want = counted([(i, t) for i, t in enumerate([long] * 30 + [long[:-1] + "x"] * 5)])
    got = {r["word"]: (r["n"], r["n_near"]) for r in s.variants(docs).collect()}
    assert {w: n for w, (n, _) in got.items()} == want and len(got) >= 2
    assert got[long][1] >= 1 and got[long[:-1] + "x"][1] >= 1


@pytest.mark.parametrize("size", ["small", "medium"])
def test_matches_sql(spark, size, request):
    same(spark, s.op12_spelling, s.OP12_SQL, request.getfixturevalue(size))
