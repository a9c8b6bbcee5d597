import re

import pytest

from tests.oracle import same
from voxelyard.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= {*range(i, i + n)}
                    found |= own
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=repr)


def run(docs, items):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in d.decontaminate(docs, items).collect()), key=repr)


ITEMS = [(1, "w " * 12), (2, "a b c"), (3, None), (4, ""), (5, "same text here"), (6, "SAME text, here!"), (None, "a b c"), (7, "one two three four five six seven eight nine ten eleven twelve")]


def test_odd_tables(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    long = "one two three four five six seven eight nine ten eleven twelve"
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame([(90, f"x {long} y {long} one two"), (91, long.replace("ten", "10")), (92, long[4:])], "doc_id long, text string"))
    assert run(docs, items) == brute([tuple(r) for r in docs.collect()], ITEMS)
    assert run(odd, items.limit(0)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], [])
    assert run(none, items) == []


def test_shuffled_windows(spark, odd, monkeypatch):
    monkeypatch.setattr(d, "BROADCAST_WINDOWS", 0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert run(odd, items) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], ITEMS)


def test_clean_keeps_rows_and_columns(spark, odd):
    items = spark.createDataFrame([(1, "same text here")], "item_id long, text string")
    left = d.clean(odd, items)
    assert left.columns == odd.columns and left.count() == odd.where("text is null or lower(text) not like 'same%text here'").count()


@pytest.mark.parametrize("size", ["small", "medium"])
def test_matches_sql(spark, size, request):
    same(spark, d.op1_decontamination, d.OP1_SQL, request.getfixturevalue(size))
