"""Toxicity: the automaton against brute force, held-out accuracy, planted misspellings and quotations."""

import random
import re

import pytest
from pyspark.sql import functions as F

from voxelyard.llm import toxicity as x


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(p != q for p, q in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("cache", [x.CACHE, 5])
def test_automaton_by_brute_force(monkeypatch, cache):
    monkeypatch.setattr(x, "CACHE", cache)
    draw = random.Random(4)
    word = lambda n: "".join(draw.choice("abcé") for _ in range(n))
    terms, stems = sorted({word(draw.randrange(3, 8)) for _ in range(40)}), sorted({word(4) for _ in range(8)})
    own = x.Automaton(terms, stems)
    for w in {word(draw.randrange(1, 10)) for _ in range(4000)}:
        close = [t for t in terms if len(t) >= x.FUZZY_LENGTH and near(t, w)]
        stem = [s for s in stems if w.startswith(s) and w != s]
        want = ("term", w) if w in terms else ("near", min(close)) if close else ("stem", max(stem, key=len)) if stem else None
        assert own.match(w) == want, w


def test_quotation_marks():
    words = x.tokens('he said "you fool" and „so ein narr“ or\n"open and „shut” fool')
    assert [w for w, q in zip(words, x.quoted(words)) if q and w.isalpha()] == ["you", "fool", "so", "ein", "narr", "shut"]


LEXICON = "trash pathetic idiot worthless disgusting stupid clown loser scum moron".split()


def misspelt(text):
    """Every term with one edit or a digit for a letter."""
    draw = random.Random(text)

    def change(m):
        w = m[0]
        i = draw.randrange(1, len(w))
        return draw.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "q" + w[i + 1 :], w.replace("i", "1").replace("o", "0").replace("s", "5")]) if len(w) > 4 else w.replace("s", "5")

    return re.sub("|".join(LEXICON), change, text)


@pytest.fixture(scope="module")
def model(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    return x.train(docs, labels), docs, labels


def test_held_out_accuracy(spark, model):
    own, docs, labels = model
    found = x.scored(docs, own)
    assert found.count() == docs.count()
    held = found.where("held_out").join(labels.where("toxic is not null"), "doc_id").toPandas()
    assert held[held.toxic == 1].predicted.mean() > 0.9
    assert held[held.toxic == 0].predicted.mean() < 0.005


def test_misspellings_and_quotations(spark, model):
    own, docs, labels = model
    rows = docs.join(labels, "doc_id").where((F.crc32(F.col("doc_id").cast("string")) % 5 == 0) & (F.col("lang") == "en"))
    toxic = [r["text"] for r in rows.where(F.col("toxic") == 1).collect() if len(re.findall("|".join(LEXICON), r["text"])) > 1]
    clean = [r["text"] for r in rows.where("toxic = 0 and quality = 1").limit(60).collect()]
    score = lambda texts: own.score(x.np.array([own.features(t) for t in texts]))
    assert (score(toxic) >= 0.5).mean() > 0.97
    assert (score([misspelt(t) for t in toxic]) >= 0.5).mean() > 0.85
    assert (score([t + ' The report quoted the phrase "you stupid clown" as it was.' for t in clean]) < 0.5).all()
    draw = random.Random(1)
    assert (score([re.sub(" ", lambda m: f' "{draw.choice(LEXICON)}" ' if draw.random() < 0.01 else " ", t) for t in clean]) < 0.5).mean() > 0.9


def test_ordinary_look_alikes_count_little(model):
    """A word one edit from a term that clean texts have is no sign of abuse."""
    own = model[0]
    alike = [w for w, (t, c) in own.known.items() if c > 5 * t and own.ready().look(w) and own.look(w)[1] == "near"]
    for w in alike:
        assert own.score(x.np.array([own.features(f"{w} " * 3 + "and so on " * 100)]))[0] < 0.5


def test_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, 1), (5, 0, 0), (6, 7, 1)], "doc_id long, toxic int, score int")
    for table in (labels, labels.limit(0), labels.where("toxic = 0")):
        for docs in (odd, none):
            out = x.scored(docs, x.train(docs, table))
            assert out.columns == ["doc_id", "held_out", "score", "predicted"]
            got = out.collect()
            assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert {r["held_out"] for r in out.collect()} <= {True, False}


def test_long_texts(spark, model):
    """A match of some MB, and a long text with terms."""
    own = model[0]
    rows = spark.createDataFrame([(1, "x" * 5_000_000), (2, "idiotic" * 400_000), (3, "word " * 600_000 + "idiot moron trash"), (4, '"' * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in x.scored(rows, own).collect()}
    assert got == {1: 0, 2: got[2], 3: 0, 4: 0}


def test_same_model_whatever_the_tasks(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    one, two = x.train(docs.coalesce(1), labels), x.train(docs.repartition(3), labels)
    assert one.entries == two.entries and one.known == two.known
    assert one.weights is None or abs(one.weights - two.weights).max() < 1e-9
