"""Toxicity of documents: a lexicon learned from labels, met by Levenshtein automata, with context windows.

The lexicon is what labelled texts say: words, and stems (first ``STEMS`` code points of longer words), that
toxic texts have far more often than others by a likelihood ratio.  It becomes a trie, which is intersected with
Levenshtein automata of one edit: a state is a set of trie nodes with the edits spent, and states are made as
words need them, so a word costs a look-up a letter and most end after a few.  A word may be meant if it is a
term, one edit from a term of ``FUZZY_LENGTH`` code points or more, or has a stem; digits that stand for letters are
read as these.  Its evidence is its own counts with those of what it matches as a prior, so ordinary words that
look like a term, and were seen in clean texts, count as ordinary.

Each match is judged in its window: between quotation marks, or close to a word of reporting, it is a quotation;
close to words of address it is the more an abuse.  A document's features (evidence of either kind, strongest match,
share of matches at one edit, rate, length) go into a logistic model, whose prior takes quotations for no abuse
until the labels say otherwise.  In training a document's own label is taken out of all counts that it is
judged by, so the model sees matches as they are in texts that it doesn't know.

Models are fitted on labelled documents of which crc32(doc_id) mod 5 isn't 0, on a sample of ``TRAIN_DOCS`` by a hash of the
id where there are more, copies counted once; all else, counts of terms in the sample included, is computed by
Spark.  Every whole text is scored; lang, source and ids are no inputs.

Defined cases: null and empty texts have no words and get the score of a text without matches; several labels of a
document: the highest counts; a null label or id is none; null ids are not held out (their remainder is null);
without any toxic or any clean training text the scores are the (smoothed) share of toxic ones; repeated rows
are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import column, materialise, table
from .tokens import blocks, released

#: Labelled documents that the model is fitted on, about.
TRAIN_DOCS = 40_000
#: Entries of the lexicon, and ordinary look-alikes that are remembered, at most (parameters of the model).
TERMS, KNOWN = 4_096, 20_000
#: The least likelihood ratio of a term, and toxic texts that it must be in.
LEAST_RATIO, LEAST_TEXTS = 20.0, 3
STEMS = (4, 5, 6)
FUZZY_LENGTH = 5
#: Tokens on either side of a match that tell how it is meant.
WINDOW = 8
#: Words that a worker remembers, and states that its automaton keeps, before starting afresh.
CACHE = 400_000

# Marks, and words of reporting and address in four languages.
OPENING, CLOSING, STRAIGHT = "«„“‹", "»”“›", '"'
REPORTING = frozenset("said says say called calls quote quoted quotes word term wrote phrase sagte sagt nannte schrieb zitat zitiert wort begriff dit disait appelé mot terme citation écrit dijo dice llamó palabra término cita escribió".split())
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine euch tu toi ton ta vous votre tú ti eres usted vosotros".split())
LEET = str.maketrans("013457@$", "oieastas")

TOKEN = re.compile(r"[\w@$]+|[\"«»„“”‹›\n]")
FEATURES = 8
#: What the weights are drawn towards, and how strongly.
PRIOR = np.array([0, 1.0, 0.3, -0.5, -0.3, 0.2, 0, 0.2])
PRIOR_PRECISION = np.array([1e-3, 1, 1, 1, 1, 1, 1, 1])


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def plain(token: str) -> str:
    """The word that a token with digits or signs for letters stands for."""
    return token.translate(LEET) if not token.isalpha() and any(c.isalpha() for c in token) else token


def ratio(t: float, c: float, toxic: int, clean: int) -> float:
    """Log likelihood ratio of t of all toxic and c of all clean texts, 0 where toxic ones have it less often."""
    if t * clean <= c * toxic or t <= 0:
        return 0.0
    share = (t + c) / (toxic + clean)
    return 2 * (t * math.log(t / (toxic * share)) + (c * math.log(c / (clean * share)) if c > 0 else 0.0))


class Automaton:
    """The trie of terms and stems, intersected with Levenshtein automata of one edit, made as needed."""

    def __init__(self, terms: list[str], stems: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: dict[int, str] = {}
        self.stem: dict[int, str] = {}
        self.fuzzy = [False]  # whether a term below may be met with an edit
        for own, words in ((self.term, terms), (self.stem, stems)):
            for word in words:
                node, way = 0, [0]
                for letter in word:
                    if letter not in self.children[node]:
                        self.children[node][letter] = len(self.children)
                        self.children.append({})
                        self.fuzzy.append(False)
                    way.append(node := self.children[node][letter])
                own[node] = word
                if own is self.term and len(word) >= FUZZY_LENGTH:
                    for node in way:
                        self.fuzzy[node] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[tuple, int] = {}
        self.members: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a state: nodes with the fewest edits, those by leaving out a letter of the term included."""
        for node, edits in [*nodes.items()]:
            if not edits and self.fuzzy[node]:
                for child in self.children[node].values():
                    if self.fuzzy[child]:
                        nodes.setdefault(child, 1)
        key = tuple(sorted(nodes.items()))
        if key not in self.number:
            self.number[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
        return self.number[key]

    def _move(self, state: int, letter: str) -> int:
        nodes: dict[int, int] = {}
        for node, edits in self.members[state]:
            children = self.children[node]
            if letter in children and (not edits or self.fuzzy[children[letter]]):
                nodes[children[letter]] = min(edits, nodes.get(children[letter], 2))
            if not edits and self.fuzzy[node]:
                nodes.setdefault(node, 1)  # a letter too many
                for child in children.values():
                    if self.fuzzy[child]:
                        nodes.setdefault(child, 1)  # another letter
        self.moves[state][letter] = found = self._state(nodes) if nodes else -1
        return found

    def match(self, word: str) -> tuple[str, str] | None:
        """("term", it), ("near", the smallest term at one edit), ("stem", the longest) or None."""
        if len(self.members) > CACHE:
            self.clear()
        state, stem, exact = self.start, None, 0
        for letter in word:
            found = self.moves[state].get(letter)
            state = self._move(state, letter) if found is None else found
            exact = self.children[exact].get(letter, -1) if exact >= 0 else -1
            if exact in self.stem:
                stem = self.stem[exact]
            if state < 0:
                break
        if state >= 0:
            near = []
            for node, edits in self.members[state]:
                term = self.term.get(node)
                if term is not None and not edits:
                    return "term", term
                if term is not None and len(term) >= FUZZY_LENGTH:
                    near.append(term)
            if near:
                return "near", min(near)
        return ("stem", stem) if stem is not None and stem != word else None


class Model:
    """The lexicon with counts of toxic and clean texts, and the weights of features."""

    def __init__(self, entries: dict[tuple[str, str], tuple[int, int]], toxic: int, clean: int):
        self.entries, self.toxic, self.clean = entries, toxic, clean
        self.known: dict[str, tuple[int, int]] = {}
        self.weights: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "cache")}

    def ready(self) -> "Model":
        if "automaton" not in self.__dict__:
            self.automaton = Automaton(*([w for kind, w in sorted(self.entries) if kind == k] for k in ("term", "stem")))
            self.cache: dict = {}
        return self

    def look(self, token: str) -> tuple[str, str, str] | None:
        """(word, kind, entry) that the token matches."""
        if token in self.cache:
            return self.cache[token]
        word = plain(token)
        found = self.automaton.match(word)
        if len(self.cache) > CACHE:
            self.cache.clear()
        self.cache[token] = out = None if found is None else (word, *found)
        return out

    def evidence(self, word: str, kind: str, entry: str, label: int | None) -> float:
        """The log odds that the match speaks for, at least 0; label: of the text itself, to leave it out."""
        t, c = self.entries["stem" if kind == "stem" else "term", entry]
        if label is not None and kind != "near":
            t, c = t - (label == 1), c - (label == 0)
        if ratio(t, c, self.toxic, self.clean) < LEAST_RATIO or t < LEAST_TEXTS:
            return 0.0
        if kind != "term":
            share = min(1.0, 6 / (t + c))  # the entry's counts as a prior
            own_t, own_c = self.known.get(word, (0, 0))
            if label is not None and word in self.known:
                own_t, own_c = own_t - (label == 1), own_c - (label == 0)
            t, c = t * share + own_t, c * share + own_c
        return max(0.0, math.log((t + 0.1) / (self.toxic + 0.1)) - math.log((c + 0.5) / (self.clean + 0.5)))

    def features(self, text: str, label: int | None = None) -> np.ndarray:
        words = tokens(text)
        self.ready()
        look, cache = self.look, self.cache
        hits = [(i, hit) for i, w in enumerate(words) if (hit := (cache[w] if w in cache else look(w))) is not None]
        out = np.zeros(FEATURES)
        out[0], out[6] = 1.0, math.log1p(len(words)) - 6
        if not hits:
            return out
        marks = quoted(words)
        sums, met, strongest, inexact, addressed = [0.0, 0.0], set(), 0.0, 0.0, 0.0
        for i, (word, kind, entry) in hits:
            window = words[max(0, i - WINDOW) : i + WINDOW + 1]
            quote = bool(marks[i]) or not REPORTING.isdisjoint(window)
            if (word, quote) in met:
                continue
            met.add((word, quote))
            own = self.evidence(word, kind, entry, label)
            sums[quote] += own
            if not quote:
                strongest = max(strongest, own)
                inexact += own * (kind == "near")
                addressed += own * (not ADDRESS.isdisjoint(window))
        out[1], out[2], out[3] = math.log1p(sums[0]), strongest, math.log1p(sums[1])
        out[4] = inexact / sums[0] if sums[0] else 0.0
        out[5] = math.log1p(addressed)
        out[7] = math.log1p(100 * sums[0] / len(words))
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), (self.toxic + 0.5) / (self.toxic + self.clean + 1) if self.toxic else 0.0)
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -40, 40)))


def quoted(words: list[str]) -> list[bool]:
    """Which tokens are between an opening and a closing mark of one line."""
    out, since = [False] * len(words), None
    for i, w in enumerate(words):
        if w == "\n":
            since = None
        elif len(w) == 1 and w in OPENING + CLOSING + STRAIGHT:
            if since is not None and (w in CLOSING or w == STRAIGHT):
                out[since + 1 : i] = [True] * (i - since - 1)
                since = None
            elif w in OPENING or w == STRAIGHT:
                since = i
    return out


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic model with a normal prior, by Newton steps."""
    w = PRIOR.copy()
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        slope = x.T @ (y - p) - PRIOR_PRECISION * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_PRECISION)
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(text, label) of about most labelled documents that aren't held out, equal texts once."""
    known = labels.select(column(labels, "doc_id", "long").alias("doc_id"), column(labels, "toxic", "int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).where(~held_out(F.col("doc_id")))
    share = most / max(most, known.count())
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(known), "doc_id").groupBy(F.md5("text").alias("k")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    return materialise(rows.select("text", "label"), "training-texts")


def term_counts(rows: DataFrame) -> DataFrame:
    """(kind, word, t, c): the toxic and clean texts that have a word or a stem."""

    def work(batches):
        count: dict = defaultdict(lambda: [0, 0])

        def out():
            keys = [*count]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([k[0] for k in keys], [k[1] for k in keys], [count[k][0] for k in keys], [count[k][1] for k in keys]), (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["kind", "word", "t", "c"])

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = {w for w in map(plain, set(tokens(text))) if w[0].isalpha()}
                for key in [("term", w) for w in words] + [("stem", s) for s in {w[:n] for w in words for n in STEMS if len(w) > n}]:
                    count[key][1 - label] += 1
                if len(count) > CACHE:
                    yield out()
                    count.clear()
        if count:
            yield out()

    found = rows.mapInArrow(released(work), "kind string, word string, t long, c long")
    return found.groupBy("kind", "word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> Model:
    rows = training_texts(docs, labels, most)
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model({}, toxic, clean)
    counts = materialise(term_counts(rows), "term-counts")
    share = (F.col("t") + F.col("c")) / (toxic + clean)
    speaks = 2 * (F.col("t") * F.log(F.col("t") / (toxic * share)) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (clean * share))).otherwise(0.0))
    strong = counts.where((F.col("t") >= LEAST_TEXTS) & (F.col("t") * clean > F.col("c") * toxic)).withColumn("speaks", speaks)
    strong = strong.where((F.col("speaks") >= LEAST_RATIO) & (F.length("word") >= 3)).orderBy(F.desc("speaks"), "kind", "word").limit(TERMS)
    model = Model({(r["kind"], r["word"]): (r["t"], r["c"]) for r in strong.collect()}, toxic, clean)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def alike(batches):
        automaton = shared.value.ready().automaton
        for batch in batches:
            found = [m is not None and m[0] != "term" for m in map(automaton.match, batch.column("word").to_pylist())]
            yield batch.filter(pa.array(found, pa.bool_()))

    seen = counts.where("kind = 'term' and t + c > 1").select("word", "t", "c").mapInArrow(released(alike), "word string, t long, c long")
    model.known = {r["word"]: (r["t"], r["c"]) for r in seen.orderBy(F.desc(F.col("t") + F.col("c")), "word").limit(KNOWN).collect()}
    shared = spark.sparkContext.broadcast(model)

    def judge(batches):
        own = shared.value
        for batch in batches:
            found = [[float(label), *own.features(text, label)] for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64()))], ["x"])

    x = np.array([r["x"] for r in rows.mapInArrow(released(judge), "x array<double>").collect()])
    order = np.lexsort(x.T)  # so that sums don't depend on the order of tasks
    model.weights = fitted(x[order][:, 1:], x[order][:, 0])
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        own = shared.value.ready()
        for batch in batches:
            found = [own.features((t or b"").decode("utf-8", "replace")) for _, _, texts in blocks(batch.column("text")) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.score(np.array(found).reshape(-1, FEATURES)))], ["doc_id", "score"])

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").cast("binary").alias("text"))
    found = rows.mapInArrow(released(work), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the whole table."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))
