"""Personal data by weak supervision, by SQL functions alone.

Candidates are spans of ``KINDS``: e-mail and IP addresses, card and phone numbers in strict forms, which
are reported always, and looser forms: spelled-out addresses, local phone and social security numbers,
IBANs, and names of people.  Four labelers vote on each candidate, for, against, or not at all; none says
the same of all candidates of a kind, or it abstains from that kind:

* form: what a stricter regex says of the match (area numbers, the way it is spelled, a title);
* gazetteer: top-level domains, calling codes, countries with IBANs, given names;
* context: words just before the match, like "phone", or "invoice" against it;
* checksum: the IBAN's remainder.

Votes are aggregated to counts of vote patterns per kind: at most len(KINDS) * 3 ** len(LABELERS) rows,
whatever the corpus.  Expectation-maximisation over these estimates the rate of true candidates of each
kind and each labeler's reliability in it, from a prior that counts like ``PRIOR`` votes.  Its posteriors, as
soft labels of all candidates, train the final span classifier: naive Bayes over kind and, within it, votes,
length and share of digits.  A loose span is reported if the classifier gives it ``THRESHOLD`` or more and
more labelers vote for it than against it.

Each text is read once; what moves is its matches, by a row id.

Defined cases: null and empty texts have no spans (an empty string, and its SHA-256); a text, and a match,
may be of any length; without candidates there is nothing to train and only strict spans could be reported;
a loose match within a strict one is a part of it; repeated rows, and rows with equal or null ids, are scanned
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import column, materialise, table
from .spans import counted, gated, gathered, joined, placed

KINDS = ["email", "ip", "card", "phone", "spelled_email", "local_phone", "ssn", "iban", "name"]
STRICT = 4  # the first kinds
THRESHOLD = 0.5
ROUNDS = 50
#: What a labeler's reliability, and a kind's rate, is taken for before any vote, and the votes that this
#: counts like: of the right ones and of all.
PRIOR = (8.0, 10.0)
LABELERS = ["form", "gazetteer", "context", "checksum"]

#: Top-level domains, country calling codes, countries with IBANs and their lengths, given
#: names.
DOMAINS = "com|org|net|edu|gov|info|biz|io|de|fr|es|it|nl|uk|ch|at|pl|se|no|dk|fi|pt|ie|be|us|ca|au|nz|jp|cn|in|br|mx|ru"
CALLING = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}
IBAN_COUNTRIES = "|".join(IBAN_LENGTHS)
GIVEN = (
    "Adam|Alan|Alexander|Alice|Amanda|Amy|Ana|Andrea|Andrew|Angela|Anna|Anthony|Antonio|Barbara|Benjamin|Brian|Carlos|Carol|Catherine|Charles|Charlotte|Christian|Christine|Christopher|Claudia|Daniel|David|Deborah|Diana|Dorothy|"
    "Edward|Elena|Elizabeth|Emily|Emma|Eric|Eva|Francisco|Frank|Gabriel|George|Gregory|Hannah|Hans|Heather|Helen|Henry|Isabel|Jack|Jacob|James|Jan|Jane|Jason|Jean|Jennifer|Jessica|Joan|Johannes|John|Jonathan|Jorge|Jose|Joseph|"
    "Joshua|Juan|Julia|Julie|Karen|Katherine|Kevin|Klaus|Laura|Lena|Linda|Lisa|Louis|Lucas|Luis|Manuel|Margaret|Maria|Marie|Mark|Martha|Martin|Mary|Matthew|Michael|Michelle|Miguel|Monica|Nancy|Nicholas|Nicole|Oliver|Olivia|Pablo|"
    "Patricia|Patrick|Paul|Pedro|Peter|Philip|Pierre|Rachel|Rebecca|Richard|Robert|Roger|Ruth|Samuel|Sandra|Sarah|Scott|Sebastian|Sofia|Sophie|Stefan|Stephen|Steven|Susan|Teresa|Thomas|Timothy|Ursula|Victoria|Walter|William|Wolfgang"
)
#: What no person's name holds (function words in title case, or a place, body or thing behind a name), and given
#: names that are ordinary words, so that one that begins a sentence says nothing.
NO_NAME = (
    r"\x20(?:The|An?|And|Or|Of|In|On|At|For|To|With|From|By|Is|Was|Are|Has|Had|Your|My|Our|His|Her|Their|This|That|These|Those|It|You|We|They|All|Every|No|Not|As|If|Down|Up|Out|Der|Die|Das|Und|Ein|Eine|Im|Am|Le|Les|Une|Et|Du|El|Los|Las|Una)\b"
    r"|\x20(?:Street|Road|Avenue|Lane|Square|Park|Bridge|Hill|House|Hall|Station|Airport|Island|Islands|Bay|Lake|River|County|City|Town|Beach|Falls|University|College|School|Institute|Hospital|Church|Cathedral|Museum|Library|Theatre|Theater|"
    r"Foundation|Award|Prize|Medal|Cup|Day|Week|Act|Law|Company|Inc|Ltd|Corporation|Hotel|Center|Centre|Stadium|Cross|Trophy|Festival)$"
)
ORDINARY = "Mark|Frank|Jack|Eva|Jean|Victoria|Christian|Scott|Martin|Heather|Carol|Patrick"
#: Cheap test of the text, and pattern, of each kind. Possessive repeats keep long runs linear.
RULES = [
    (r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    (r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    (r"(?:[0-9][\x20-]?){11}[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    (r"(?i)[\x20\[({<]at[\x20\])}>]", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[({<](?i:at)[\])}>]\x20?|\x20(?i:at)\x20)[A-Za-z0-9-]++(?:(?:\x20?[\[({<](?i:dot)[\])}>]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]++)++"),
    (r"[0-9]{3}\)?[\x20./-][0-9]{3}[\x20.-][0-9]{4}", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20./-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])"),
    (r"[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}", r"(?<![0-9-])[0-9]{3}([\x20-])[0-9]{2}\1[0-9]{4}(?![0-9-])"),
    (r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    (rf"\b(?:Mr|Mrs|Ms|Dr|Prof)\b|\b(?:{GIVEN})\x20[A-Z]", rf"\b(?:(?:Mr|Mrs|Ms|Dr|Prof)\b\.?(?:\x20[A-Z][a-z]++|\x20[A-Z]\.)++|(?:{GIVEN})(?:\x20[A-Z]\.)?(?:\x20[A-Z][a-z]++)++)"),
]
#: Words before a match that speak for each kind, and against any.
FOR = [r"e-?mail|mail|contact|write|reach", r"\bip\b|address|host|server|from", r"card|visa|master|credit|payment|pay", r"phone|tel|call|mobile|fax|contact", r"e-?mail|mail|contact|reach|write", r"phone|tel|call|mobile|cell|fax|contact", r"ssn|social|security", r"iban|account|bank|transfer", r"\bby\b|from|dear|contact|sincerely|regards|signed|name|patient|customer|author"]
AGAINST = r"version|isbn|invoice|order|serial|\bitem|part no|ticket|\bid[:#]|\blook|\barrive|\bmeet|street|saint"

IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass; for up to 19 of them."""
    cells = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.pmod(F.aggregate(cells, F.lit(0), lambda a, x: a + x), F.lit(10)) == 0


def iban_passes(match: Column) -> Column:
    """Remainder 1 modulo 97 of the rearranged IBAN, character by character."""
    plain = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    step = lambda a, ch: F.pmod(F.when(ch.rlike("[0-9]"), a * 10 + F.ascii(ch) - 48).otherwise(a * 100 + F.ascii(ch) - 55), F.lit(97))
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _by_kind(cases: dict[int, Column], otherwise: Column) -> Column:
    out = otherwise
    for k, c in cases.items():
        out = F.when(F.col("kind") == k, c).otherwise(out)
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end, votes, features); a row with a null kind where a document has
    none or for a failing match."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), column(docs, "doc_id", "long").alias("doc_id"), text.alias("text"))
    found = F.concat(*[gated(F.col("text"), F.col("text").rlike(gate) if gate != "@" else F.col("text").contains("@"), k, pattern) for k, (gate, pattern) in enumerate(RULES)])
    parts = rows.select("row", "doc_id", F.explode_outer(found).alias("p")).select("row", "doc_id", "p.*").repartition("row")
    parts = placed(parts, ["row"])
    match, number = F.col("match"), digits(F.col("match"))
    n = F.length(number)
    passes = _by_kind({1: match.rlike(IP_PARTS), 2: F.when(n.between(12, 19), luhn(number)).otherwise(False), 3: n.between(9, 15)}, match.isNotNull())
    yes = lambda c: F.when(c, 1).otherwise(-1)
    perhaps = lambda c: F.when(c, 1).otherwise(0)
    plain = F.regexp_replace(match, r"\x20", "")
    upper = match.rlike(r"^\p{Lu}")
    form = _by_kind({
        0: yes(match.rlike(r"^[A-Za-z0-9][^@]{0,63}@") & ~match.contains("..")), 1: yes(~match.rlike(r"^0|^127\.|\.0+[0-9]")), 2: yes(match.rlike("^[3-6]") & n.between(13, 16)), 3: yes(n.between(10, 14)),
        4: yes(match.rlike(r"[\[({<]")), 5: yes(match.rlike(r"^\(?[2-9][0-9]{2}\)?[^0-9][2-9]")), 6: yes(match.contains("-") & ~match.rlike("^(?:000|666|9)|-00-|-0000$")), 7: F.when(plain.rlike("^(?:" + "|".join(f"{c}.{{{k - 2}}}" for c, k in IBAN_LENGTHS.items()) + ")$"), 1).when(plain.rlike(f"^(?:{IBAN_COUNTRIES})"), -1).otherwise(0),
        8: F.when(match.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\b") & upper, 1).when(match.rlike(NO_NAME) | (match.rlike(f"^(?:{ORDINARY})\\b") & F.col("before").rlike(r"(?:^|[.!?:\n]\s*|\s[-*]\s*)$")), -1).otherwise(0),
    }, F.lit(0))
    gazetteer = _by_kind({
        0: perhaps(match.rlike(rf"(?i)\.(?:{DOMAINS})$")), 3: yes(match.rlike(rf"^\+(?:{CALLING})")), 4: yes(match.rlike(rf"(?i)[^a-z0-9-](?:{DOMAINS})$")),
        7: yes(match.rlike(rf"^(?:{IBAN_COUNTRIES})")), 8: perhaps(match.rlike(rf"\b(?:{GIVEN})\b")),
    }, F.lit(0))
    before = F.lower("before")
    near = _by_kind({k: before.rlike(words) for k, words in enumerate(FOR)}, F.lit(False))
    context = F.when(before.rlike(AGAINST), -1).when(near, 1).otherwise(0)
    checksum = _by_kind({7: yes(iban_passes(match))}, F.lit(0))
    length = F.least(F.floor(F.length(match) / 8), F.lit(4)).cast("int")
    share = F.round(4 * n / F.length(match)).cast("int")
    # a loose match within a strict one is a part of it
    so_far = Window.partitionBy("row").orderBy("start", F.col("end").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("passes", F.coalesce(passes, F.lit(False)))
    reach = F.max(F.when(F.col("passes") & (F.col("kind") < STRICT), F.col("end"))).over(so_far)
    parts = parts.withColumn("ok", F.col("passes") & ((F.col("kind") < STRICT) | F.coalesce(reach < F.col("end"), F.lit(True))))
    held = parts.select(
        "row", "doc_id", F.when(F.col("ok"), F.col("kind")).alias("kind"), "start", "end",
        F.when(F.col("ok"), form).alias("form"), F.when(F.col("ok"), gazetteer).alias("gazetteer"), F.when(F.col("ok"), context).alias("context"), F.when(F.col("ok"), checksum).alias("checksum"),
        F.when(F.col("ok"), length).alias("length"), F.when(F.col("ok"), share).alias("share"),
    )
    return held


# ---- weak supervision -----------------------------------------------------------------------------
def reliabilities(patterns: list[tuple]) -> tuple[dict[int, float], dict[tuple[str, int], float]]:
    """By expectation-maximisation, the rate of true candidates of each kind, and how often each
    labeler's vote is right in it. patterns is the table of vote patterns (kind, votes of LABELERS, n)."""
    kinds = range(len(KINDS))
    rate, right = dict.fromkeys(kinds, 0.5), {(v, k): PRIOR[0] / PRIOR[1] for v in LABELERS for k in kinds}
    for _ in range(ROUNDS):
        seen, good = dict.fromkeys(kinds, 0.0), dict.fromkeys(kinds, 0.0)
        votes, hits = dict.fromkeys(right, 0.0), dict.fromkeys(right, 0.0)
        for kind, *cast, n in patterns:
            odds = math.log(rate[kind] / (1 - rate[kind]))
            odds += sum(x * math.log(right[v, kind] / (1 - right[v, kind])) for v, x in zip(LABELERS, cast))
            true = 1 / (1 + math.exp(-odds))
            seen[kind] += n
            good[kind] += n * true
            for v, x in zip(LABELERS, cast):
                if x:
                    votes[v, kind] += n
                    hits[v, kind] += n * (true if x > 0 else 1 - true)
        rate = {k: (good[k] + PRIOR[1] / 2) / (seen[k] + PRIOR[1]) for k in kinds}
        right = {key: min(0.99, max(0.5, (hits[key] + PRIOR[0]) / (votes[key] + PRIOR[1]))) for key in right}
    return rate, right


def posterior(rate: dict[int, float], right: dict[tuple[str, int], float]) -> Column:
    """Probability of a candidate, given its kind and votes."""
    odds = _by_kind({k: F.lit(math.log(p / (1 - p))) for k, p in rate.items()}, F.lit(0.0))
    for v in LABELERS:
        odds = odds + F.col(v) * _by_kind({k: F.lit(math.log(right[v, k] / (1 - right[v, k]))) for k in rate}, F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def classifier(found: DataFrame, post: Column) -> Column:
    """Naive Bayes over the candidates' features within their kind, trained on the posteriors as soft
    labels: its probability, as an expression. Its table has a row for each kind and value of a feature, some
    two hundred."""
    features = [*LABELERS, "length", "share"]
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("int").alias("value")) for f in features]))
    soft = found.select(post.alias("post"), "kind", pairs.alias("x")).groupBy("kind", "x.feature", "x.value").agg(F.sum("post").alias("good"), F.sum(1 - F.col("post")).alias("bad")).collect()
    good, bad = dict.fromkeys(range(len(KINDS)), 0.0), dict.fromkeys(range(len(KINDS)), 0.0)
    for r in soft:
        good[r["kind"]] += r["good"] / len(features)
        bad[r["kind"]] += r["bad"] / len(features)
    odds = _by_kind({k: F.lit(math.log((good[k] + 1) / (bad[k] + 1))) for k in good}, F.lit(0.0))
    for r in sorted(soft, key=lambda r: (r["kind"], r["feature"], r["value"])):
        share = math.log((r["good"] + 1) / (good[r["kind"]] + 2)) - math.log((r["bad"] + 1) / (bad[r["kind"]] + 2))
        odds = odds + F.when((F.col("kind") == r["kind"]) & (F.col(r["feature"]) == r["value"]), share).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def scan(docs: DataFrame) -> DataFrame:
    """A row per document row: row, doc_id, and spans as an array of (start, kind, end)."""
    rows = materialise(candidates(docs), "candidates")
    found = rows.where("kind is not null")
    patterns = found.groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()  # see the module: bounded
    model = classifier(found, posterior(*reliabilities([tuple(r) for r in patterns])))
    favour = sum((F.col(v) for v in LABELERS), F.lit(0)) > 0
    told = F.col("kind").isNotNull() & ((F.col("kind") < STRICT) | ((model >= THRESHOLD) & favour))
    return rows.groupBy("row", "doc_id").agg(gathered(told).alias("spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of the table."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < STRICT)
    counts = [counted("spans", k).alias(f"n_{n}") for k, n in enumerate(KINDS[:STRICT])]
    return found.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"))
