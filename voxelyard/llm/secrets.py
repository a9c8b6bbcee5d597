"""Secret scan with multipart credential linking, by SQL functions alone.

Strong parts are reported wherever they stand: assignments to secret-like names, access key ids, long
hexadecimal strings.  Weak parts are user names and client ids (identifiers), long mixed strings
(secrets), and URLs or hosts (endpoints).  They are reported only where complementary parts co-occur: an
identifier with a secret, a secret with an identifier, an endpoint with both.

Co-occurrence is an interval join.  A part's scope are the ``SCOPE`` code points before its start and after
its end, and another part lies in it if any of its span does, wherever in the text they stand.  The nearest
part of the other role on either side decides: the furthest end of those that start before, and the next start
of those that follow, are running maxima and minima over a document's parts in order, so many parts in a
scope cost no more than their number, and no pairs are made.  ``links`` name, for each part that is
reported, the nearest identifier and the nearest secret in its scope.

Each document's text is read once; what moves is its matches, by a row id, so a hot source or repeated
ids matter nothing.

Defined cases: null and empty texts have no spans (an empty string, and its SHA-256); a text may be of any
length; parts that overlap are at distance 0; of two parts equally near, the one before is linked; repeated
rows, and rows with equal or null ids, are scanned each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import column, table
from .spans import counted, gated, gathered, joined, placed

#: Code points between two parts of a credential, at most.
SCOPE = 300
KINDS = ["assign", "access", "hex", "user", "blob", "endpoint"]
STRONG = 3  # the first kinds
#: Role: kinds.
ROLES = {"identifier": (1, 3), "secret": (0, 2, 4), "endpoint": (5,)}
#: Kind: cheap test of the text, pattern, and what else a match must pass.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
RULES = [
    (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", ASSIGN),
    (r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]{16,}+"),
    (r"[0-9a-f]{24}", r"[0-9a-f]{24,}+"),
    (r"(?i:user(?:name)?|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]", r"(?i:user(?:name)?|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._+-]{3,}+"),
    (r"[A-Za-z0-9+/]{32}", r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}"),
    (r"://|(?i:host|endpoint|server)[\"']?\x20*[:=]", r"(?i:https?|ftp|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqp)://[^\s\"'<>]++|(?i:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
]


def nearest(kinds: tuple[int, ...]) -> Column:
    """The nearest other part of the kinds, as (gap, kind, start, end), if it is in the part's scope."""
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    own = F.col("kind").isin(*kinds)
    before = F.max(F.when(own, F.struct("end", "start", "kind"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(own, F.struct("start", "end", "kind"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    gaps = [F.greatest(F.col("start") - before["end"], F.lit(0)), F.greatest(after["start"] - F.col("end"), F.lit(0))]
    found = [F.when(x.isNotNull() & (gap <= SCOPE), F.struct(gap.alias("gap"), F.lit(side).alias("side"), x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))) for side, (gap, x) in enumerate(zip(gaps, (before, after)))]
    return F.least(*found)


def scan(docs: DataFrame) -> DataFrame:
    """A row per document row: row, doc_id, all (start, kind, end) as spans, kinds as in KINDS, and links
    (start, kind, end, to): to is the (start, kind, end) of a reported part's partner."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), column(docs, "doc_id", "long").alias("doc_id"), text.alias("text"))
    found = F.concat(*[gated(F.col("text"), F.col("text").rlike(gate), k, pattern) for k, (gate, pattern) in enumerate(RULES)])
    parts = rows.select("row", "doc_id", F.explode_outer(found).alias("p")).select("row", "doc_id", "p.*").repartition("row")
    parts = placed(parts, ["row"])
    match = F.col("match")
    passes = (
        F.when(F.col("kind") == 0, F.length(F.regexp_extract(match, ASSIGN, 1)) >= 6)
        .when(F.col("kind") == 4, match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]"))
        .otherwise(match.isNotNull())
    )
    parts = parts.select("row", "doc_id", F.when(passes, F.col("kind")).alias("kind"), "start", "end")
    parts = parts.withColumns({role: nearest(kinds) for role, kinds in ROLES.items()})
    kind, has = F.col("kind"), {role: F.col(role).isNotNull() for role in ROLES}
    told = (kind < STRONG) | F.when(kind == 3, has["secret"]).when(kind == 4, has["identifier"]).when(kind == 5, has["identifier"] & has["secret"])
    other = [F.when(~kind.isin(*kinds), F.col(role)) for role, kinds in ROLES.items() if role != "endpoint"]
    links = F.transform(F.filter(F.array(*other), lambda x: x.isNotNull()), lambda x: F.struct(F.col("start").alias("start"), F.col("kind").alias("kind"), F.col("end").alias("end"), F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")).alias("to")))
    return parts.groupBy("row", "doc_id").agg(gathered(told).alias("spans"), F.array_sort(F.flatten(F.collect_list(F.when(told, links)))).alias("links"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of the table."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < STRONG)
    counts = [counted("spans", k).alias(f"n_{n}") for k, n in enumerate(KINDS[:STRONG])]
    return found.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"), F.size("links").cast("long").alias("n_links"))
