"""URL filter by a ratio of character language models, by SQL functions alone.

Host-and-path rules decide first; the longest one that fits wins.  URLs that rules allow and URLs that
rules block train one variable-order Markov model each: counts of characters after contexts of up to
``ORDER`` characters, interpolated from the longest context down (Witten-Bell), so an unseen context
falls back to a shorter one.  A URL that no rule decides is scored by its mean log-likelihood
difference per character, and blocked below a threshold.  The threshold is calibrated on URLs held out
of training, one in ``HELD_OUT`` by hash: the one with the best balanced accuracy.

Work is on distinct URLs, merged before the shuffle, so a hot URL is one row until the result is joined
back.  Distinct n-grams get their ratio once; they are broadcast to the URLs' characters up to
``BROADCAST_GRAMS``, counted before, and joined by shuffle beyond.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and, without
anything to score, is allowed; so is every undecided URL while one of the two models has no text;
repeated rows each have their row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import ascii_lower, column, materialise, table

ORDER = 4
HELD_OUT = 5
BINS = 512
BROADCAST_GRAMS = 200_000
ALPHABET = 256  # of the uniform model below all others
#: Rule of the given policy: verdict.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all after the scheme."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return ascii_lower(host), path, F.concat(ascii_lower(host), F.substr(rest, F.length(host) + 1))


def rule_for(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits; null for none."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        at = rule.index("/")
        fits = ((host == rule[:at]) | host.endswith("." + rule[:at])) & path.startswith(rule[at:])
        out = F.when(fits, rule).otherwise(out)
    return out


def grams(text: Column) -> Column:
    """For each character, the text of it and the ORDER characters before it."""
    start = F.lit("\x02" * ORDER)
    chars = F.split(F.concat(start, text), "")
    zipped = F.arrays_zip(*[F.slice(chars, k + 1, F.length(text)) for k in range(ORDER + 1)])
    return F.transform(zipped, lambda z: F.concat(*[z[str(k)] for k in range(ORDER + 1)]))


def ratios(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, ratio): the log-likelihood difference of each asked gram's last character. counts has
    (gram, a, r): how often the accepted and rejected URLs have it."""
    out = asked.select("gram").withColumns({"pa": F.lit(1.0 / ALPHABET), "pr": F.lit(1.0 / ALPHABET)})
    for k in range(ORDER + 1):
        seen = materialise(counts.groupBy(F.right("gram", F.lit(k + 1)).alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r")), f"grams{k}")
        context = seen.groupBy(F.left("g", F.lit(k)).alias("h")).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"), F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
        out = out.withColumn("g", F.right("gram", F.lit(k + 1))).withColumn("h", F.left("g", F.lit(k)))
        out = out.join(seen, "g", "left").join(context, "h", "left")
        p = lambda c, n, t, lower: F.coalesce((F.coalesce(c, F.lit(0)) + F.col(t) * F.col(lower)) / F.nullif(F.col(n) + F.col(t), F.lit(0)), F.col(lower))
        out = out.select("gram", p(F.col("a"), "na", "ta", "pa").alias("pa"), p(F.col("r"), "nr", "tr", "pr").alias("pr"))
    return out.select("gram", (F.log("pa") - F.log("pr")).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """The score with the best balanced accuracy over (score, good); 0 if one class is missing. Scores
    are counted in BINS bins, so what is sorted has that many rows."""
    low, high, good, bad = scored.agg(F.min("score"), F.max("score"), F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not good or not bad or low == high:
        return 0.0
    width = (high - low) / BINS
    bins = scored.groupBy(F.floor((F.col("score") - low) / width).alias("bin")).agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    gain = F.coalesce(F.sum("b").over(below), F.lit(0)) / bad - F.coalesce(F.sum("g").over(below), F.lit(0)) / good
    best = bins.select("bin", gain.alias("gain")).orderBy(F.desc("gain"), "bin").first()
    return low + width * best["bin"]


def parsed(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, url, host, path, rest, rule, ruled (the rule's verdict) of each row."""
    host, path, rest = parts(F.col("url"))
    rows = pages.select(column(pages, "page_id", "long").alias("page_id"), column(pages, "url", "string").alias("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"), rest.alias("rest")).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.element_at(F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]), F.col("rule")) if rules else F.lit(None).cast("string")
    return rows.withColumn("ruled", F.when(F.col("rule").isNotNull(), verdict))


def distinct_urls(rows: DataFrame) -> DataFrame:
    """(rest, ruled) of each distinct URL, dealt evenly: a few MB of URLs are many characters."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(rows.where("rest <> ''").groupBy("rest").agg(F.first("ruled").alias("ruled")).repartition(tasks), "urls")


def part() -> Column:
    """A part of HELD_OUT of a URL; part 0 of those that rules decide is held out of training."""
    return F.pmod(F.xxhash64("rest"), F.lit(HELD_OUT))


def fit(urls: DataFrame) -> tuple[DataFrame, float] | None:
    """(rest, score) of the URLs (rest, ruled) that no rule decides, and the threshold; None where one of
    the two classes has no text."""
    held = (part() == 0) & F.col("ruled").isNotNull()
    # a row a character, with the class to train or null
    train = F.when(~held, F.col("ruled"))
    chars = urls.where(train.isNotNull()).select(train.alias("class"), F.explode(grams(F.col("rest"))).alias("gram"))
    counts = chars.groupBy("gram").agg(F.count_if(F.col("class") == "allow").alias("a"), F.count_if(F.col("class") == "block").alias("r"))
    counts = materialise(counts, "url-grams")
    n_allow, n_block = counts.agg(F.coalesce(F.sum("a"), F.lit(0)), F.coalesce(F.sum("r"), F.lit(0))).first()
    if not n_allow or not n_block:
        return None
    open_ = urls.where(held | F.col("ruled").isNull())
    texts = open_.select("rest", "ruled", F.explode(grams(F.col("rest"))).alias("gram"))
    known = materialise(ratios(texts.select("gram").distinct(), counts), "ratios")
    if known.count() <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    scored = texts.join(known, "gram").groupBy("rest", "ruled").agg(F.avg("ratio").alias("score"))
    scored = materialise(scored, "url-scores")
    limit = threshold(scored.where("ruled is not null").select("score", (F.col("ruled") == "allow").alias("good")))
    return scored.where("ruled is null").select("rest", "score"), limit


def judge(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (null where none was needed) of each row."""
    rows = parsed(pages, rules)
    model = fit(distinct_urls(rows))
    if model is not None:
        rows = rows.join(model[0], "rest", "left")
        by_model = F.when(F.col("score") < model[1], "block").otherwise("allow")
    else:
        rows, by_model = rows.withColumn("score", F.lit(None).cast("double")), F.lit("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "score")


def masked(rows: DataFrame) -> DataFrame:
    """The rows of ``parsed``, without the rule's own host and path in what the models see."""
    host = F.substring_index("rule", "/", 1)
    own, path = F.length("host") - F.length(host), F.length("rule") - F.length(host)
    left = F.concat(F.left("host", own), F.substr("rest", F.length("host") + path + 1))
    return rows.withColumn("rest", F.when(F.col("rule").isNull(), F.col("rest")).otherwise(left))


def held_out_accuracy(pages: DataFrame, rules: dict[str, str] = RULES, mask: bool = False) -> tuple[float, float, int]:
    """Shares of allowed and of blocked URLs that the model judges as the rules do, and their number: of
    part 1, which then takes no part in training and calibration. With mask, neither they nor the URLs to
    train on have the strings that the rules look at."""
    rows = parsed(pages, rules)
    urls = distinct_urls(masked(rows) if mask else rows)
    model = fit(urls.withColumn("ruled", F.when(part() != 1, F.col("ruled"))))
    if model is None:
        return 0.0, 0.0, 0
    hidden = urls.where((part() == 1) & F.col("ruled").isNotNull()).join(model[0], "rest")
    fits = (F.col("score") >= model[1]) == (F.col("ruled") == "allow")
    share = lambda c: F.coalesce(F.avg(F.when(F.col("ruled") == c, fits.cast("int"))), F.lit(0.0))
    return tuple(hidden.agg(share("allow"), share("block"), F.count("*")).first())


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of pages."""
    return judge(table(spark, sf_dir, "pages"))
