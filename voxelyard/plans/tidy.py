"""Queries of tables, cohorts, properties and ledgers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import calibre, cohort, ledger, sweep, tables, trace
from ..sources.bind import LEDGER, VOXELS, read, voxels
from ..sources.bind import ledger as events
from ..streaming import merge
from .skeletons import rounded


def _customers(spark, d):
    return read(spark, d, "customer").select(F.col("c_custkey").alias("body_id"), F.col("c_acctbal").alias("volume"), F.when(F.col("c_nationkey") % 7 != 0, F.col("c_mktsegment")).alias("kind"), (F.col("c_custkey") % 13).cast("double").alias("cable"))


def summarize_by(spark, d):
    return rounded(tables.summarize(_customers(spark, d), ["volume", "cable"], "kind"))


def compare_cohorts(spark, d):
    rows = _customers(spark, d)
    return rounded(tables.compare(rows.where("body_id % 2 = 0"), rows.where("body_id % 3 = 0"), ["volume", "cable", "missing"]))


def log_histogram(spark, d):
    rows = _customers(spark, d)
    return rounded(calibre.log_histogram(rows, F.col("volume"), 10.0, 5000.0, 12), 6)


def weighted_histogram(spark, d):
    rows = _customers(spark, d)
    return rounded(calibre.log_histogram(rows, F.col("volume"), 10.0, 5000.0, 6, F.col("cable")), 6)


def equal_width_histogram(spark, d):
    return rounded(tables.equal_width(_customers(spark, d), "volume", 32))


def nearest_rank_quantiles(spark, d):
    return tables.nearest_rank(_customers(spark, d).where("kind is not null"), ["kind"], "volume", (0.1, 0.5, 0.9))


def percent_rank_bands(spark, d):
    ranked = tables.percent_rank(_customers(spark, d), "volume", "body_id")
    return rounded(tables.banded(ranked, "rank", {"low": (0.1, 0.2), "middle": (0.45, 0.55), "high": (0.9, 0.98)}).select("body_id", "rank", "band"), 9)


def cohort_membership(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    return cohort.membership({("docs", "good"): labels.where("quality = 1").select(F.col("doc_id").alias("body_id")), ("docs", "english"): docs.where("lang = 'en'").select(F.col("doc_id").alias("body_id")), ("docs", "toxic"): labels.where("toxic = 1").select(F.col("doc_id").alias("body_id"))})


def cohort_filter(spark, d):
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("body_id"), "n_chars")
    return docs.join(cohort_membership(spark, d), "body_id").groupBy("cohort").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def cohort_duplicates(spark, d):
    ids = read(spark, d, "lineitem").select((F.col("l_orderkey") - 5).alias("body_id"))
    return cohort.bad_ids(ids)


def keep_union(spark, d):
    a = read(spark, d, "supplier").select(F.col("s_suppkey").alias("body_id"))
    b = read(spark, d, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("body_id"))
    return cohort.keep_union([a, b])


def _tags(spark, d):
    part = read(spark, d, "part")
    tags = F.array(F.concat(F.lit("brand:"), "p_brand"), F.col("p_type"), F.concat(F.lit("size:"), F.col("p_size").cast("string")), F.when(F.col("p_partkey") % 4 == 0, F.lit("size:odd")))
    return part.select(F.col("p_partkey").alias("body_id"), F.filter(tags, lambda t: t.isNotNull()).alias("tags"))


def properties_wide(spark, d):
    out = cohort.wide(_tags(spark, d), ["brand", "size"], [])
    return out.withColumn("size_all", F.array_join("size_all", "|"))


def tags_flags(spark, d):
    tags = _tags(spark, d)
    _, flags = cohort.discover(tags)
    out = cohort.wide(tags, [], flags)
    names = [c for c in out.columns if c.startswith("tags_")]
    each = out.select("body_id", F.explode(F.array(*[F.struct(F.lit(n).alias("tag"), F.col(n).alias("flag")) for n in names])).alias("x")).select("body_id", "x.*")
    return each.where("flag").select("body_id", "tag")


def merge_properties(spark, d):
    flags = read(spark, d, "labels").select(F.col("doc_id").alias("body_id"), (F.col("toxic") == 1).alias("toxic"), "quality")
    return cohort.merge_properties(read(spark, d, "documents").select(F.col("doc_id").alias("body_id"), "lang"), flags)


def properties_outer(spark, d):
    a = read(spark, d, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("body_id"), F.col("lang").alias("kind"))
    b = read(spark, d, "labels").select(F.col("doc_id").alias("body_id"), F.col("quality").alias("kind"), "toxic")
    return cohort.outer([a, b])


def slug_bucket(spark, d):
    part = read(spark, d, "part")
    return part.select("p_partkey", text.slug(F.concat(F.lit("--"), "p_type", F.lit(" / "), "p_name", F.lit("!"))).alias("slug"), text.bucket(F.col("p_partkey") * 31).alias("bucket"), F.concat_ws("_", F.col("p_partkey") % 5, F.col("p_size")).alias("key"))


def allowlist_lines(spark, d):
    lines = read(spark, d, "part").select(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(",x"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("-"), F.col("p_partkey").cast("string"))).otherwise(F.concat(F.lit("body_"), F.col("p_partkey").cast("string"))).alias("value"))
    return lines.select(text.id_of(F.col("value")).alias("body_id")).where("body_id is not null").distinct()


def quantization(spark, d):
    rows = read(spark, d, "part").select("p_partkey", (F.col("p_size") * 64.0).alias("a"), (F.col("p_size") * 32.0 + 100).alias("b"), (1.0 + F.col("p_partkey") % 9).alias("v"))
    step = text.quantization_step([F.col("a"), F.col("b")], 3, 10)
    return rounded(rows.select("p_partkey", step.alias("step_nm"), text.quantization_fails(step, [F.col("v"), F.col("v") + 1], 10).alias("fails")), 6)


def path_cost(spark, d):
    r = F.when(F.col("p_partkey") % 10 == 0, float("inf")).otherwise(F.col("p_size").cast("double"))
    cost = text.path_cost(r)
    return read(spark, d, "part").select("p_partkey", F.when(cost < float("inf"), F.round(cost, 9)).alias("cost"))


def progress_bars(spark, d):
    rows = events(spark, d).groupBy("grp").agg(F.count_if(F.col("status") == "written").alias("done"), F.count("*").alias("total"))
    return rows.select("grp", text.bar(F.col("done"), F.col("total")).alias("bar"))


def elapsed_minutes(spark, d):
    rows = read(spark, d, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    m = text.minutes(F.col("a"), F.col("b"))
    return rounded(rows.select("user_id", m.alias("minutes"), F.try_divide(F.col("n").cast("double"), F.nullif(m, F.lit(0.0))).alias("rate")), 4)


def resume_todo(spark, d):
    keys = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"))
    return ledger.todo(keys, events(spark, d), ["key"])


def done_keys(spark, d):
    return ledger.done(events(spark, d), ["key"], failed_too=True)


def group_counts_latest(spark, d):
    return ledger.group_counts(events(spark, d), ["grp", "key"])


def progress_all_records(spark, d):
    return ledger.shares(ledger.record_counts(events(spark, d), "grp"), "grp")


def failure_streak(spark, d):
    return ledger.streaks(events(spark, d), ["key"])


def last_failures(spark, d):
    return ledger.last(events(spark, d), "failed", 25).select("seq", "key")


def skeleton_upsert(spark, d):
    old = _customers(spark, d).select("body_id", F.lit(5.0).alias("cable_length_nm"), F.lit(None).cast("double").alias("n_tips"), "volume")
    new = read(spark, d, "customer").select((F.col("c_custkey") * 2).alias("body_id"), F.when(F.col("c_custkey") % 3 > 0, F.col("c_custkey").cast("double")).alias("cable_length_nm"), F.lit(2.0).alias("n_tips"))
    return ledger.upsert(old, new, ["body_id"], ["cable_length_nm", "n_tips"])


def compartment_merge(spark, d):
    rows = sweep.joint_counts(voxels(spark, d).where("z % 3 = 0")).withColumn("block", F.lit("0"))
    more = sweep.joint_counts(voxels(spark, d).where("z % 3 <> 0")).withColumn("block", F.lit("1"))
    old = rows.drop("block")
    return ledger.merge_counts(old, rows.unionByName(more), rows.select("block"), ["body_id", "label"])


def status_pivot(spark, d):
    return ledger.by_status(events(spark, d), "grp", ("written", "empty", "dust", "skipped", "failed"))


def fusion_summary(spark, d):
    """Totals of fusions that are made up of customers."""
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    counts = {n: zero for n in ("n_fragments", "comps_in", "seam_join_comps_merged", "dust_comps_dropped", "radius_join_comps_merged", "tick_branches_removed")}
    cables = {n: none for n in ("cable_joined_nm", "loop_cable_delta_nm", "radius_join_cable_added_nm")}
    stats = _customers(spark, d).select(
        "body_id", *[c.alias(n) for n, c in (counts | cables).items()], (F.col("body_id") % 4).alias("comps_out"), F.lit(20000.0).alias("cable_in_nm"), F.lit(16000.0).alias("cable_out_nm"),
        F.when(F.col("body_id") % 6 > 0, F.abs("volume")).alias("dust_cable_dropped_nm"), F.col("cable").alias("tick_cable_removed_nm"), F.lit(40.0).alias("seam_join_cable_added_nm"), (F.col("body_id") % 4 == 0).alias("deleted"),
    )
    out = trace.fusion_summary(stats)
    return rounded(out.select("n_bodies", "comps_out", "dust_cable_dropped_nm", "tick_cable_removed_nm", "cable_in_nm", "n_deleted", "n_multi", "dropped_fraction", "inferred_fraction"), 4)


def median_candidate(spark, d):
    """The middle customer by balance of each nation."""
    return tables.middle(read(spark, d, "customer"), ["c_nationkey"], "c_acctbal", "c_custkey").select("c_nationkey", "c_custkey")


def run_windows(spark, d):
    found = merge.windowed(read(spark, d, "events"), "1 hour")
    return rounded(found.select(F.col("window.start").cast("string").alias("start"), "event_type", "n", "total"), 4)


QUERIES = {f.__name__: f for f in (summarize_by, compare_cohorts, log_histogram, weighted_histogram, equal_width_histogram, nearest_rank_quantiles, percent_rank_bands, cohort_membership, cohort_filter, cohort_duplicates, keep_union, properties_wide, tags_flags, merge_properties, properties_outer, slug_bucket, allowlist_lines, quantization, path_cost, progress_bars, elapsed_minutes, resume_todo, done_keys, group_counts_latest, progress_all_records, failure_streak, last_failures, skeleton_upsert, compartment_merge, status_pivot, fusion_summary, median_candidate, run_windows)}

_C = "c AS (SELECT c_custkey AS body_id, c_acctbal AS volume, CASE WHEN c_nationkey % 7 <> 0 THEN c_mktsegment END AS kind, CAST(c_custkey % 13 AS DOUBLE) AS cable FROM customer)"
_T = "t AS (SELECT p_partkey AS body_id, p_brand, p_type, CAST(p_size AS VARCHAR) AS size FROM part)"


def _log_sql(n, weight):
    edges = calibre.log_edges(10.0, 5000.0, n)
    rows = ", ".join(f"({k}, {edges[k - 1] if k else 'NULL'}::DOUBLE, {edges[k] if k <= n else 'NULL'}::DOUBLE)" for k in range(n + 2))
    return f"WITH {_C}, b(bin, lo, hi) AS (VALUES {rows}) SELECT CAST(bin AS INT) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, round(coalesce(sum({weight}), 0), 6) AS weight FROM b LEFT JOIN c ON (lo IS NULL OR volume >= lo) AND (hi IS NULL OR volume < hi) GROUP BY bin, lo, hi"


_LAST = "last AS (SELECT grp, key, status FROM (SELECT *, row_number() OVER (PARTITION BY grp, key ORDER BY seq DESC) AS r FROM ledger) WHERE r = 1)"

SQL = {
    "summarize_by": f"WITH {_C} SELECT kind, count(*) AS n, " + ", ".join(f"round(quantile_cont({c}, {q}), 4) AS {c}_p{int(q * 100)}" for c in ("volume", "cable") for q in (0.1, 0.5, 0.9)) + " FROM c GROUP BY kind",
    "compare_cohorts": f"WITH {_C}, a AS (SELECT median(volume) FILTER (WHERE body_id%2=0) AS v2, median(volume) FILTER (WHERE body_id%3=0) AS v3, median(cable) FILTER (WHERE body_id%2=0) AS c2, median(cable) FILTER (WHERE body_id%3=0) AS c3 FROM c) SELECT 'volume' AS \"column\", round(v2, 4) AS \"left\", round(v3, 4) AS \"right\", round(v2/v3, 4) AS ratio FROM a UNION ALL SELECT 'cable', round(c2, 4), round(c3, 4), round(c2/c3, 4) FROM a",
    "log_histogram": _log_sql(12, "CASE WHEN volume IS NOT NULL THEN 1.0::DOUBLE END"),
    "weighted_histogram": _log_sql(6, "cable"),
    "equal_width_histogram": f"WITH {_C}, l AS (SELECT min(volume) AS lo, max(volume) AS hi FROM c), b AS (SELECT CAST(bin AS INT) AS bin, lo + bin*(hi-lo)/32 AS l, lo + (bin+1)*(hi-lo)/32 AS h FROM l, range(32) r(bin)), k AS (SELECT CAST(least(floor((volume-lo)*32/(hi-lo)), 31) AS INT) AS bin, count(*) AS n FROM c, l GROUP BY 1) SELECT bin, round(l, 4) AS lo, round(h, 4) AS hi, coalesce(n, 0) AS n FROM b LEFT JOIN k USING (bin)",
    "nearest_rank_quantiles": f"WITH {_C}, r AS (SELECT kind, volume, row_number() OVER (PARTITION BY kind ORDER BY volume) - 1 AS k, count(*) OVER (PARTITION BY kind) AS n FROM c WHERE kind IS NOT NULL) SELECT kind, " + ", ".join(f"max(volume) FILTER (WHERE k = round_even({q}::DOUBLE*(n-1), 0)) AS p{int(q * 100)}" for q in (0.1, 0.5, 0.9)) + " FROM r GROUP BY kind",
    "percent_rank_bands": f"WITH {_C}, r AS (SELECT body_id, (row_number() OVER (ORDER BY volume, body_id) - 1)::DOUBLE / (count(*) OVER () - 1) AS rank FROM c) SELECT body_id, round(rank, 9) AS rank, CASE WHEN rank < 0.2 THEN 'low' WHEN rank < 0.6 THEN 'middle' ELSE 'high' END AS band FROM r WHERE (rank >= 0.1 AND rank < 0.2) OR (rank >= 0.45 AND rank < 0.55) OR (rank >= 0.9 AND rank < 0.98)",
    "cohort_membership": "SELECT 'docs' AS dataset, 'good' AS cohort, doc_id AS body_id FROM labels WHERE quality = 1 UNION ALL SELECT 'docs', 'english', doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT 'docs', 'toxic', doc_id FROM labels WHERE toxic = 1",
    "cohort_filter": "WITH m AS (SELECT 'good' AS cohort, doc_id FROM labels WHERE quality = 1 UNION ALL SELECT 'english', doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT 'toxic', doc_id FROM labels WHERE toxic = 1) SELECT cohort, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents JOIN m USING (doc_id) GROUP BY cohort",
    "cohort_duplicates": "SELECT l_orderkey - 5 AS body_id, CASE WHEN l_orderkey < 5 THEN 'negative' ELSE 'duplicate' END AS problem FROM lineitem GROUP BY l_orderkey HAVING l_orderkey < 5 OR count(*) > 1",
    "keep_union": "SELECT s_suppkey AS body_id FROM supplier UNION SELECT c_custkey FROM customer WHERE c_custkey % 5 = 0",
    "properties_wide": f"WITH {_T} SELECT body_id, p_brand AS brand, size, CASE WHEN body_id % 4 = 0 THEN size || '|odd' ELSE size END AS size_all FROM t",
    "tags_flags": f"WITH {_T} SELECT body_id, 'tags_' || lower(regexp_replace(p_type, '[^0-9A-Za-z]+', '_', 'g')) AS tag FROM t",
    "merge_properties": "SELECT doc_id AS body_id, lang, coalesce(toxic = 1, false) AS toxic, quality FROM documents LEFT JOIN labels USING (doc_id)",
    "properties_outer": "WITH a AS (SELECT doc_id AS body_id, lang AS kind_0 FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id AS body_id, quality AS kind_1, toxic FROM labels) SELECT body_id, kind_0, kind_1, toxic FROM a FULL JOIN b USING (body_id)",
    "slug_bucket": "SELECT p_partkey, lower(trim(regexp_replace('--' || p_type || ' / ' || p_name || '!', '[^0-9A-Za-z]+', '_', 'g'), '_')) AS slug, 'h' || lpad(lower(to_hex((p_partkey*31) % 4096)), 3, '0') AS bucket, (p_partkey % 5) || '_' || p_size AS key FROM part",
    "allowlist_lines": "SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN p_partkey ELSE -p_partkey END AS body_id FROM part WHERE p_partkey % 3 < 2",
    "quantization": "WITH q AS (SELECT p_partkey, greatest(p_size*64.0::DOUBLE, p_size*32.0::DOUBLE+100)*4/1024 AS s, 1.0::DOUBLE + p_partkey % 9 AS v FROM part) SELECT p_partkey, round(s, 6) AS step_nm, s*4 > v AS fails FROM q",
    "path_cost": "SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN round(1/(1+p_size::DOUBLE*p_size), 9) END AS cost FROM part",
    "progress_bars": f"WITH {LEDGER}, g AS (SELECT grp, CAST(least(floor(20.0::DOUBLE*count(*) FILTER (WHERE status='written')/count(*)), 20) AS INT) AS f FROM ledger GROUP BY grp) SELECT grp, repeat('#', f) || repeat('-', 20-f) AS bar FROM g",
    "elapsed_minutes": "WITH g AS (SELECT user_id, (epoch_us(max(ts)) - epoch_us(min(ts)))/60e6 AS m, count(*) AS n FROM events GROUP BY user_id) SELECT user_id, round(m, 4) AS minutes, CASE WHEN m <> 0 THEN round(n/m, 4) END AS rate FROM g",
    "resume_todo": f"WITH {LEDGER}, {_LAST.replace('grp, key', 'key').replace('PARTITION BY grp, key', 'PARTITION BY key')} SELECT CAST(c_custkey AS VARCHAR) AS key FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT key FROM last WHERE status <> 'failed')",
    "done_keys": f"WITH {LEDGER} SELECT DISTINCT key FROM ledger",
    "group_counts_latest": f"WITH {LEDGER}, {_LAST} SELECT status, count(*) AS n FROM last GROUP BY status",
    "progress_all_records": f"WITH {LEDGER}, k AS (SELECT grp, status, count(*) AS n FROM ledger GROUP BY grp, status) SELECT grp, status, n, round(100*n::DOUBLE / sum(n) OVER (PARTITION BY grp), 6) AS share FROM k",
    "failure_streak": f"WITH {LEDGER}, i AS (SELECT key, status = 'failed' AS bad, row_number() OVER (PARTITION BY key ORDER BY seq) - row_number() OVER (PARTITION BY key, status = 'failed' ORDER BY seq) AS g FROM ledger), r AS (SELECT key, bad, count(*) AS n FROM i GROUP BY key, bad, g) SELECT key, coalesce(max(CASE WHEN bad THEN n END), 0) AS streak FROM r GROUP BY key",
    "last_failures": f"WITH {LEDGER} SELECT seq, key FROM ledger WHERE status = 'failed' ORDER BY seq DESC LIMIT 25",
    "skeleton_upsert": f"WITH {_C}, n AS (SELECT c_custkey*2 AS body_id, CASE WHEN c_custkey % 3 > 0 THEN c_custkey::DOUBLE END AS l FROM customer) SELECT body_id, coalesce(n.l, CASE WHEN c.body_id IS NOT NULL THEN 5.0::DOUBLE END) AS cable_length_nm, CASE WHEN n.body_id IS NOT NULL THEN 2.0::DOUBLE END AS n_tips, volume FROM c FULL JOIN n USING (body_id)",
    "compartment_merge": f"WITH {VOXELS} SELECT body_id, label, count(*) AS voxel_count FROM voxels WHERE body_id <> 0 GROUP BY body_id, label",
    "status_pivot": f"WITH {LEDGER} SELECT grp, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS n_{s}" for s in ("written", "empty", "dust", "skipped", "failed")) + " FROM ledger GROUP BY grp",
    "fusion_summary": f"WITH {_C}, f AS (SELECT count(*) AS n_bodies, CAST(sum(body_id % 4) AS BIGINT) AS comps_out, sum(CASE WHEN body_id % 6 > 0 THEN abs(volume) ELSE 0 END) AS d, sum(cable) AS t, count(*)*20000.0::DOUBLE AS i, count(*)*16000.0::DOUBLE AS o, count(*) FILTER (WHERE body_id % 4 = 0) AS n_deleted, count(*) FILTER (WHERE body_id % 4 > 1) AS n_multi FROM c) SELECT n_bodies, comps_out, round(d, 4) AS dust_cable_dropped_nm, t AS tick_cable_removed_nm, i AS cable_in_nm, n_deleted, n_multi, round((d + t)/i, 4) AS dropped_fraction, round(n_bodies * 40.0::DOUBLE/o, 4) AS inferred_fraction FROM f",
    "median_candidate": "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS r, count(*) OVER (PARTITION BY c_nationkey) AS n FROM customer) WHERE r = (n+1)//2",
    "run_windows": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
