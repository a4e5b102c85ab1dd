"""Seed lists: loading, classification, recommendation and audit totals. Probes of hosts are data, not calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careerlake.functions import urls

LEAST_SUCCESS, MOST_ERRORS = 0.9, 0.25
# The reasons that an audit report gives.
REASONS = {
    "invalid_url": "seed must start with http:// or https://",
    "excluded_internal_or_staging": "seed looks like an internal, staging, sandbox, or training portal",
    "duplicate": "duplicate normalized seed URL",
}


def load(seeds: DataFrame) -> DataFrame:
    """seeds (pos, raw_value) -> (pos, url): normalised http(s) URLs that aren't internal, repeats kept."""
    url = urls.normalize_seed_url(F.col("raw_value"))
    return seeds.select("pos", url.alias("url")).filter(urls.has_http_scheme(F.col("url")) & ~urls.is_internal(F.col("url")))


def classify(seeds: DataFrame, probes: DataFrame) -> DataFrame:
    """Per seed, in this order: invalid_url, excluded_internal_or_staging, duplicate (of an earlier eligible one), then the probe's outcome.

    probes: url (normalised), dns_resolved, http_status, reason; a seed without a probe counts as not resolved.
    """
    at = seeds.select("pos", "raw_value", urls.normalize_seed_url(F.col("raw_value")).alias("normalized_url"))
    http = urls.has_http_scheme(F.col("normalized_url"))
    at = at.withColumn("early", F.when(~http, "invalid_url").when(urls.is_nonproduction(F.col("normalized_url")), "excluded_internal_or_staging"))
    # seeds that are out already, blank ones say, are told apart by their place, so that they aren't one group
    place = F.row_number().over(Window.partitionBy("normalized_url", F.when(F.col("early").isNotNull(), F.col("pos"))).orderBy("pos"))
    at = at.withColumn("early", F.coalesce("early", F.when(place > 1, "duplicate"))).withColumn("portal_key", F.when(http, urls.portal_key(F.col("normalized_url"))))
    p = probes.select(F.col("url").alias("normalized_url"), "dns_resolved", "http_status", "reason")
    joined = at.join(p, "normalized_url", "left")
    live = F.when(urls.host(F.col("normalized_url")) == "", "invalid_url").when(~F.coalesce("dns_resolved", F.lit(False)), "dns_unresolvable").when(F.col("http_status").isNull() | (F.col("http_status") >= 400), "http_unhealthy").otherwise("valid_keep")
    kind = F.coalesce("early", live)
    why = F.coalesce(*[F.when(F.col("early") == k, v) for k, v in REASONS.items()], F.col("reason"))
    probed = F.col("early").isNull()
    return joined.select("pos", "raw_value", "normalized_url", kind.alias("classification"), why.alias("reason"), "portal_key", F.when(probed, F.coalesce("dns_resolved", F.lit(False))).alias("dns_resolved"), F.when(probed, F.col("http_status")).alias("http_status"))


def recommend(classified: DataFrame, summary: DataFrame | None) -> DataFrame:
    """Adds recommended, its reason and the observed figures from the last run's portal rows (one for each portal_key).

    Without any portal rows live seeds are kept; with some, a portal must be among them, have exported, and meet both thresholds.
    """
    live = F.col("classification") == "valid_keep"
    if summary is None or not summary.limit(1).count():
        kept = classified.withColumns({"recommended": live, "recommendation_reason": F.when(live, "no recent portal summary provided; kept by live probe")})
        return kept.withColumns({"observed_success_rate": F.lit(None).cast("double"), "observed_jobs_exported": F.lit(None).cast("long"), "observed_error_rate": F.lit(None).cast("double")})
    s = summary.select("portal_key", F.lit(True).alias("_known"), F.col("job_detail_success_rate").alias("_rate"), F.coalesce("jobs_exported_total", F.lit(0)).alias("_jobs"), F.when(F.coalesce("responses_total", F.lit(0)) > 0, F.coalesce("error_responses_total", F.lit(0)) / F.col("responses_total")).alias("_errors"))
    j = classified.join(s, "portal_key", "left")
    known = live & F.coalesce("_known", F.lit(False))
    good = known & (F.col("_jobs") > 0) & F.coalesce(F.col("_rate") >= LEAST_SUCCESS, F.lit(False)) & F.coalesce(F.col("_errors") <= MOST_ERRORS, F.lit(True))
    rate = F.format_string("%.3f", F.coalesce("_rate", F.lit(0.0)))
    jobs = F.col("_jobs").cast("string")
    why = (
        F.when(good, F.concat(F.lit("recent run exported "), jobs, F.lit(" jobs at success rate "), rate))
        .when(known, F.concat(F.lit("recent run did not meet curated thresholds (exported="), jobs, F.lit(", success_rate="), rate, F.lit(")")))
        .when(live, "no recent portal summary for this portal")
    )
    seen = lambda c: F.when(known, F.col(c))
    out = j.withColumns({"recommended": good, "recommendation_reason": why, "observed_success_rate": seen("_rate"), "observed_jobs_exported": seen("_jobs"), "observed_error_rate": seen("_errors")})
    return out.select(*classified.columns, "recommended", "recommendation_reason", "observed_success_rate", "observed_jobs_exported", "observed_error_rate")


def audit_totals(audited: DataFrame) -> DataFrame:
    """Rows for each classification, for recommended and for total: name, n."""
    names: Column = F.array_compact(F.array(F.col("classification"), F.lit("total"), F.when(F.col("recommended"), "recommended")))
    counted = audited.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    always = audited.sparkSession.sql("select explode(array('recommended', 'total')) as name, 0L as n")
    return counted.unionByName(always).groupBy("name").agg(F.sum("n").alias("n"))


def requests(loaded: DataFrame) -> DataFrame:
    """One listing request for each loaded seed: pos, url, portal_key, request_kind, input_seed_url."""
    return loaded.select("pos", "url", urls.portal_key(F.col("url")).alias("portal_key"), F.lit("listing").alias("request_kind"), F.col("url").alias("input_seed_url"))


def allowed_hosts(loaded: DataFrame) -> DataFrame:
    """One row: how many seeds, and their distinct hosts in order."""
    return loaded.agg(F.count("*").alias("input_seed_count"), F.sort_array(F.collect_set(urls.host(F.col("url")))).alias("hosts"))
