"""Run telemetry from fact tables: requests, responses, items and drops.

requests (portal_key, kind), responses (portal_key, kind, status), items: exported records; drops (portal_key, reason).
Every result is one or two partial aggregations over the facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.functions.urls import host
from careerlake.schemas import PORTAL_SUMMARY

ITEM_FIELDS = {"title": "title", "description": "description_text", "apply_url": "apply_url", "posted_date": "posted_date", "company": "company"}
RUN_FIELDS = ("title", "description_text", "locations", "posted_date", "apply_url", "company")
KINDS = ("listing", "pagination", "job_detail")
#: Statuses after which a request is asked again, and how often at most.
RETRIED = (406, 408, 429, 500, 502, 503, 504, 522, 524)
MOST_RETRIES = 4


def status_bucket(status: Column) -> Column:
    """"2xx" and so on; no status is "0xx"."""
    return F.concat(F.floor(F.coalesce(status, F.lit(0)) / 100).cast("string"), F.lit("xx"))


def _filled(name: str, kind: str) -> Column:
    c = F.col(name)
    return F.coalesce(F.size(c) > 0, F.lit(False)) if kind.startswith("array") else F.coalesce(c != "", F.lit(False))


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def request_counts(requests: DataFrame) -> DataFrame:
    """By portal and kind, and over all portals (portal_key '*')."""
    each = requests.groupBy("portal_key", "kind").agg(F.count("*").alias("requests"))
    return each.unionByName(each.groupBy("kind").agg(F.sum("requests").alias("requests")).withColumn("portal_key", F.lit("*")))


def response_buckets(responses: DataFrame) -> DataFrame:
    return responses.groupBy("kind", status_bucket(F.col("status")).alias("bucket")).agg(F.count("*").alias("responses"))


def is_retried(status: Column) -> Column:
    """Whether a response asks for another try; no status does too, as nothing came."""
    return F.coalesce(status.isin(*RETRIED), F.lit(True))


def retried_responses(responses: DataFrame) -> DataFrame:
    """By portal: responses, those that ask for another try, and the share of them."""
    again = F.count_if(is_retried(F.col("status")))
    return responses.groupBy("portal_key").agg(F.count("*").alias("responses_total"), again.alias("retried_total"), F.bround(again / F.count("*"), 6).alias("retried_rate"))


def portal_rows(requests: DataFrame, responses: DataFrame, items: DataFrame, drops: DataFrame) -> DataFrame:
    """One row for each portal in any of the facts; counts default to 0, rates without a base to null (duplicates: 0)."""
    counters = [f.name for f in PORTAL_SUMMARY if f.dataType.simpleString() == "bigint"] + [f"_{n}" for n in ITEM_FIELDS]
    one = lambda cond: F.when(cond, 1).otherwise(0)
    times = F.col("n") if "n" in drops.columns else F.lit(1)  # drops may be counted already
    many = lambda cond: F.when(cond, times).otherwise(0)
    kind = F.col("kind")
    facts = [
        requests.select("portal_key", F.lit(1).alias("requests_total"), *[one(kind == k).alias(f"{k}_requests_total") for k in KINDS]),
        responses.select("portal_key", F.lit(1).alias("responses_total"), one(F.coalesce(F.col("status") >= 400, F.lit(False))).alias("error_responses_total")),
        items.select("portal_key", F.lit(1).alias("jobs_exported_total"), *[one(_filled(c, dict(items.dtypes)[c])).alias(f"_{n}") for n, c in ITEM_FIELDS.items()]),
        drops.select("portal_key", many(F.col("reason") == "quarantine").alias("jobs_quarantined_total"), many(F.col("reason") == "duplicate").alias("duplicates_dropped_total")),
    ]
    # each kind of fact is summed to a row for each portal before they meet
    summed = [f.groupBy("portal_key").agg(*[F.sum(c).alias(c) for c in f.columns[1:]]) for f in facts]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summed)
    t = together.groupBy("portal_key").agg(*[_total(F.col(c)).alias(c) for c in counters])
    rate = lambda n, of: F.when(F.col(of) > 0, F.bround(F.col(n) / F.col(of), 6))
    pct = lambda n: F.when(F.col("jobs_exported_total") > 0, F.bround(F.lit(100.0) * F.col(f"_{n}") / F.col("jobs_exported_total"), 4)).alias(f"{n}_completeness_pct")
    return t.select(
        "portal_key",
        *[c for c in counters if not c.startswith("_")],
        F.coalesce(rate("duplicates_dropped_total", "job_detail_requests_total"), F.lit(0.0)).alias("duplicate_rate"),
        rate("jobs_exported_total", "job_detail_requests_total").alias("job_detail_success_rate"),
        *[pct(n) for n in ITEM_FIELDS],
    )


def ranked(rows: DataFrame) -> DataFrame:
    """Portals with the most error responses, then job-detail requests, first."""
    return rows.orderBy(F.desc("error_responses_total"), F.desc("job_detail_requests_total"), "portal_key")


def run_summary(rows: DataFrame, exceptions: int = 0) -> DataFrame:
    """One row over portal_rows: totals, success rate, and the funnel's loss (at least the exceptions) as parse failures."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    asked, got = n("job_detail_requests_total"), n("jobs_exported_total")
    return rows.agg(
        got.alias("jobs_exported_total"),
        n("jobs_quarantined_total").alias("jobs_quarantined_total"),
        n("duplicates_dropped_total").alias("duplicates_dropped_total"),
        asked.alias("job_detail_requests_total"),
        F.greatest(asked - got, F.lit(0), F.lit(exceptions)).cast("long").alias("job_detail_parse_failure_total"),
        F.when(asked > 0, F.bround(got / asked, 6)).alias("job_detail_success_rate"),
        F.count("*").alias("portal_summary_count"),
    )


def run_counters(items: DataFrame) -> DataFrame:
    """One row over the exported records: totals, distinct hosts and portals, and six fields' presence and percentage (0 without records)."""
    kinds = dict(items.dtypes)
    aggs = [F.count("*").alias("jobs_exported_total"), F.count_distinct(F.nullif(host(F.col("source_url")), F.lit(""))).alias("unique_hosts"), F.count_distinct("portal_key").alias("unique_portals")]
    for c in RUN_FIELDS:
        have = F.count_if(_filled(c, kinds[c]))
        aggs += [have.alias(f"{c}_present_total"), F.when(F.count("*") > 0, F.bround(F.lit(100.0) * have / F.count("*"), 4)).otherwise(0.0).alias(f"{c}_completeness_pct")]
    return items.agg(*aggs)


def metric_windows(metrics: DataFrame, aggregates: dict[str, str], width: str = "24 hours") -> DataFrame:
    """Tumbling windows (UTC) of metrics (ts, name, value): sum, max or avg by name; windows without points have no row."""
    wanted = F.col("name").isin(*aggregates)
    by = metrics.filter(wanted).groupBy(F.window("ts", width).alias("w"), "name").agg(F.sum("value").alias("s"), F.max("value").alias("m"), F.avg("value").alias("a"))
    value = reduce(lambda c, kv: c.when(F.col("name") == kv[0], F.col({"sum": "s", "max": "m", "avg": "a"}[kv[1]])), list(aggregates.items())[1:], F.when(F.col("name") == next(iter(aggregates)), F.col({"sum": "s", "max": "m", "avg": "a"}[next(iter(aggregates.values()))])))
    return by.select(F.col("w.start").alias("window_start"), "name", value.alias("value"))


#: metric -> (aggregate, comparison, threshold); a window without points doesn't breach.
ALARMS = {"RunFailed": ("sum", ">=", 1.0), "JobsExported": ("max", "<", 1.0), "JobDetailSuccessRate": ("avg", "<", 0.95)}


def alarms(metrics: DataFrame, rules: dict[str, tuple[str, str, float]] | None = None, width: str = "24 hours") -> DataFrame:
    rules = ALARMS if rules is None else rules
    test = {">=": lambda c, t: c >= t, "<": lambda c, t: c < t, ">": lambda c, t: c > t, "<=": lambda c, t: c <= t}
    windows = metric_windows(metrics, {n: r[0] for n, r in rules.items()}, width)
    breach = reduce(lambda c, kv: c | ((F.col("name") == kv[0]) & test[kv[1][1]](F.col("value"), F.lit(kv[1][2]))), rules.items(), F.lit(False))
    return windows.withColumn("breaching", breach)


def manifest(counters: DataFrame, summary: DataFrame, discovered: DataFrame, run: dict, seconds: float | None = None, artifacts: dict[str, str] | None = None) -> DataFrame:
    """The run's manifest: one nested row from the one-row results above. run has what is known of the run and its origin; the rest is null."""
    c, s, d = counters.select(F.struct("*").alias("c")), summary.select(F.struct("*").alias("s")), discovered.select(F.struct("*").alias("d"))
    all_rows = c.join(s, F.lit(True)).join(d, F.lit(True))  # one row each
    text = lambda k, of=run: F.lit(of.get(k)).cast("string").alias(k)
    counts = F.struct(F.col("d.jobs_discovered_total").alias("jobs_discovered_total"), F.col("s.job_detail_requests_total").alias("job_detail_requests_total"), F.col("c.jobs_exported_total").alias("jobs_exported_total"), F.col("s.jobs_quarantined_total").alias("jobs_quarantined_total"), F.col("s.duplicates_dropped_total").alias("duplicates_dropped_total"))
    quality = F.struct(F.col("s.job_detail_success_rate").alias("job_detail_success_rate"), *[F.col(f"c.{k}_completeness_pct").alias(f"{n}_completeness_pct") for n, k in (("description", "description_text"), ("apply_url", "apply_url"), ("posted_date", "posted_date"))])
    places = F.struct(*[text(k, artifacts or {}) for k in ("jobs_feed_uri", "metrics_uri", "run_manifest_uri", "quarantine_uri", "portal_summary_uri")])
    seeds = F.lit(run.get("input_seed_count")).cast("long").alias("input_seed_count")
    origin = ("run_id", "run_date", "started_at", "finished_at", "close_reason", "project", "stage", "spider", "deploy_env", "image_tag", "git_sha", "input_seed_file", "input_file_sha256")
    return all_rows.select(*[text(k) for k in origin], seeds, F.lit(seconds).cast("double").alias("run_duration_seconds"), counts.alias("counts"), quality.alias("quality"), places.alias("artifacts"))


def run_metrics(manifests: DataFrame) -> DataFrame:
    """The seven metric points of each manifest with its dimensions: ts, project, stage, spider, name, value."""
    points = {
        "JobsExported": F.col("counts.jobs_exported_total"),
        "JobsQuarantined": F.col("counts.jobs_quarantined_total"),
        "DuplicatesDropped": F.col("counts.duplicates_dropped_total"),
        "JobsDiscovered": F.col("counts.jobs_discovered_total"),
        "JobDetailSuccessRate": F.col("quality.job_detail_success_rate"),
        "RunDurationSeconds": F.col("run_duration_seconds"),
        "RunFailed": F.when(F.col("close_reason") == "finished", 0).otherwise(1),
    }
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in points.items()])).alias("p")
    return manifests.select(F.to_timestamp("finished_at").alias("ts"), "project", "stage", "spider", "run_id", each).select("ts", "project", "stage", "spider", "run_id", "p.name", "p.value").filter("value is not null")



def metrics_snapshot(stats: DataFrame, summary: DataFrame, reason: str, at: str) -> DataFrame:
    """One row: all stats (name, value) as a map with _dump_ts, _dump_reason and _summary, the summary's row as JSON."""
    named = stats.agg(F.map_from_entries(F.collect_list(F.struct("name", F.col("value").cast("string")))).alias("stats"))
    own = F.create_map(F.lit("_dump_ts"), F.lit(at), F.lit("_dump_reason"), F.lit(reason), F.lit("_summary"), F.to_json(F.struct("s.*")))
    return named.join(summary.select(F.struct("*").alias("s")), F.lit(True)).select(F.map_concat("stats", own).alias("metrics"))


def observed(jobs: DataFrame, name: str = "run_counters") -> DataFrame:
    """jobs as it is, with running counters that a listener (or an Observation of this name) gets as rows pass, batch or stream."""
    valid = F.col("record_status") == "valid"
    return jobs.observe(name, F.count_if(valid).alias("jobs_exported_total"), F.count_if(~valid).alias("jobs_quarantined_total"), F.coalesce(F.sum(F.size("validation_warnings")), F.lit(0)).alias("validation_warning_total"))
