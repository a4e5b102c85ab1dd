"""The daily run: extract, validate, land, promote, with one explicit run_date throughout."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerlake import shared
from careerlake.functions import urls
from careerlake.operators import dedupe, frontier, records, seeds, telemetry
from careerlake.operators.extraction import extract_jobs
from careerlake.plans import gate, lakehouse
from careerlake.schemas import JOB
from careerlake.sources import readers, registry_log, writers

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Config:
    root: str
    database: str = "default"
    schedule_target: str = "workflow"
    analytics: bool = True
    most_scanned: int | None = None  # bytes a promotion may scan
    registry: bool = False  # whether jobs of earlier runs are left out
    registry_errors: str = "fail"  # or "pass": an unreadable registry lets everything pass
    gated: bool = False  # whether a run that doesn't pass the gate raises, after all is written
    stage: str = "dev"
    spider: str = "careers"
    deploy_env: str | None = None
    image_tag: str | None = None
    git_sha: str | None = None
    tries: int = 3
    retry_wait: float = 20.0

    def __post_init__(self):
        if self.schedule_target not in ("workflow", "task", "none"):
            raise ValueError("schedule_target is 'workflow', 'task' or 'none'")
        if self.schedule_target == "workflow" and not self.analytics:
            raise ValueError("the workflow needs analytics")


def override(run_date: str | None, run_id: str | None) -> tuple[str, str] | None:
    """A manual run gives both or neither."""
    if bool(run_date) != bool(run_id):
        raise ValueError("give both run_date and run_id, or neither")
    if run_date and not re.fullmatch(r"\d{4}-\d{2}-\d{2}", run_date):
        raise ValueError("run_date is yyyy-MM-dd")
    return (run_date, run_id) if run_date else None


def retry(step: Callable, times: int = 3, wait: float = 20.0, backoff: float = 2.0, errors: tuple = (OSError,)):
    """Calls step, again after failures of the given kinds, waiting longer each time."""
    for k in range(times):
        try:
            return step()
        except errors:
            if k + 1 == times:
                raise
            time.sleep(wait * backoff**k)


def today() -> str:
    """The run date of a run that names none: the day by UTC."""
    return datetime.now(UTC).date().isoformat()


def guard_scan(df: DataFrame, most: int | None) -> None:
    """ValueError if the optimiser expects the plan to read more bytes than allowed."""
    if most is not None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size > most:
            raise ValueError(f"the query would scan about {size} bytes; {most} are allowed")


def _kinds(pages: DataFrame) -> DataFrame:
    """pages with a request_kind (job details if they have none) and a status (200)."""
    have = set(pages.columns)
    kind = F.coalesce(F.col("request_kind"), F.lit("job_detail")) if "request_kind" in have else F.lit("job_detail")
    status = F.coalesce(F.col("status"), F.lit(200)) if "status" in have else F.lit(200)
    at = urls.canonicalize_detail_url(F.col("url"))
    own = F.coalesce(F.nullif(F.col("portal_key").cast("string"), F.lit("")), urls.portal_key(at))
    return pages.select("url", "html", own.alias("portal_key"), F.col("input_seed_url").cast("string").alias("input_seed_url"), kind.alias("request_kind"), status.alias("status"))


def run_daily(spark: SparkSession, pages: DataFrame, config: Config, run_date: str | None, run_id: str, seed_file: str | None = None) -> dict[str, int]:
    """Returns the rows promoted to the curated and history tables. Safe to run again: each output is the run's own folder or file, replaced even if the
    rerun has no rows for it. What was promoted before stays, as promotion only adds; lakehouse.restate replaces a day.

    In turn: job records of the detail pages, each parsed once; quarantine; duplicates of the run, and of other runs by the registry, which
    takes the new ones, runs at the same time included; the feed; promotion, tried again after failures; portal summary, manifest and metrics; the gate.
    run_date: today if null. pages may have request_kind and status, which the telemetry counts. With a seed file (CSV) only the stored pages that its
    seeds lead to are taken, with the kinds and portals of their requests.
    """
    run_date = today() if run_date is None else run_date
    override(run_date, run_id)
    started = datetime.now(UTC)
    root, own = config.root.rstrip("/"), f"run_date={run_date}/run_id={run_id}"
    dump(spark, config, {}, "open", own)
    origin = {"spider": config.spider, "deploy_env": config.deploy_env, "image_tag": config.image_tag, "git_sha": config.git_sha, "input_seed_file": seed_file}
    if seed_file:
        known_seeds = seeds.load(readers.seed_csv(spark, seed_file))
        origin |= {"input_file_sha256": readers.file_digest(spark, seed_file).first()["sha256"], "input_seed_count": known_seeds.count()}
        pages = frontier.requested(frontier.crawl(seeds.requests(known_seeds), pages), pages)
    seen = _kinds(pages)
    details = seen.filter("request_kind = 'job_detail' and status < 400")
    extracted = shared.saved(extract_jobs(details, run_id, run_date, f"{run_date}T00:00:00+00:00"), "extracted")
    records.validate(extracted, run_date).write.mode("overwrite").parquet(f"{root}/checked/{own}")
    checked = spark.read.schema(JOB).parquet(f"{root}/checked/{own}").withColumns({"run_date": F.lit(run_date), "run_id": F.lit(run_id)})
    writers.quarantine(checked, f"{root}/quarantine/{own}")
    order = ["scraped_at", "canonical_source_url"]
    valid = records.valid(checked)
    kept = first_in_run = dedupe.first_in_run(valid, order)
    if config.registry:
        now = F.unix_timestamp(F.lit(run_date), "yyyy-MM-dd")
        try:
            kept = registry_log.put(registry_log.RegistryLog(spark, f"{root}/registry"), valid, run_id, now, order)
        except (PySparkException, Py4JJavaError, OSError, ValueError, registry_log.ConflictError) as e:
            if config.registry_errors == "fail":
                raise
            log.error("the registry can't be used, all jobs pass: %s", str(e).splitlines()[0])
    writers.jobs_feed(kept.select(*[f.name for f in JOB]), f"{root}/bronze/jobs", run_date, run_id)
    bronze = readers.bronze_jobs(spark, f"{root}/bronze/jobs", earliest=run_date, latest=run_date)
    day = bronze.filter(F.col("run_date") == run_date)
    guard_scan(day, config.most_scanned)
    again = lambda rows, table: retry(lambda: lakehouse.promote(spark, rows, f"{config.database}.{table}", run_date), config.tries, config.retry_wait, errors=(OSError, Py4JJavaError))
    promoted = {"curated": again(lakehouse.curated(bronze), "silver_jobs_curated"), "history": again(lakehouse.history(bronze), "silver_jobs_history_snapshot")}
    items = day.filter(F.col("run_id") == run_id)
    report(config, seen, items, valid, first_in_run, checked, run_date, run_id, started, origin)
    runs = readers.manifest(spark, f"{root}/manifest/{own}").select("run_id", "close_reason", "counts.jobs_exported_total", "counts.jobs_quarantined_total", "quality.job_detail_success_rate")
    if config.gated:
        gate.require(runs)
    return promoted


def dump(spark: SparkSession, config: Config, stats: dict[str, int], reason: str, own: str) -> None:
    """The metrics file as it is at the start of a run, before there is anything to sum up."""
    rows = spark.createDataFrame(list(stats.items()), "name string, value long")
    writers.metrics(telemetry.metrics_snapshot(rows, spark.range(1).select(F.lit(0).alias("jobs_exported_total")), reason, datetime.now(UTC).isoformat()), f"{config.root.rstrip('/')}/metrics/{own}")


def report(config: Config, seen: DataFrame, items: DataFrame, valid: DataFrame, first_in_run: DataFrame, checked: DataFrame, run_date: str, run_id: str, started: datetime, origin: dict) -> None:
    """Writes the run's portal summary, manifest and metrics, each in a folder of its own."""
    root, own = config.root.rstrip("/"), f"run_date={run_date}/run_id={run_id}"
    requests = seen.select("portal_key", F.col("request_kind").alias("kind"))
    responses = seen.select("portal_key", F.col("request_kind").alias("kind"), "status")
    exported = items.groupBy("portal_key").agg(F.count("*").alias("n"))
    dropped = valid.groupBy("portal_key").agg(F.count("*").alias("all")).join(exported, "portal_key", "left")
    copies = dropped.select("portal_key", F.lit("duplicate").alias("reason"), (F.col("all") - F.coalesce("n", F.lit(0))).alias("n"))
    bad = checked.filter("record_status = 'quarantined'").groupBy("portal_key").agg(F.count("*").alias("n"))
    drops = copies.unionByName(bad.select("portal_key", F.lit("quarantine").alias("reason"), "n"))
    portals = telemetry.portal_rows(requests, responses, items, drops)
    writers.portal_summary(portals, f"{root}/ops/portal_summary/{own}")
    summary = telemetry.run_summary(portals)
    found = seen.filter("request_kind = 'job_detail'").agg(F.count_distinct(urls.canonicalize_detail_url(F.col("url"))).alias("jobs_discovered_total"))
    ended = datetime.now(UTC)
    places = {"jobs_feed_uri": f"{root}/bronze/jobs/{own}", "metrics_uri": f"{root}/metrics/{own}", "run_manifest_uri": f"{root}/manifest/{own}", "quarantine_uri": f"{root}/quarantine/{own}", "portal_summary_uri": f"{root}/ops/portal_summary/{own}"}
    run = {"run_id": run_id, "run_date": run_date, "started_at": started.isoformat(), "finished_at": ended.isoformat(), "close_reason": "finished", "project": "careerlake", "stage": config.stage, **origin}
    writers.manifest(telemetry.manifest(telemetry.run_counters(items), summary, found, run, (ended - started).total_seconds(), places), f"{root}/manifest/{own}")
    counts = telemetry.request_counts(requests).select(F.concat_ws("/", F.lit("requests"), "portal_key", "kind").alias("name"), F.col("requests").alias("value"))
    # of the duplicates, those within the run and those that the registry knew
    firsts = first_in_run.agg(F.count("*").alias("n")).join(valid.agg(F.count("*").alias("all")), F.lit(True)).join(items.agg(F.count("*").alias("kept")), F.lit(True))
    copies = firsts.select(F.explode(F.array(F.struct(F.lit("duplicates/in_run").alias("name"), (F.col("all") - F.col("n")).alias("value")), F.struct(F.lit("duplicates/across_runs").alias("name"), (F.col("n") - F.col("kept")).alias("value")))).alias("c")).select("c.*")
    counts = counts.unionByName(copies)
    writers.metrics(telemetry.metrics_snapshot(counts, summary, "close", ended.isoformat()), f"{root}/metrics/{own}")
