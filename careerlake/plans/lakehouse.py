"""Bronze to silver to gold: projections, idempotent promotion, and the three gold results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from careerlake.functions.hashing import content_hash
from careerlake.functions.text import present
from careerlake.operators.dedupe import not_yet_in
from careerlake.schemas import CURATED, HISTORY
from careerlake.shared import saved

PRESENCE = {"title": "title", "description": "description_text", "apply_url": "apply_url", "posted_date": "posted_date", "company": "company"}


def curated(bronze: DataFrame) -> DataFrame:
    """Valid records, curated columns, run_date last."""
    return bronze.filter("record_status = 'valid'").select(*CURATED)


def history(bronze: DataFrame) -> DataFrame:
    return bronze.filter("record_status = 'valid'").withColumn("content_hash", content_hash()).select(*HISTORY)


def new_rows(rows: DataFrame, target: DataFrame, run_date: str) -> DataFrame:
    """A day's rows that target lacks; both sides are pruned to the day's partition."""
    day = F.col("run_date") == F.lit(run_date)
    return not_yet_in(rows.filter(day), target.filter(day), ["run_date", "job_hash"]).select(*rows.columns)


def create(rows: DataFrame, table: str) -> None:
    """A new Parquet table by run_date; fails if it exists."""
    rows.write.format("parquet").option("compression", "snappy").partitionBy("run_date").mode("errorifexists").saveAsTable(table)


def promote(spark: SparkSession, rows: DataFrame, table: str, run_date: str) -> int:
    """Appends the day's rows that the table lacks; running it again appends nothing. Returns how many."""
    if not spark.catalog.tableExists(table):
        create(rows.limit(0), table)
    before = spark.table(table).filter(F.col("run_date") == run_date).count()
    new_rows(rows, spark.table(table), run_date).select(*spark.table(table).columns).write.insertInto(table)
    spark.catalog.refreshTable(table)
    return spark.table(table).filter(F.col("run_date") == run_date).count() - before


def portal_daily_summary(silver: DataFrame, pct_scale: int | None = None) -> DataFrame:
    """By day and portal: jobs, presence totals and percentages of five fields, and jobs by kind of workplace.

    pct_scale rounds percentages half up to so many digits (1: as decimal division with that scale gives); None leaves them.
    """
    pct = lambda n: F.lit(100.0) * n / F.count("*")
    rounded = lambda c: c if pct_scale is None else F.round(c, pct_scale)
    have = {name: F.count_if(present(F.col(c))) for name, c in PRESENCE.items()}
    kinds = {"remote": "remote_jobs_total", "hybrid": "hybrid_jobs_total", "onsite": "onsite_jobs_total", "unknown": "unknown_remote_jobs_total"}
    return silver.groupBy("run_date", "portal_key").agg(
        F.count("*").alias("jobs_exported_total"),
        *[n.alias(f"{name}_present_total") for name, n in have.items()],
        *[rounded(pct(n)).alias(f"{name}_completeness_pct") for name, n in have.items()],
        *[F.count_if(F.col("remote") == kind).alias(name) for kind, name in kinds.items()],
    )


def run_calendar(snapshots: DataFrame) -> DataFrame:
    """Each run's date and the next: a handful of rows after the distinct, so one task orders them."""
    return snapshots.select("run_date").distinct().withColumn("next_run_date", F.lead("run_date").over(Window.orderBy("run_date")))


def change_events(snapshots: DataFrame, tie_breakers: tuple[str, ...] = (), one_per_day: bool = False, calendar: DataFrame | None = None) -> DataFrame:
    """new_job at a job's first date, updated_job when its content changed, missing_from_latest_run at the first run without it.

    One pass: every snapshot makes up to two events. A job that comes back isn't new. With copies of a job on a date the order of
    copies, and so the events, follows tie_breakers; one_per_day keeps one of them. calendar: that of all runs, if snapshots are of some jobs only.
    """
    if one_per_day:
        snapshots = snapshots.dropDuplicates(["job_hash", "run_date"])
    # rows without a hash are told apart by their URL, so that they aren't one group
    w = Window.partitionBy("job_hash", F.when(F.col("job_hash").isNull(), F.col("source_url"))).orderBy("run_date", *tie_breakers)
    seen = snapshots.select("run_date", "portal_key", "job_hash", "job_id", "title", "company", "source_url", "content_hash", F.lag("content_hash").over(w).alias("_hash"), F.lag("run_date").over(w).alias("_before"), F.lead("run_date").over(w).alias("_after"))
    both = seen.join(F.broadcast(run_calendar(snapshots) if calendar is None else calendar), "run_date")  # a row for each day of runs
    event = lambda kind, at, h, d: F.struct(F.lit(kind).alias("event_type"), at.alias("event_run_date"), h.alias("previous_content_hash"), d.alias("previous_run_date"))
    changed = F.when(F.col("_before").isNull(), event("new_job", F.col("run_date"), F.col("_hash"), F.col("_before"))).when(~F.col("_hash").eqNullSafe(F.col("content_hash")), event("updated_job", F.col("run_date"), F.col("_hash"), F.col("_before")))
    gone = F.when(F.col("next_run_date").isNotNull() & (F.col("_after").isNull() | (F.col("_after") != F.col("next_run_date"))), event("missing_from_latest_run", F.col("next_run_date"), F.col("content_hash"), F.col("run_date")))
    return both.withColumn("e", F.explode(F.array_compact(F.array(changed, gone)))).select("e.event_run_date", "portal_key", "job_hash", "job_id", "title", "company", "source_url", "content_hash", "e.previous_content_hash", "e.previous_run_date", "e.event_type")


def restated_dates(before: DataFrame, after: DataFrame, run_date: str) -> list[str]:
    """The dates whose events may differ when run_date's snapshots are restated: that date, the run after it by either calendar, and where jobs that changed
    are seen next, as the snapshot before is another one then. As many dates as runs at most."""
    day, later = F.col("run_date") == run_date, F.col("run_date") > run_date
    of = lambda rows, n: rows.filter(day).select("job_hash", "source_url", "content_hash", F.lit(n).alias("n"))
    both = of(before, 1).unionByName(of(after, -1)).groupBy("job_hash", F.when(F.col("job_hash").isNull(), F.col("source_url")).alias("url"), "content_hash")
    changed = both.agg(F.sum("n").alias("n")).filter("n <> 0").select(F.col("job_hash").alias("_job"), F.col("url").alias("_url")).distinct()
    same = F.col("job_hash").eqNullSafe(F.col("_job")) & F.when(F.col("job_hash").isNull(), F.col("source_url")).eqNullSafe(F.col("_url"))
    seen_next = after.filter(later).join(changed, same, "left_semi").groupBy("job_hash", F.when(F.col("job_hash").isNull(), F.col("source_url"))).agg(F.min("run_date").alias("d")).select("d")
    next_run = before.filter(later).select("run_date").unionByName(after.filter(later).select("run_date")).agg(F.min("run_date").alias("d"))
    return sorted({run_date, *[r["d"] for r in seen_next.unionByName(next_run).distinct().collect() if r["d"]]})


def events_of(snapshots: DataFrame, dates: list[str], **how) -> DataFrame:
    """The change events of some dates alone: the window goes over the jobs that are seen on those dates or on the runs before them."""
    calendar = saved(run_calendar(snapshots), "calendar")
    near = calendar.filter(F.col("run_date").isin(dates) | F.col("next_run_date").isin(dates)).select("run_date")
    jobs = snapshots.join(F.broadcast(near), "run_date").select(F.col("job_hash").alias("_job")).distinct()  # near: two rows for each date at most
    some = snapshots.filter(F.col("run_date") <= max(dates)).join(jobs, F.col("job_hash").eqNullSafe(F.col("_job")), "left_semi")
    # a snapshot after the last date tells whether a job is still there on the next run, which is an event of a later date
    return change_events(some, calendar=calendar, **how).filter(F.col("event_run_date").isin(dates))


def restated_events(events: DataFrame, before: DataFrame, after: DataFrame, run_date: str, **how) -> DataFrame:
    """events of the snapshots before, as they are after run_date was restated: only dates that may differ are worked out again."""
    dates = restated_dates(before, after, run_date)
    return events.filter(~F.col("event_run_date").isin(dates)).unionByName(events_of(after, dates, **how))


def replace_day(spark: SparkSession, rows: DataFrame, table: str, run_date: str) -> None:
    """The table's partition of run_date as these rows have it, empty if they have none; other days aren't touched."""
    columns = [c for c in spark.table(table).columns if c != "run_date"]
    day = rows.filter(F.col("run_date") == run_date).select(*columns)
    spark.sql(f"insert overwrite table {table} partition (run_date = '{run_date}') select * from {{day}}", day=day)
    spark.catalog.refreshTable(table)


def restate(spark: SparkSession, bronze: DataFrame, run_date: str, curated_table: str, history_table: str, events_table: str | None = None) -> list[str]:
    """A corrected day: its partitions of both silver tables are replaced, and the change events of the dates that this may touch. Returns those dates.

    events_table holds change_events, partitioned by event_run_date.
    """
    old = saved(spark.table(history_table).filter(F.col("run_date") == run_date), "old-day")
    others = spark.table(history_table).filter(F.col("run_date") != run_date)
    new = saved(history(bronze).filter(F.col("run_date") == run_date), "new-day")
    dates = restated_dates(others.unionByName(old), others.unionByName(new), run_date)
    replace_day(spark, curated(bronze), curated_table, run_date)
    replace_day(spark, new, history_table, run_date)
    if events_table:
        made = saved(events_of(spark.table(history_table), dates), "events")
        columns = [c for c in spark.table(events_table).columns if c != "event_run_date"]
        for d in dates:
            spark.sql(f"insert overwrite table {events_table} partition (event_run_date = '{d}') select * from {{day}}", day=made.filter(F.col("event_run_date") == d).select(*columns))
        spark.catalog.refreshTable(events_table)
    return dates


LATEST = ["portal_key", "job_id", "source_url", "title", "company", "locations", "posted_date", "remote", "employment_type", "career_area", "ref_number", "apply_url"]


def lifecycle_summary(snapshots: DataFrame) -> DataFrame:
    """By job: its values at its last date (nulls included), first and last date, snapshots, and whether the latest run lacks it.

    One max_by over a struct keeps the values of one row together when a date has copies.
    """
    last = F.max_by(F.struct(*LATEST, "content_hash"), "run_date").alias("last")
    jobs = snapshots.groupBy("job_hash").agg(last, F.min("run_date").alias("first_seen_run_date"), F.max("run_date").alias("last_seen_run_date"), F.count("*").alias("snapshot_count"))
    latest = snapshots.agg(F.max("run_date").alias("latest_run_date"))  # one row
    return jobs.crossJoin(F.broadcast(latest)).select("job_hash", *[F.col(f"last.{c}") for c in LATEST], F.col("last.content_hash").alias("latest_content_hash"), "first_seen_run_date", "last_seen_run_date", "snapshot_count", "latest_run_date", (F.col("last_seen_run_date") < F.col("latest_run_date")).alias("missing_from_latest_run"))


def expired_partitions(dates: DataFrame, run_date: str, days: int) -> DataFrame:
    """Partitions (run_date) that a retention of so many days no longer keeps on run_date."""
    return dates.select("run_date").distinct().filter(F.to_date("run_date") < F.date_sub(F.lit(run_date).cast("date"), days))
