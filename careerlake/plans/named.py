"""Named queries: SQL with parameter markers over the tables of one database, and the gold views.

Tables are named by markers (bronze, curated, history, summary); views are stored in the catalog and outlive the session. Column lists
come from the schemas, so that the texts can't fall behind them; what they return equals the DataFrame plans of lakehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from careerlake.plans.lakehouse import LATEST, PRESENCE
from careerlake.schemas import CONTENT, CURATED, HISTORY, JOB, PORTAL_SUMMARY

VALID = "select * from identifier(:bronze) where record_status = 'valid'"
HASH = "upper(sha2(concat_ws('|', " + ", ".join(f"coalesce({f'array_join({c}, {chr(39)}|{chr(39)})' if c == 'locations' else c}, '')" for c in CONTENT) + "), 256))"
HISTORY_ROWS = f"select {', '.join(f'{HASH} as content_hash' if c == 'content_hash' else c for c in HISTORY)} from ({VALID})"
CURATED_ROWS = f"select {', '.join(CURATED)} from ({VALID})"
KINDS = ("remote", "hybrid", "onsite", "unknown")


def _table(schema: StructType, kind: str) -> str:
    """An external table over folders by run_date and run_id."""
    columns = {f.name: f.dataType.simpleString() for f in schema} | {"run_id": "string"}
    return f"create table if not exists identifier(:table) ({', '.join(f'{n} {t}' for n, t in columns.items())}) using {kind} partitioned by (run_date, run_id) location :location"


def _new(rows: str) -> str:
    """A day's rows that the target lacks: both sides are pruned to the day."""
    return f"with mine as (select * from ({rows}) where run_date = :run_date) select m.* from mine m left anti join (select run_date, job_hash from identifier(:target) where run_date = :run_date) t on t.run_date = m.run_date and t.job_hash = m.job_hash"


def _portal_daily() -> str:
    have = {name: f"count_if(coalesce({c} rlike '\\\\S', false))" for name, c in PRESENCE.items()}
    totals = [f"{n} as {name}_present_total" for name, n in have.items()]
    shares = [f"100.0d * {n} / count(*) as {name}_completeness_pct" for name, n in have.items()]
    kinds = [f"count_if(remote = '{k}') as {'unknown_remote' if k == 'unknown' else k}_jobs_total" for k in KINDS]
    return f"select run_date, portal_key, count(*) as jobs_exported_total, {', '.join(totals + shares + kinds)} from {{curated}} group by run_date, portal_key"


def _changes() -> str:
    """One pass over the snapshots: each makes up to two events."""
    kept = "portal_key, job_hash, job_id, title, company, source_url, content_hash"
    w = "over (partition by job_hash, if(job_hash is null, source_url, null) order by run_date)"
    seen = f"select run_date, {kept}, lag(content_hash) {w} as h, lag(run_date) {w} as d, lead(run_date) {w} as after from {{history}}"
    days = "select run_date, lead(run_date) over (order by run_date) as next_run_date from (select distinct run_date from {history})"
    event = lambda kind, at, h, d: f"named_struct('event_type', '{kind}', 'event_run_date', {at}, 'previous_content_hash', {h}, 'previous_run_date', {d})"
    changed = f"case when d is null then {event('new_job', 'run_date', 'h', 'd')} when not (h <=> content_hash) then {event('updated_job', 'run_date', 'h', 'd')} end"
    gone = f"case when next_run_date is not null and (after is null or after <> next_run_date) then {event('missing_from_latest_run', 'next_run_date', 'content_hash', 'run_date')} end"
    return f"select e.event_run_date, {kept}, e.previous_content_hash, e.previous_run_date, e.event_type from (select *, explode(array_compact(array({changed}, {gone}))) as e from ({seen}) join ({days}) using (run_date))"


def _lifecycle() -> str:
    jobs = f"select job_hash, max_by(struct({', '.join(LATEST)}, content_hash), run_date) as last, min(run_date) as first_seen_run_date, max(run_date) as last_seen_run_date, count(*) as snapshot_count from {{history}} group by job_hash"
    values = ", ".join(f"last.{c}" for c in LATEST)
    return f"select job_hash, {values}, last.content_hash as latest_content_hash, first_seen_run_date, last_seen_run_date, snapshot_count, latest_run_date, last_seen_run_date < latest_run_date as missing_from_latest_run from ({jobs}) cross join (select max(run_date) as latest_run_date from {{history}})"


#: The statements of the lakehouse, by name.
NAMED = {
    "bronze_table": _table(JOB, "json"),
    "portal_summary_table": _table(PORTAL_SUMMARY, "json"),
    "curated_rows": CURATED_ROWS,
    "curated_create": f"create table identifier(:target) using parquet options (compression 'snappy') partitioned by (run_date) as {CURATED_ROWS}",
    "curated_day": _new(CURATED_ROWS),
    "curated_insert": f"insert into identifier(:target) {_new(CURATED_ROWS)}",
    "history_create": f"create table identifier(:target) using parquet options (compression 'snappy') partitioned by (run_date) as {HISTORY_ROWS}",
    "history_insert": f"insert into identifier(:target) {_new(HISTORY_ROWS)}",
    "day_counts": "select run_date, portal_key, count(*) as jobs from identifier(:target) group by run_date, portal_key",
    "runs": "select run_date, lead(run_date) over (order by run_date) as next_run_date from (select distinct run_date from identifier(:target))",
}
#: The gold views: their names and texts over the tables {curated} and {history}.
VIEWS = {"gold_portal_daily_summary": _portal_daily(), "gold_job_change_events": _changes(), "gold_job_lifecycle_summary": _lifecycle()}


def run(spark: SparkSession, name: str, **args: str) -> DataFrame:
    return spark.sql(NAMED[name], args=args)


def views(spark: SparkSession, curated: str, history: str, database: str | None = None) -> None:
    """Creates or replaces the gold views over the two silver tables, in the database if one is given, else for this session."""
    if not set(HISTORY) <= set(spark.table(history).columns):
        raise ValueError(f"{history} isn't a history table")
    for name, text in VIEWS.items():
        kind = f"view {database}.{name}" if database else f"temporary view {name}"
        spark.sql(f"create or replace {kind} as " + text.replace("{curated}", curated).replace("{history}", history))
