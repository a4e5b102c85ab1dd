"""All queries by name over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from careerlake.adapters import view, with_views
from careerlake.functions import dates, text, urls
from careerlake.functions.hashing import content_hash, job_hash
from careerlake.operators import dedupe, extraction, records, seeds, telemetry
from careerlake.plans import gate, lakehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
SPLIT_DAY = "2024-01-15"


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL if SQL can say the same."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# -- pieces of SQL ---------------------------------------------------------------------------

STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
strip = STRIP.format
null_if_blank = lambda c: f"nullif({strip(c)}, '')"
REMOTE = """case when t = '' then 'unknown' when contains(t, 'hybrid') then 'hybrid'
  when contains(t, 'yes') or contains(t, 'remote') or contains(t, 'work from home') or contains(t, 'wfh') then 'remote'
  when contains(t, 'no') or contains(t, 'onsite') or contains(t, 'on-site') or contains(t, 'office') then 'onsite' else 'unknown' end"""
SQUEEZED = "list_filter(list_transform(locations, lambda x: " + strip("regexp_replace(x, '\\s+', ' ', 'g')") + "), lambda x: x <> '')"
CLEAN = "list_filter(sq, lambda x, i: list_position(list_transform(sq, lambda y: lower(y)), lower(x)) = i)"
DATE = f"""case when coalesce(posted_date, '') = '' then posted_date else coalesce(
  case when regexp_full_match({strip('posted_date')}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then strftime(try_strptime({strip('posted_date')}, '%Y-%m-%d'), '%Y-%m-%d') end,
  case when regexp_full_match({strip('posted_date')}, '\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}') then strftime(try_strptime({strip('posted_date')}, '%m/%d/%Y'), '%Y-%m-%d') end,
  {strip('posted_date')}) end"""
#: Validated jobs; lists as they are.
VALIDATED = f""", v0 as (select * replace ({null_if_blank('title')} as title, {null_if_blank('description_text')} as description_text, {null_if_blank('company')} as company, {null_if_blank('apply_url')} as apply_url,
    {strip("coalesce(nullif(canonical_source_url, ''), source_url, '')")} as canonical_source_url, {DATE} as posted_date),
    {SQUEEZED} as sq, lower({strip("coalesce(remote, '')")}) as t from jobs),
  v1 as (select * replace (canonical_source_url as source_url, {strip("coalesce(nullif(raw_source_url, ''), canonical_source_url)")} as raw_source_url, {CLEAN} as locations, {REMOTE} as remote) from v0),
  v2 as (select *, list_filter([case when title is null then 'missing_title' end, case when description_text is null then 'missing_description_text' end, case when canonical_source_url = '' then 'missing_canonical_source_url' end, case when coalesce(job_id, '') = '' and canonical_source_url = '' then 'missing_job_identity' end], lambda x: x is not null) as errors,
    list_filter([case when apply_url is null then 'missing_apply_url' end, case when company is null then 'missing_company' end, case when len(locations) = 0 then 'missing_locations' end, case when coalesce(posted_date, '') = '' then 'missing_posted_date' end], lambda x: x is not null) as warnings from v1),
  validated as (select *, case when len(errors) > 0 then 'quarantined' else 'valid' end as record_status from v2)"""
CURATED_SQL = "run_date, job_hash, source_url, raw_source_url, canonical_source_url, portal_key, run_id, scraped_at, input_seed_url, job_id, title, company, array_to_string(locations, '|') as locations, posted_date, remote, employment_type, career_area, ref_number, description_text, apply_url, array_to_string(warnings, '|') as validation_warnings"
HASH = "upper(sha256(" + " || '|' || ".join("coalesce(array_to_string(locations, '|'), '')" if c == "locations" else f"coalesce({c}, '')" for c in ("title", "company", "locations", "posted_date", "remote", "employment_type", "career_area", "ref_number", "description_text", "apply_url")) + "))"
HISTORY_SQL = f", history as (select *, {HASH} as content_hash from snapshots)"
URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
part = lambda c, k: f"regexp_extract({c}, '{URL}', {k})"
host_sql = lambda c: f"lower(regexp_extract(regexp_replace({part(c, 2)}, '^.*@', ''), '^\\[?([^\\]:]*)', 1))"
start_sql = lambda c: f"case when {part(c, 1)} <> '' then lower({part(c, 1)}) || ':' else '' end || case when {part(c, 2)} <> '' then '//' || {part(c, 2)} else '' end"
canonical_sql = lambda c: f"{start_sql(c)} || regexp_replace({part(c, 3)}, '/+', '/', 'g')"
segments_sql = lambda c: f"list_filter(string_split(regexp_replace({part(c, 3)}, ';[^/]*$', ''), '/'), lambda x: x <> '')"
portal_sql = lambda c: f"regexp_replace({host_sql(c)} || '/' || array_to_string(case when coalesce(list_position({segments_sql(c)}, 'careers'), 0) > 0 then list_slice({segments_sql(c)}, 1, list_position({segments_sql(c)}, 'careers')) else list_slice({segments_sql(c)}, 1, 2) end, '/'), '/+$', '')"
PORT = "regexp_extract(" + part("s", 2) + ", ':([0-9]+)$', 1)"
SEEDS_SQL = f""", s0 as (select pos, raw_value, {strip("regexp_replace(" + strip("raw_value") + ", ',+$', '')")} as s from seeds),
  s1 as (select pos, raw_value, case when {host_sql('s')} = '' then s else case when {part('s', 1)} <> '' then lower({part('s', 1)}) else 'https' end || '://' || {host_sql('s')} || case when {PORT} <> '' and cast({PORT} as int) > 0 then ':' || {PORT} else '' end || {part('s', 3)} || case when {part('s', 4)} <> '' then '?' || {part('s', 4)} else '' end end as u from s0),
  s2 as (select *, regexp_matches(u, '(?i)^https?:') as http, list_has_any(list_transform({segments_sql('u')}, lambda x: lower(x)), ['internalcareers', 'internalcareer']) as internal,
    split_part({host_sql('u')}, '.', 1) in ('staging', 'sandbox', 'uat', 'qa', 'test', 'pentest', 'demo', 'training') or list_has_any(list_transform({segments_sql('u')}, lambda x: lower(x)), ['staging', 'sandbox', 'uat', 'qa', 'test', 'pentest', 'demo', 'training']) as marked from s1)"""
CLASSIFIED_SQL = f""", c0 as (select *, case when not http then 'invalid_url' when internal or marked then 'excluded_internal_or_staging' end as early from s2),
  c1 as (select *, coalesce(early, case when row_number() over (partition by u, early is null order by pos) > 1 then 'duplicate' end) as e from c0),
  probes as (select u, min(pos) % 5 <> 0 as dns, case min(pos) % 7 when 0 then 500 when 1 then null else 200 end as status from c1 where early is null group by u),
  classified as (select pos, raw_value, c1.u as normalized_url, coalesce(e, case when {host_sql('c1.u')} = '' then 'invalid_url' when not coalesce(dns, false) then 'dns_unresolvable' when status is null or status >= 400 then 'http_unhealthy' else 'valid_keep' end) as classification,
    case when http then {portal_sql('c1.u')} end as portal_key, case when e is null then coalesce(dns, false) end as dns_resolved, case when e is null then status end as http_status from c1 left join probes on probes.u = c1.u)"""
SUMMARY_SQL = """, summary as (select portal_key, cast(min(pos) % 3 as bigint) as jobs, 0.80 + cast(min(pos) % 4 as double) / 10 as rate, cast(10 as bigint) as responses, cast(min(pos) % 5 as bigint) as errors from classified where classification = 'valid_keep' and pos % 2 = 0 group by portal_key)"""
AUDITED_SQL = SUMMARY_SQL + """, j as (select classified.*, summary.portal_key is not null and classification = 'valid_keep' as known, jobs, rate, cast(errors as double) / responses as error_rate from classified left join summary using (portal_key)),
  audited as (select pos, normalized_url, classification, portal_key, known and jobs > 0 and rate >= 0.9 and error_rate <= 0.25 as recommended, case when known then jobs end as observed_jobs_exported, case when known then rate end as observed_success_rate, case when known then error_rate end as observed_error_rate,
    case when known and jobs > 0 and rate >= 0.9 and error_rate <= 0.25 then 'recent run exported ' || jobs || ' jobs at success rate ' || printf('%.3f', rate) when known then 'recent run did not meet curated thresholds (exported=' || jobs || ', success_rate=' || printf('%.3f', rate) || ')' when classification = 'valid_keep' then 'no recent portal summary for this portal' end as recommendation_reason from j)"""
PORTALS_SQL = """, r as (select portal_key, count(*) as requests_total, count(*) filter (kind = 'listing') as listing_requests_total, count(*) filter (kind = 'pagination') as pagination_requests_total, count(*) filter (kind = 'job_detail') as job_detail_requests_total from requests group by portal_key),
  a as (select portal_key, count(*) as responses_total, count(*) filter (status >= 400) as error_responses_total from requests group by portal_key),
  i as (select portal_key, count(*) as jobs_exported_total, count(*) filter (title <> '') as title, count(*) filter (description_text <> '') as description, count(*) filter (apply_url <> '') as apply_url, count(*) filter (posted_date <> '') as posted_date, count(*) filter (company <> '') as company from validated where record_status = 'valid' group by portal_key),
  d0 as (select portal_key, case when coalesce(status, '') = 'quarantined' or contains(lower(coalesce(message, '')), 'validation failed') or contains(lower(coalesce(message, '')), 'quarantine') then 'quarantine' when contains(lower(coalesce(message, '')), 'duplicate') then 'duplicate' end as reason from drops),
  d as (select portal_key, count(*) filter (reason = 'quarantine') as jobs_quarantined_total, count(*) filter (reason = 'duplicate') as duplicates_dropped_total from d0 where reason is not null group by portal_key),
  k as (select portal_key from r union select portal_key from i union select portal_key from d),
  f as (select portal_key, coalesce(requests_total, 0) as requests_total, coalesce(responses_total, 0) as responses_total, coalesce(error_responses_total, 0) as error_responses_total, coalesce(listing_requests_total, 0) as listing_requests_total, coalesce(pagination_requests_total, 0) as pagination_requests_total, coalesce(job_detail_requests_total, 0) as job_detail_requests_total, coalesce(jobs_exported_total, 0) as jobs_exported_total, coalesce(jobs_quarantined_total, 0) as jobs_quarantined_total, coalesce(duplicates_dropped_total, 0) as duplicates_dropped_total, title, description, apply_url, posted_date, company
    from k left join r using (portal_key) left join a using (portal_key) left join i using (portal_key) left join d using (portal_key)),
  portals as (select portal_key, requests_total, responses_total, error_responses_total, listing_requests_total, pagination_requests_total, job_detail_requests_total, jobs_exported_total, jobs_quarantined_total, duplicates_dropped_total,
    coalesce(case when job_detail_requests_total > 0 then round_even(duplicates_dropped_total / job_detail_requests_total, 6) end, 0.0) as duplicate_rate, case when job_detail_requests_total > 0 then round_even(jobs_exported_total / job_detail_requests_total, 6) end as job_detail_success_rate, """ + ", ".join(f"case when jobs_exported_total > 0 then round_even(cast(100.0 as double) * {c} / jobs_exported_total, 4) end as {c}_completeness_pct" for c in ("title", "description", "apply_url", "posted_date", "company")) + " from f)"


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "jobs").withColumn("raw_fields", F.create_map(F.lit("k"), F.col("k")))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.validate(_jobs(spark, sf_dir))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "snapshots").withColumn("content_hash", content_hash())


def _flat(df: DataFrame) -> DataFrame:
    """Lists as text, for comparing."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


# -- gold and silver -------------------------------------------------------------------------

_have = lambda c: rf"count(*) filter (regexp_matches({c}, '\S'))"
_fields = {"title": "title", "description": "description_text", "apply_url": "apply_url", "posted_date": "posted_date", "company": "company"}


@query(with_views("jobs") + VALIDATED + " select run_date, portal_key, count(*) as jobs_exported_total, " + ", ".join(f"{_have(c)} as {n}_present_total, cast(100.0 as double) * {_have(c)} / count(*) as {n}_completeness_pct" for n, c in _fields.items()) + ", count(*) filter (remote = 'remote') as remote_jobs_total, count(*) filter (remote = 'hybrid') as hybrid_jobs_total, count(*) filter (remote = 'onsite') as onsite_jobs_total, count(*) filter (remote = 'unknown') as unknown_remote_jobs_total from validated where record_status = 'valid' group by run_date, portal_key")
def gold_portal_daily_summary(spark, sf_dir):
    return lakehouse.portal_daily_summary(lakehouse.curated(_validated(spark, sf_dir)))


@query(with_views("jobs") + VALIDATED + f" select {CURATED_SQL} from validated where record_status = 'valid'")
def silver_curated_promote(spark, sf_dir):
    return _flat(lakehouse.curated(_validated(spark, sf_dir)))


@query(with_views("jobs") + VALIDATED + f", valid as (select * from validated where record_status = 'valid' and run_date = '{SPLIT_DAY}') select {CURATED_SQL} from valid where job_hash not in (select job_hash from valid where event_id % 2 = 0)")
def silver_incremental_antijoin(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return _flat(lakehouse.new_rows(lakehouse.curated(v), lakehouse.curated(v.filter("event_id % 2 = 0")), SPLIT_DAY))


@query(with_views("snapshots") + HISTORY_SQL + " select job_hash, run_date, content_hash from history")
def history_content_hash(spark, sf_dir):
    return _snapshots(spark, sf_dir).select("job_hash", "run_date", "content_hash")


@query(with_views("snapshots") + HISTORY_SQL + f" select job_hash, run_date, content_hash from history where run_date = '{SPLIT_DAY}' and event_id % 3 <> 0")
def history_incremental_antijoin(spark, sf_dir):
    s = _snapshots(spark, sf_dir)
    return lakehouse.new_rows(s, s.filter("event_id % 3 = 0"), SPLIT_DAY).select("job_hash", "run_date", "content_hash")


EVENT_COLUMNS = "portal_key, job_hash, job_id, title, company, source_url, content_hash"


@query(with_views("snapshots") + HISTORY_SQL + f""", days as (select run_date, lead(run_date) over (order by run_date) as following from (select distinct run_date from history)),
  s as (select *, lag(content_hash) over w as ph, lag(run_date) over w as pd, lead(run_date) over w as nd from history window w as (partition by job_hash order by run_date))
  select run_date as event_run_date, {EVENT_COLUMNS}, ph as previous_content_hash, pd as previous_run_date, 'new_job' as event_type from s where pd is null
  union all select run_date, {EVENT_COLUMNS}, ph, pd, 'updated_job' from s where pd is not null and ph is distinct from content_hash
  union all select following, {EVENT_COLUMNS}, content_hash, run_date, 'missing_from_latest_run' from s join days using (run_date) where following is not null and (nd is null or nd <> following)""")
def gold_change_events(spark, sf_dir):
    return lakehouse.change_events(_snapshots(spark, sf_dir))


RESTATED = f", r0 as (select * replace (case when run_date = '{SPLIT_DAY}' and event_id % 5 = 0 then upper(content_hash) || '*' else content_hash end as content_hash) from history where not (run_date = '{SPLIT_DAY}' and event_id % 7 = 0))"


@query(ORACLE_SQL["gold_change_events"].replace("from history", "from r0").replace(", days as", RESTATED + ", days as"))
def restated_change_events(spark, sf_dir):
    """One day is restated, with jobs gone and others changed: only dates that this may touch are worked out again."""
    from careerlake.shared import saved

    before, wrong = saved(_snapshots(spark, sf_dir), "snapshots"), F.col("run_date") == SPLIT_DAY
    after = before.filter(~(wrong & (F.col("event_id") % 7 == 0))).withColumn("content_hash", F.when(wrong & (F.col("event_id") % 5 == 0), F.concat(F.upper("content_hash"), F.lit("*"))).otherwise(F.col("content_hash")))
    return lakehouse.restated_events(saved(lakehouse.change_events(before), "events"), before, after, SPLIT_DAY)


@query(with_views("snapshots") + HISTORY_SQL + ", l as (select max(run_date) as latest_run_date from history), g as (select job_hash, " + ", ".join(f"arg_max_null({c}, run_date) as {c}" for c in lakehouse.LATEST if c != "locations") + ", array_to_string(arg_max_null(locations, run_date), '|') as locations, arg_max_null(content_hash, run_date) as latest_content_hash, min(run_date) as first_seen_run_date, max(run_date) as last_seen_run_date, count(*) as snapshot_count from history group by job_hash) select g.*, latest_run_date, last_seen_run_date < latest_run_date as missing_from_latest_run from g, l")
def gold_lifecycle_summary(spark, sf_dir):
    return _flat(lakehouse.lifecycle_summary(_snapshots(spark, sf_dir)))


@query(with_views("snapshots") + " select run_date, lead(run_date) over (order by run_date) as next_run_date from (select distinct run_date from snapshots)")
def run_date_calendar(spark, sf_dir):
    return lakehouse.run_calendar(view(spark, sf_dir, "snapshots"))


@query(with_views("snapshots") + " select job_hash, title, run_date from snapshots where run_date between '2024-01-09' and '2024-01-12'")
def projected_days(spark, sf_dir):
    """Days of a feed by folders made from the dates; the feed is the snapshots, written by day."""
    from careerlake import shared
    from careerlake.sources import readers

    at = shared.scratch(spark, "feed")
    view(spark, sf_dir, "snapshots").select("job_hash", "title", "run_date").write.partitionBy("run_date").json(at)
    return readers.projected(spark, at, StructType.fromDDL("job_hash string, title string"), "2024-01-09", "2024-01-12").select("job_hash", "title", "run_date")


@query(with_views("snapshots") + " select distinct run_date from snapshots where cast(run_date as date) < date '2024-01-30' - 14")
def retention_partitions(spark, sf_dir):
    return lakehouse.expired_partitions(view(spark, sf_dir, "snapshots"), "2024-01-30", 14)


# -- records ---------------------------------------------------------------------------------


@query(with_views("jobs") + VALIDATED + " select event_id, canonical_source_url, source_url, raw_source_url, title, description_text, company, apply_url, array_to_string(locations, '|') as locations, remote, posted_date, array_to_string(errors, '|') as validation_errors, array_to_string(warnings, '|') as validation_warnings, record_status from validated")
def validate_records(spark, sf_dir):
    return _flat(_validated(spark, sf_dir).select("event_id", "canonical_source_url", "source_url", "raw_source_url", "title", "description_text", "company", "apply_url", "locations", "remote", "posted_date", "validation_errors", "validation_warnings", "record_status"))


@query(with_views("jobs") + VALIDATED + " select kind, issue, count(*) as n from (select 'error' as kind, unnest(errors) as issue from validated union all select 'warning', unnest(warnings) from validated) group by kind, issue")
def validation_issue_counts(spark, sf_dir):
    return records.issue_counts(_validated(spark, sf_dir))


@query(with_views("jobs") + VALIDATED + " select event_id, array_to_string(errors, '|') as errors, array_to_string(warnings, '|') as warnings, title, record_status from validated where record_status = 'quarantined'")
def quarantine_records(spark, sf_dir):
    q = records.quarantined(_validated(spark, sf_dir), F.lit("2026-01-01T00:00:00+00:00"))
    return _flat(q.select("item.event_id", "errors", "warnings", "item.title", "item.record_status"))


@query(with_views("jobs") + f" select event_id, {REMOTE} as remote from (select event_id, lower({strip(chr(99) + 'oalesce(remote, ' + repr('') + ')')}) as t from jobs)")
def normalize_remote(spark, sf_dir):
    return view(spark, sf_dir, "jobs").select("event_id", text.normalize_remote(F.col("remote")).alias("remote"))


@query(with_views("jobs") + f" select event_id, array_to_string({CLEAN}, '|') as locations from (select event_id, {SQUEEZED} as sq from jobs)")
def clean_locations(spark, sf_dir):
    return view(spark, sf_dir, "jobs").select("event_id", F.array_join(text.clean_locations(F.col("locations")), "|").alias("locations"))


@query(with_views("jobs") + f" select event_id, {DATE} as posted_date from jobs")
def normalize_posted_date(spark, sf_dir):
    """The lenient parser included; the table's only text that isn't a date stays."""
    return dates.normalize_dates(view(spark, sf_dir, "jobs").select("event_id", "posted_date"), "posted_date", "2026-03-26")


@query(with_views("jobs") + f" select event_id, job_id, sha256(portal_key || '|' || coalesce(nullif(job_id, ''), u)) as identity from (select *, {canonical_sql('source_url')} as u from jobs)")
def job_identity(spark, sf_dir):
    return view(spark, sf_dir, "jobs").select("event_id", "job_id", job_hash(F.col("portal_key"), F.col("job_id"), urls.canonicalize_detail_url(F.col("source_url"))).alias("identity"))


@query(with_views("drops") + " select event_id, case when coalesce(status, '') = 'quarantined' or contains(lower(coalesce(message, '')), 'validation failed') or contains(lower(coalesce(message, '')), 'quarantine') then 'quarantine' when contains(lower(coalesce(message, '')), 'duplicate') then 'duplicate' end as reason from drops")
def drop_reasons(spark, sf_dir):
    return view(spark, sf_dir, "drops").select("event_id", records.drop_reason(F.col("status"), F.col("message")).alias("reason"))


# -- duplicates ------------------------------------------------------------------------------

HASHED = ", h as (select event_id, ts, run_date, portal_key, case when event_id % 50 = 0 then null else job_hash end as job_hash from jobs)"


def _hashed(spark, sf_dir):
    return view(spark, sf_dir, "jobs").withColumn("job_hash", F.when(F.col("event_id") % 50 != 0, F.col("job_hash")))


@query(with_views("jobs") + HASHED + " select event_id, job_hash, run_date from (select *, row_number() over (partition by job_hash order by ts, event_id) as place from h) where job_hash is null or place = 1")
def in_run_dedupe(spark, sf_dir):
    return dedupe.first_in_run(_hashed(spark, sf_dir), ["ts", "event_id"]).select("event_id", "job_hash", "run_date")


@query(with_views("jobs") + HASHED + " select count(job_hash) - count(distinct job_hash) as duplicates_dropped_total from h")
def in_run_duplicates(spark, sf_dir):
    return dedupe.duplicates_in_run(_hashed(spark, sf_dir))


REGISTRY_SQL = f", old as (select job_hash, min(cast(epoch(ts) as bigint)) as seen from h where run_date < '{SPLIT_DAY}' and user_id % 3 <> 0 and job_hash is not null group by job_hash)"
SEEN = HASHED.replace("portal_key,", "portal_key, user_id, run_id, source_url,")


def _registry(spark, sf_dir, ttl_days):
    old = _hashed(spark, sf_dir).filter((F.col("run_date") < SPLIT_DAY) & (F.col("user_id") % 3 != 0) & F.col("job_hash").isNotNull())
    at = F.min(F.unix_timestamp(F.col("ts").cast("timestamp"))).alias("first_seen_ts")
    return old.groupBy("job_hash").agg(at).withColumn("expires_at", F.col("first_seen_ts") + ttl_days * 86_400)


def _late(spark, sf_dir):
    return _hashed(spark, sf_dir).filter(F.col("run_date") >= SPLIT_DAY)


@query(with_views("jobs") + SEEN + REGISTRY_SQL + f", b as (select *, row_number() over (partition by job_hash order by ts, event_id) as place from h where run_date >= '{SPLIT_DAY}') select event_id, job_hash, run_date from b where (place = 1 or job_hash is null) and not exists (select 1 from old where old.job_hash = b.job_hash)")
def cross_run_first_seen(spark, sf_dir):
    now = F.lit(1_705_276_800)  # the day's start
    return dedupe.first_seen(_late(spark, sf_dir), _registry(spark, sf_dir, 60), now, ["ts", "event_id"])[0].select("event_id", "job_hash", "run_date")


@query(with_views("jobs") + SEEN + REGISTRY_SQL + f", live as (select job_hash from old where seen + 14 * 86400 - 3600 > 1705276800), b as (select *, row_number() over (partition by job_hash order by ts, event_id) as place from h where run_date >= '{SPLIT_DAY}' and job_hash is not null) select job_hash, run_id as first_seen_run_id, portal_key, source_url, cast(1705276800 as bigint) as first_seen_ts, cast(1705276800 + 14 * 86400 as bigint) as expires_at from b where place = 1 and job_hash not in (select job_hash from live)")
def registry_ttl_entries(spark, sf_dir):
    registry = _registry(spark, sf_dir, 14).withColumn("expires_at", F.col("expires_at") - 3600)
    return dedupe.first_seen(_late(spark, sf_dir), registry, F.lit(1_705_276_800), ["ts", "event_id"], ttl_days=14)[1]


PUT_SQL = f""", mine as (select *, user_id % 2 as side, row_number() over (partition by job_hash, event_id % 2 order by ts, event_id) as place from h where run_date >= '{SPLIT_DAY}' and job_hash is not null),
  late as (select job_hash, 'late' as run, run_id, portal_key, source_url from mine where event_id % 2 = 1 and place = 1 and job_hash not in (select job_hash from old)),
  early as (select job_hash, 'early' as run, run_id, portal_key, source_url from mine where event_id % 2 = 0 and place = 1 and job_hash not in (select job_hash from old) and job_hash not in (select job_hash from late))"""


@query(with_views("jobs") + SEEN + REGISTRY_SQL + PUT_SQL + " select job_hash, run as first_seen_run_id, portal_key, source_url from late union all select job_hash, run, portal_key, source_url from early union all select job_hash, 'old', null, null from old")
def registry_of_overlapping_runs(spark, sf_dir):
    """Two runs put their jobs at once: the one that began first commits last, and keeps only jobs that the other hasn't."""
    from careerlake import shared
    from careerlake.sources.registry_log import RegistryLog, put

    log = RegistryLog(spark, shared.scratch(spark, "registry"))
    none = F.lit(None).cast("string")
    old = _registry(spark, sf_dir, 60).select("job_hash", F.lit("old").alias("first_seen_run_id"), none.alias("portal_key"), none.alias("source_url"), "first_seen_ts", "expires_at")
    log.commit(1, [log.write(old, "old")])
    batch, order = _late(spark, sf_dir), ["ts", "event_id"]
    now = F.lit(1_705_276_800)
    late = lambda n: n == 2 and put(log, batch.filter("event_id % 2 = 1"), "late", now, order)  # noqa: E731  between the other's reading and its commit
    put(log, batch.filter("event_id % 2 = 0"), "early", now, order, before_commit=late)
    return log.entries().select("job_hash", "first_seen_run_id", "portal_key", "source_url")


@query(with_views("jobs") + SEEN + REGISTRY_SQL.replace("cast(epoch(ts) as bigint)", "cast(floor(epoch(ts)) as bigint)") + " select job_hash, case when seen + 14 * 86400 > 1705276800 then 'old' else 'again' end as first_seen_run_id, case when seen + 14 * 86400 > 1705276800 then seen else seen + 86400 end as first_seen_ts, case when seen + 14 * 86400 > 1705276800 then seen + 14 * 86400 else seen + 15 * 86400 end as expires_at from old where seen + 15 * 86400 > 1705276800")
def registry_compacted(spark, sf_dir):
    """Two folders of entries, the later ones a day after the first, merged: expired ones go, of live ones the first sight stays."""
    from careerlake import shared
    from careerlake.sources.registry_log import RegistryLog, compact, vacuum

    log, none = RegistryLog(spark, shared.scratch(spark, "registry")), F.lit(None).cast("string")
    first = _registry(spark, sf_dir, 14).select("job_hash", F.lit("old").alias("first_seen_run_id"), none.alias("portal_key"), none.alias("source_url"), "first_seen_ts", "expires_at")
    later = first.withColumns({"first_seen_run_id": F.lit("again"), "first_seen_ts": F.col("first_seen_ts") + 86_400, "expires_at": F.col("expires_at") + 86_400})
    for version, (name, entries) in enumerate((("old", first), ("again", later)), 1):
        log.commit(version, [*log.last()[1], log.write(entries, name)])
    compact(log, F.lit(1_705_276_800))
    vacuum(log)
    return log.entries().select("job_hash", "first_seen_run_id", "first_seen_ts", "expires_at")


THIRDS = ("2024-01-11", "2024-01-21")


@query(f"""with recursive {with_views("jobs")[5:]}, h as (select job_hash, run_id, portal_key, source_url, cast(epoch(cast(run_date as timestamp)) as bigint) as seen, ts, event_id from jobs where event_id % 50 <> 0),
  f as (select * from (select *, row_number() over (partition by job_hash, seen order by ts, event_id) as place from h) where place = 1),
  e as (select * exclude (n) from (select *, row_number() over (partition by job_hash order by seen) as n from f) where n = 1
    union all select * exclude (n) from (select f.*, row_number() over (partition by f.job_hash order by f.seen) as n from e join f on f.job_hash = e.job_hash and f.seen >= e.seen + 5 * 86400) where n = 1)
  select job_hash, run_id as first_seen_run_id, portal_key, source_url, seen as first_seen_ts, seen + 5 * 86400 as expires_at from e""")
def registry_stream(spark, sf_dir):
    """The registry as the state of a stream, which is run three times over what has come: entries expire five days after a first sight."""
    from careerlake import shared
    from careerlake.streaming import records as stream
    from careerlake.streaming import registry

    rows = _hashed(spark, sf_dir).select("job_hash", "run_id", "portal_key", "source_url", "run_date", "ts", "event_id")
    at, out, state = (shared.scratch(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    for first, last in zip(("", *THIRDS), (*THIRDS, "9"), strict=True):
        rows.filter((F.col("run_date") >= first) & (F.col("run_date") < last)).write.mode("append").parquet(at)
        with registry.rocks_state(spark):
            come = spark.readStream.schema(rows.schema).parquet(at)
            stream.run_available(registry.first_sights(come, F.to_timestamp("run_date"), ["ts", "event_id"], ttl_days=5), out, state).awaitTermination()
    return spark.read.parquet(out)


# -- URLs ------------------------------------------------------------------------------------


def _links(name, column):
    def run(spark, sf_dir):
        return view(spark, sf_dir, "links").select("page_id", column(F.col("url")).alias(name))

    return run


def _url_query(key, name, column, sql):
    QUERIES[key] = _links(name, column)
    ORACLE_SQL[key] = with_views("links") + f" select page_id, {sql} as {name} from links"


_url_query("canonicalize_urls", "canonical_url", urls.canonicalize_detail_url, canonical_sql("url"))
_url_query("portal_keys", "portal_key", urls.portal_key, portal_sql("url"))
_url_query("url_hosts", "host", urls.host, host_sql("url"))
_url_query("url_job_ids", "job_id", urls.job_id, "nullif(regexp_extract(url, '/([0-9]{3,})(?:[/?#]|$)', 1), '')")
_param = lambda n: f"nullif(regexp_extract({part('url', 4)}, '(?:^|&){n}=([^&]+)', 1), '')"
_url_query("job_offsets", "job_offset", urls.job_offset, f"coalesce(try_cast({_param('jobOffset')} as int), 0)")
_url_query("unwrap_job_hrefs", "target", urls.unwrap_job_href, f"coalesce(url_decode(url_decode(replace(coalesce({_param('shareUrl')}, {_param('url')}), '+', ' '))), url)")


LINKED = """case page_id % 7 when 0 then 'a//./b' when 1 then concat('../x?y=', cast(page_id as {text})) when 2 then '/root/q/.././z' when 3 then concat('?jobOffset=', cast(page_id as {text})) when 4 then '#top' when 5 then 'mailto:a@b' else concat('//other.example.com/', cast(page_id as {text})) end"""
_plain_url = "regexp_replace(url, '[?#].*$', '')"
_folder = f"regexp_replace({_plain_url}, '[^/]*$', '')"


@query(f"select page_id, case page_id % 7 when 0 then {_folder} || 'a/b' when 1 then case when regexp_matches({_folder}, '^https?://[^/]*/$') then {_folder} else regexp_replace({_folder}, '[^/]+/$', '') end || 'x?y=' || page_id when 2 then regexp_extract(url, '^https?://[^/?#]*') || '/root/z' when 3 then {_plain_url} || '?jobOffset=' || page_id when 4 then regexp_replace(url, '#.*$', '') || '#top' when 5 then 'mailto:a@b' else regexp_extract(url, '^https?:') || '//other.example.com/' || page_id end as target from pages")
def joined_links(spark, sf_dir):
    """Relative links of all kinds resolved against the pages' URLs by expressions."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id", "url", LINKED.format(text="string") + " as link").select("page_id", urls.join_url(F.col("url"), F.col("link")).alias("target"))


# -- seeds -----------------------------------------------------------------------------------


def _classified(spark, sf_dir):
    s = view(spark, sf_dir, "seeds")
    at = s.select("pos", urls.normalize_seed_url(F.col("raw_value")).alias("url"))
    live = at.filter(urls.has_http_scheme(F.col("url")) & ~urls.is_nonproduction(F.col("url"))).groupBy("url").agg(F.min("pos").alias("p"))
    status = F.when(F.col("p") % 7 == 0, 500).when(F.col("p") % 7 != 1, 200)
    return seeds.classify(s, live.select("url", (F.col("p") % 5 != 0).alias("dns_resolved"), status.alias("http_status"), F.lit(None).cast("string").alias("reason")))


def _audited(spark, sf_dir):
    c = _classified(spark, sf_dir)
    first = c.filter("classification = 'valid_keep' and pos % 2 = 0").groupBy("portal_key").agg(F.min("pos").alias("p"))
    summary = first.select("portal_key", (F.col("p") % 3).alias("jobs_exported_total"), (F.lit(0.8) + (F.col("p") % 4).cast("double") / 10).alias("job_detail_success_rate"), F.lit(10).alias("responses_total"), (F.col("p") % 5).alias("error_responses_total"))
    return seeds.recommend(c, summary)


@query(with_views("seeds") + SEEDS_SQL + " select pos, u as url from s2 where http and not internal")
def seed_load(spark, sf_dir):
    return seeds.load(view(spark, sf_dir, "seeds"))


@query(with_views("seeds") + f" select row_number() over (order by pos) - 1 as pos, {strip('raw_value')} as raw_value from seeds")
def seed_files_in_order(spark, sf_dir):
    """The places of seeds over several files, by name: the list is written as files of a range of it each, and read again."""
    from careerlake import shared
    from careerlake.sources import readers

    at = shared.scratch(spark, "seed-files")
    ranges = view(spark, sf_dir, "seeds").repartitionByRange(5, "pos").sortWithinPartitions("pos")
    ranges.select(F.col("raw_value").alias("URL")).write.option("header", True).csv(at)
    return readers.seed_csv(spark, at)


@query(with_views("seeds") + SEEDS_SQL + f" select pos, u as url, {portal_sql('u')} as portal_key, 'listing' as request_kind, u as input_seed_url from s2 where http and not internal")
def seed_requests(spark, sf_dir):
    return seeds.requests(seeds.load(view(spark, sf_dir, "seeds")))


@query(with_views("seeds") + SEEDS_SQL + f" select count(*) as input_seed_count, array_to_string(list_sort(list(distinct {host_sql('u')})), '|') as hosts from s2 where http and not internal")
def seed_hosts(spark, sf_dir):
    return _flat(seeds.allowed_hosts(seeds.load(view(spark, sf_dir, "seeds"))))


@query(with_views("seeds") + SEEDS_SQL + CLASSIFIED_SQL + " select * replace (cast(http_status as double) as http_status) from classified")
def seed_classification(spark, sf_dir):
    return _classified(spark, sf_dir).drop("reason").withColumn("http_status", F.col("http_status").cast("double"))


@query(with_views("seeds") + SEEDS_SQL + CLASSIFIED_SQL + AUDITED_SQL + " select * replace (cast(observed_jobs_exported as double) as observed_jobs_exported) from audited")
def seed_recommendation(spark, sf_dir):
    return _audited(spark, sf_dir).select("pos", "normalized_url", "classification", "portal_key", "recommended", F.col("observed_jobs_exported").cast("double").alias("observed_jobs_exported"), "observed_success_rate", "observed_error_rate", "recommendation_reason")


@query(with_views("seeds") + SEEDS_SQL + CLASSIFIED_SQL + AUDITED_SQL + " select name, cast(sum(n) as bigint) as n from (select classification as name, count(*) as n from audited group by 1 union all select 'total', count(*) from audited union all select 'recommended', count(*) filter (recommended) from audited) group by name")
def seed_audit_totals(spark, sf_dir):
    return seeds.audit_totals(_audited(spark, sf_dir))


# -- telemetry -------------------------------------------------------------------------------


def _portals(spark, sf_dir):
    asked = view(spark, sf_dir, "requests")
    d = view(spark, sf_dir, "drops").select("portal_key", records.drop_reason(F.col("status"), F.col("message")).alias("reason")).filter("reason is not null")
    return telemetry.portal_rows(asked, asked, records.valid(_validated(spark, sf_dir)), d)


PORTAL_VIEWS = with_views("jobs", "requests", "drops") + VALIDATED + PORTALS_SQL


@query(PORTAL_VIEWS + " select * from portals")
def portal_summary_rows(spark, sf_dir):
    return telemetry.ranked(_portals(spark, sf_dir))


RUN_SQL = "select cast(sum(jobs_exported_total) as bigint) as jobs_exported_total, cast(sum(jobs_quarantined_total) as bigint) as jobs_quarantined_total, cast(sum(duplicates_dropped_total) as bigint) as duplicates_dropped_total, cast(sum(job_detail_requests_total) as bigint) as job_detail_requests_total, cast(greatest(sum(job_detail_requests_total) - sum(jobs_exported_total), 0, 7) as bigint) as job_detail_parse_failure_total, case when sum(job_detail_requests_total) > 0 then round_even(cast(sum(jobs_exported_total) as double) / sum(job_detail_requests_total), 6) end as job_detail_success_rate, count(*) as portal_summary_count from portals"


@query(PORTAL_VIEWS + " " + RUN_SQL)
def run_summary(spark, sf_dir):
    return telemetry.run_summary(_portals(spark, sf_dir), exceptions=7)


_filled = {c: ("len(locations) > 0" if c == "locations" else f"{c} <> ''") for c in telemetry.RUN_FIELDS}
COUNTERS_SQL = f"select count(*) as jobs_exported_total, count(distinct nullif({host_sql('source_url')}, '')) as unique_hosts, count(distinct portal_key) as unique_portals, " + ", ".join(f"count(*) filter ({t}) as {c}_present_total, coalesce(round_even(cast(100.0 as double) * count(*) filter ({t}) / nullif(count(*), 0), 4), 0) as {c}_completeness_pct" for c, t in _filled.items()) + " from validated where record_status = 'valid'"


@query(with_views("jobs") + VALIDATED + " " + COUNTERS_SQL)
def field_completeness(spark, sf_dir):
    return telemetry.run_counters(records.valid(_validated(spark, sf_dir)))


@query(with_views("requests") + " select kind, cast(coalesce(status, 0) // 100 as varchar) || 'xx' as bucket, count(*) as responses from requests group by 1, 2")
def status_buckets(spark, sf_dir):
    return telemetry.response_buckets(view(spark, sf_dir, "requests"))


@query(with_views("requests") + f" select portal_key, count(*) as responses_total, count(*) filter (status is null or status in {telemetry.RETRIED}) as retried_total, round_even(count(*) filter (status is null or status in {telemetry.RETRIED}) / count(*), 6) as retried_rate from requests group by portal_key")
def retried_responses(spark, sf_dir):
    return telemetry.retried_responses(view(spark, sf_dir, "requests"))


@query(with_views("requests") + " select portal_key, kind, count(*) as requests from requests group by 1, 2 union all select '*', kind, count(*) from requests group by kind")
def request_counts(spark, sf_dir):
    return telemetry.request_counts(view(spark, sf_dir, "requests"))


WINDOW = "select time_bucket(interval '{w}', ts, timestamp '2000-01-01') as window_start, name, case name {cases} end as value from metrics where name in ({names}) group by 1, 2"


@query(with_views("metrics") + ", m as (" + WINDOW.format(w="24 hours", names="'RunFailed', 'JobsExported', 'JobDetailSuccessRate'", cases="when 'RunFailed' then sum(value) when 'JobsExported' then max(value) else round(avg(value), 9) end".replace(" end", "")) + ") select window_start, name, value, (name = 'RunFailed' and value >= 1) or (name = 'JobsExported' and value < 1) or (name = 'JobDetailSuccessRate' and value < 0.95) as breaching from m")
def alarm_windows_24h(spark, sf_dir):
    out = telemetry.alarms(view(spark, sf_dir, "metrics").withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    return out.withColumn("value", F.when(F.col("name") == "JobDetailSuccessRate", F.round("value", 9)).otherwise(F.col("value")))


@query(with_views("metrics") + ", m as (" + WINDOW.format(w="5 minutes", names="'QueueDepth'", cases="when 'QueueDepth' then max(value)") + ") select window_start, name, value, value >= 1 as breaching from m")
def queue_windows_5min(spark, sf_dir):
    return telemetry.alarms(view(spark, sf_dir, "metrics"), {"QueueDepth": ("max", ">=", 1.0)}, "5 minutes")


@query(with_views("metrics") + " " + WINDOW.format(w="24 hours", names="'RunFailed', 'JobsExported', 'QueueDepth'", cases="when 'RunFailed' then sum(value) when 'JobsExported' then sum(value) else max(value)"))
def dashboard_series(spark, sf_dir):
    return telemetry.metric_windows(view(spark, sf_dir, "metrics"), {"RunFailed": "sum", "JobsExported": "sum", "QueueDepth": "max"})


RUNS_SQL = ", runs as (select run_date as run_id, case when min(event_id) % 6 = 0 then 'cancelled' else 'finished' end as close_reason, count(*) filter (event_type <> 'error' and user_id % 3 = 0 and run_date > '2024-01-03') as e, count(*) filter (event_type = 'error' and user_id % 4 <> 0) as q, case when min(event_id) % 7 = 0 then null else 0.7 + cast(min(event_id) % 5 as double) / 20 end as r from jobs group by run_date), g as (select *, case when e + q = 0 then 1.0 else q / (e + q) end as rate from runs)"


@query(with_views("jobs") + RUNS_SQL + " select run_id, close_reason, e as jobs_exported_total, q as jobs_quarantined_total, r as job_detail_success_rate, rate as quarantine_rate, case when close_reason <> 'finished' then 'close_reason' when e <= 0 then 'no_jobs' when rate > 0.2 then 'quarantine_rate' when r is null or r < 0.75 then 'success_rate' end as failure from g")
def smoke_gate(spark, sf_dir):
    j = view(spark, sf_dir, "jobs")
    first = F.min("event_id")
    runs = j.groupBy(F.col("run_date").alias("run_id")).agg(
        F.when(first % 6 == 0, "cancelled").otherwise("finished").alias("close_reason"),
        F.count_if((F.col("event_type") != "error") & (F.col("user_id") % 3 == 0) & (F.col("run_date") > "2024-01-03")).alias("jobs_exported_total"),
        F.count_if((F.col("event_type") == "error") & (F.col("user_id") % 4 != 0)).alias("jobs_quarantined_total"),
        F.when(first % 7 != 0, F.lit(0.7) + (first % 5).cast("double") / 20).alias("job_detail_success_rate"),
    )
    return gate.checked(runs)


def _manifest(spark, sf_dir):
    found = view(spark, sf_dir, "links").agg(F.count_distinct(urls.canonicalize_detail_url(F.col("url"))).alias("jobs_discovered_total"))
    run = {"run_id": "r1", "run_date": SPLIT_DAY, "finished_at": f"{SPLIT_DAY}T10:00:00Z", "close_reason": "finished", "project": "careerlake", "stage": "test"}
    return telemetry.manifest(telemetry.run_counters(records.valid(_validated(spark, sf_dir))), telemetry.run_summary(_portals(spark, sf_dir), exceptions=7), found, run, 12.5)


MANIFEST_VIEWS = with_views("jobs", "requests", "drops", "links") + VALIDATED + PORTALS_SQL + f", c as ({COUNTERS_SQL}), s as ({RUN_SQL}), n as (select count(distinct {canonical_sql('url')}) as jobs_discovered_total from links), x as (select n.jobs_discovered_total, s.job_detail_requests_total, c.jobs_exported_total, s.jobs_quarantined_total, s.duplicates_dropped_total, s.job_detail_success_rate, c.description_text_completeness_pct as description_completeness_pct, c.apply_url_completeness_pct, c.posted_date_completeness_pct from c, s, n)"


@query(MANIFEST_VIEWS + f" select 'r1' as run_id, '{SPLIT_DAY}' as run_date, 'finished' as close_reason, cast(12.5 as double) as run_duration_seconds, * from x")
def run_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).select("run_id", "run_date", "close_reason", "run_duration_seconds", "counts.*", "quality.*")


@query(MANIFEST_VIEWS + " select name, value from (select 'JobsExported' as name, cast(jobs_exported_total as double) as value from x union all select 'JobsQuarantined', jobs_quarantined_total from x union all select 'DuplicatesDropped', duplicates_dropped_total from x union all select 'JobsDiscovered', jobs_discovered_total from x union all select 'JobDetailSuccessRate', job_detail_success_rate from x union all select 'RunDurationSeconds', 12.5 union all select 'RunFailed', 0)")
def run_metrics(spark, sf_dir):
    return telemetry.run_metrics(_manifest(spark, sf_dir)).select("name", "value")


@query(with_views("requests") + " select portal_key, event_id, kind from (select *, row_number() over (partition by portal_key order by event_id desc) as place from requests) where place = 1")
def last_row_wins(spark, sf_dir):
    from careerlake.sources.readers import last_row_wins as pick

    return pick(view(spark, sf_dir, "requests").select("portal_key", "event_id", "kind"), "portal_key", "event_id")


@query(with_views("requests") + " select count(*) as exported, count(*) filter (status >= 400) as failed from requests")
def request_totals(spark, sf_dir):
    r = view(spark, sf_dir, "requests")
    return r.agg(F.count("*").alias("exported"), F.count_if(F.col("status") >= 400).alias("failed"))


# -- extraction ------------------------------------------------------------------------------

RAW_LABELS = ["Job Number:", " Location(s): ", "Location :", "REMOTE?", "Time Type", "Salary"]


@query("with l as (select event_id, [" + ", ".join(f"'{x}'" for x in RAW_LABELS) + "][1 + event_id % 6] as label from events), n as (select *, replace(lower(trim(label)), ':', '') as normalized from l), m(name, field) as (values " + ", ".join(f"('{k}', '{v}')" for k, v in extraction.LABELS.items()) + ") select event_id, label, normalized, field from n left join m on name = normalized")
def label_map_lookup(spark, sf_dir):
    at = F.element_at(F.array(*map(F.lit, RAW_LABELS)), (F.col("event_id") % 6 + 1).cast("int"))
    return extraction.label_fields(spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", at.alias("label")))


def _pages(spark, sf_dir):
    none = F.lit(None).cast("string")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", "html", none.alias("portal_key"), none.alias("input_seed_url"))


_no_text = ", ".join(f"cast(null as varchar) as {c}" for c in ("input_seed_url", "company", "posted_date", "remote", "employment_type", "career_area", "ref_number", "description_text", "apply_url"))
_page_title = "regexp_replace(replace(replace(replace(replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&amp;', '&'), '^\\s+|\\s+$', '', 'g')"


@query(f"""with p as (select *, {canonical_sql('url')} as c from pages where url is not null and html is not null), q as (select *, {portal_sql('c')} as portal, nullif(regexp_extract(c, '/([0-9]{{3,}})(?:[/?#]|$)', 1), '') as job from p)
  select portal as portal_key, {_no_text}, cast(null as varchar[]) as locations, job as job_id, nullif({_page_title}, '') as title, url as raw_source_url, c as canonical_source_url, c as source_url, sha256(portal || '|' || coalesce(job, c)) as job_hash, 'r1' as run_id, '{SPLIT_DAY}' as run_date, '{SPLIT_DAY}T00:00:00+00:00' as scraped_at from q""")
def extract_pages(spark, sf_dir):
    got = extraction.extract_jobs(_pages(spark, sf_dir), "r1", SPLIT_DAY, f"{SPLIT_DAY}T00:00:00+00:00")
    return got.drop("raw_fields")


LISTING = "'<article class=\"article article--result\"><a href=\"/careers/JobDetail/A/' || {id} || '?x=1\">A</a> <a href=\"/careers//JobDetail/A/' || {id} || '\">again</a><a href=\"mailto:jobs@example.com?subject=/JobDetail/' || {id} || '\">mail</a><a href=\"javascript:open(/JobDetail/)\">open</a></article><a href=\"?jobOffset=10\">1</a><a href=\"?jobOffset=20\">2</a>'"


@query(f"with p as (select page_id, 'https://h' || page_id || '.example.com/careers/SearchJobs' as url from pages) select url, 'h' || page_id || '.example.com/careers' as portal_key, 'https://h' || page_id || '.example.com/careers/JobDetail/A/' || page_id as target, 'job_detail' as request_kind, 0 as place from p union all select url, 'h' || page_id || '.example.com/careers', url || '?jobOffset=20', 'pagination', 1 from p")
def listing_links(spark, sf_dir):
    return _listing(spark, sf_dir).drop("input_seed_url")


@query(ORACLE_SQL["listing_links"])
def listing_links_in_sql(spark, sf_dir):
    """The same by the table function, joined laterally in SQL."""
    from careerlake.functions import tables

    tables.register(spark)
    pages = _listing_pages(spark, sf_dir).select("url", "html")
    rows = spark.sql("select p.url, l.* from {pages} p, lateral listing_links(p.url, p.html) l", pages=pages)
    return rows.select("url", urls.portal_key(F.col("target")).alias("portal_key"), "target", "request_kind", "place")


def _listing(spark, sf_dir):
    return extraction.extract_links(_listing_pages(spark, sf_dir))


def _listing_pages(spark, sf_dir):
    html = LISTING.format(id="cast(page_id as string)")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("concat('https://h', cast(page_id as string), '.example.com/careers/SearchJobs') as url", f"{html} || html as html", "cast(null as string) as portal_key", "cast(null as string) as input_seed_url")


#: A site of the pages: each leads to one 30 further on, some to one 60 back, some nowhere; two job pages each, one of them shared by three.
CRAWLED = """concat('<article class="article article--result"><a href="/careers/JobDetail/A/', cast(page_id as string), '?x=1">A</a><a href="../JobDetail/B/', cast(cast(floor(page_id / 3) as bigint) as string), '#top">B</a></article>',
  case when page_id % 1000 = 990 then concat('<a class="paginationNextLink" href="?jobOffset=', cast(page_id - 60 as string), '">next</a>') when page_id % 4 <> 3 then concat('<a href="?jobOffset=', cast(page_id + 30 as string), '">more</a>') else '' end, '<a href="?jobOffset=', cast(page_id as string), '#f">here</a>', html)"""
CRAWL_SQL = """with recursive n as (select page_id as id, case when page_id % 1000 = 990 then page_id - 60 when page_id % 4 <> 3 then page_id + 30 end as after from pages),
  start(seed, id) as (select page_id, page_id from pages where page_id < 4 or page_id % 250 = 34 union all select -30, -30),
  r(seed, id, depth) as (select seed, id, 0 from start union all select r.seed, n.after, r.depth + 1 from r join n using (id) where n.after is not null and r.depth < (select count(*) from n)),
  best as (select id, min(struct_pack(depth := depth, seed := seed)) as way from r group by id),
  pg as (select *, 'https://h' || cast(((id % 30) + 30) % 30 as varchar) || '.example.com/careers/SearchJobs/?jobOffset=' || id as url, 'https://h' || cast(((way.seed % 30) + 30) % 30 as varchar) || '.example.com/careers' as home from best),
  leads as (select 'https://h' || id % 30 || '.example.com/careers/JobDetail/A/' || id as url, way, home from pg where id in (select id from n)
    union all select 'https://h' || id % 30 || '.example.com/careers/JobDetail/B/' || id // 3, way, home from pg where id in (select id from n))"""


@query(CRAWL_SQL + """ select url, case when way.depth = 0 then 'listing' else 'pagination' end as request_kind, way.depth as depth, 'h' || ((way.seed % 30) + 30) % 30 || '.example.com/careers' as portal_key, way.seed as seed, id in (select id from n) as captured from pg
  union all select url, 'job_detail', min(way).depth + 1, 'h' || ((min(way).seed % 30) + 30) % 30 || '.example.com/careers', min(way).seed, false from leads group by url""")
def crawl_frontier(spark, sf_dir):
    """All that seeds lead to over the stored pages: next pages to the end of their chains, circles included, and the job pages."""
    from careerlake.operators import frontier

    at = lambda c: f"concat('https://h', cast(pmod({c}, 30) as string), '.example.com/careers/SearchJobs/?jobOffset=', cast({c} as string))"
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    listed = pages.selectExpr(f"{at('page_id')} as url", f"{CRAWLED} as html")
    first = pages.filter("page_id < 4 or page_id % 250 = 34").select("page_id").unionByName(spark.range(1).selectExpr("cast(-30 as bigint) as page_id"))  # the last isn't stored
    start = first.selectExpr("page_id as pos", f"{at('page_id')} as url")
    asked = frontier.crawl(seeds.requests(start), listed)
    return asked.select("url", "request_kind", "depth", "portal_key", F.regexp_extract("input_seed_url", "(-?[0-9]+)$", 1).cast("long").alias("seed"), "captured")


@query("select count(distinct page_id) as jobs_discovered_total from pages")
def discovered_jobs(spark, sf_dir):
    return extraction.discovered(_listing(spark, sf_dir))


def _field(label: str, value: str) -> str:
    """SQL of a labelled field; value is SQL, label is text."""
    head = f"<div class=\"article__content__view__field__label\">{label}</div>" if label else ""
    return f"concat('<div class=\"article__content__view__field\">{head}<div class=\"article__content__view__field__value\">', {value}, '</div></div>')"


def _detail_pages(spark, sf_dir):
    """A job's page for each page: every source of a field, some of them missing in turn."""
    n = "cast(page_id as string)"
    mod = lambda k: f"cast(page_id % {k} as string)"
    html = f"""concat('<html><head><title>Tab ', {n}, '</title>', case when page_id % 4 = 0 then concat('<meta property="og:title" content=" Role ', {n}, ' &amp; more ">') else '' end,
      case when page_id % 6 = 0 then concat('<meta name="x.portallist.search" content=" 7', {n}, ' ">') else '' end,
      case when page_id % 3 = 0 then '<script type="application/ld+json">broken</script>' else '' end,
      case when page_id % 7 < 5 then concat('<script type="application/ld+json">[{{"@type":"Thing"}},{{"@type":"JobPosting","hiringOrganization":{{"name":"Ad ', {mod(7)}, '"}},"datePosted":"2026-01-0', {mod(9)}, '","description":"<p>From <b>ad</b></p>"}}]</script>') else '' end,
      '</head><body>', case when page_id % 4 = 1 then concat('<h2 class="banner__text__title">Banner ', {n}, '</h2>') else '' end,
      case when page_id % 7 = 6 then '<div class="banner__text__subtitle">The Co</div>' else '' end,
      case when page_id % 5 <> 3 then {_field('Company :', f"concat('Field Co ', {mod(5)})")} else '' end, case when page_id % 2 = 0 and page_id % 5 <> 3 then {_field('Company :', f"concat('Last Co ', {mod(5)})")} else '' end,
      {_field('Location(s):', f"concat('City ', {mod(5)}, ', city ', {mod(4)}, '/Unknown')")}, {_field('REMOTE?', "'Yes'")},
      case when page_id % 5 > 0 then concat('<article class="article article--details"><h3 class="article__header__text__title">About</h3>', {_field('', f"concat('one <i>', {n}, '</i>')")}, {_field('', "'two'")}, '</article>') else '' end,
      case when page_id % 3 = 0 then concat('<a href="/careers/ApplicationMethods?jobId=', {n}, '">Go</a>') when page_id % 3 = 1 then concat('<a href="/Login?jobId=', {n}, '">Apply now</a>') else '<a href="/Login?jobId=1">Log in</a>' end, '</body></html>', html)""".replace("Company :", "Company:")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr(f"concat('https://H', {mod(30)}, '.Example.com/careers//JobDetail/Role/1', lpad({n}, 6, '0'), '?x=1#f') as url", f"{html} as html", "cast(null as string) as portal_key", "cast(null as string) as input_seed_url")


@query(
    """with p as (select page_id, cast(page_id as varchar) as n, lpad(cast(page_id as varchar), 6, '0') as padded, 'h' || page_id % 30 || '.example.com/careers' as portal_key from pages),
    f as (select *, case when page_id % 6 = 0 then '7' || n else '1' || padded end as job_id from p)
    select 'https://H' || page_id % 30 || '.Example.com/careers/JobDetail/Role/1' || padded as source_url, portal_key, job_id, sha256(portal_key || '|' || job_id) as job_hash,
      case page_id % 4 when 0 then 'Role ' || n || ' & more' when 1 then 'Banner ' || n else 'Tab ' || n end as title,
      case when page_id % 5 <> 3 then case when page_id % 2 = 0 then 'Last Co ' else 'Field Co ' end || page_id % 5 when page_id % 7 < 5 then 'Ad ' || page_id % 7 when page_id % 7 = 6 then 'The Co' end as company,
      'City ' || page_id % 5 || case when page_id % 5 = page_id % 4 then '' else '|city ' || page_id % 4 end as locations,
      case when page_id % 7 < 5 then '2026-01-0' || page_id % 9 end as posted_date, 'Yes' as remote,
      case when page_id % 5 > 0 then 'one ' || n || chr(10) || 'two' else 'one' end as description_text,
      case page_id % 3 when 0 then 'https://H' || page_id % 30 || '.Example.com/careers/ApplicationMethods?jobId=' || n when 1 then 'https://H' || page_id % 30 || '.Example.com/Login?jobId=' || n end as apply_url,
      case when page_id % 5 <> 3 then 'company=' || case when page_id % 2 = 0 then 'Last Co ' else 'Field Co ' end || page_id % 5 || '|' else '' end || 'location(s)=City ' || page_id % 5 || ', city ' || page_id % 4 || '/Unknown|remote?=Yes' as raw_fields, 'r' as run_id, '2026-03-18' as run_date, 'now' as scraped_at
    from f""".replace("else 'one' end as description_text", "when page_id % 7 < 5 then 'From ad' end as description_text")
)
def extract_details(spark, sf_dir):
    """Title, fields, sections, links and identity of job pages, by all their fallbacks."""
    got = extraction.extract_jobs(_detail_pages(spark, sf_dir), "r", "2026-03-18", "now")
    raw = F.array_join(F.transform(F.array_sort(F.map_entries("raw_fields")), lambda e: F.concat(e.key, F.lit("="), e.value)), "|")
    return got.select("source_url", "portal_key", "job_id", "job_hash", "title", "company", F.array_join("locations", "|").alias("locations"), "posted_date", "remote", "description_text", "apply_url", raw.alias("raw_fields"), "run_id", "run_date", "scraped_at")


@query("select event_id, case event_id % 5 when 4 then 'soon' when 3 then strftime(ts, '%Y-%m') || '-26' else strftime(ts, '%Y-%m-%d') end as posted_date from events")
def lenient_dates(spark, sf_dir):
    """Dates in words and other orders; what a text leaves out comes from the run's date; what isn't a date stays."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id", "case event_id % 5 when 0 then date_format(ts, ' MM-dd-yy ') when 1 then date_format(ts, 'MMMM d, yyyy') when 2 then date_format(ts, 'd MMM yyyy') when 3 then date_format(ts, 'MMM yyyy') else ' soon ' end as posted_date")
    return dates.normalize_dates(rows, "posted_date", "2026-03-26")


@query(ORACLE_SQL["portal_summary_rows"].join(["select portal_key, row_number() over (order by error_responses_total desc, job_detail_requests_total desc, portal_key) as place from (", ")"]))
def portal_order(spark, sf_dir):
    """The portals in the order in which their summary is written."""
    rows = telemetry.ranked(QUERIES["portal_summary_rows"](spark, sf_dir)).select("portal_key").coalesce(1)  # a row for each portal
    return rows.select("portal_key", (F.monotonically_increasing_id() + 1).alias("place"))
