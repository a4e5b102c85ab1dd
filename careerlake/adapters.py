"""Views of the general test tables in the shapes of the job tables, as one SQL text for both engines.

Each view is a template; the few functions that are written differently are filled in. So a query's input is the same in Spark
and in the SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK = {
    "sha": lambda x: f"sha2({x}, 256)",
    "day": lambda x: f"date_format({x}, 'yyyy-MM-dd')",
    "stamp": lambda x: f"date_format({x}, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "json": lambda x, k: f"get_json_object({x}, '$.{k}')",
    "list": lambda *x: f"array({', '.join(x)})",
    "text": "string",
}
DUCK = {
    "sha": lambda x: f"sha256({x})",
    "day": lambda x: f"strftime({x}, '%Y-%m-%d')",
    "stamp": lambda x: f"strftime({x}, '%Y-%m-%dT%H:%M:%S')",
    "json": lambda x, k: f"json_extract_string({x}, '$.{k}')",
    "list": lambda *x: f"[{', '.join(x)}]",
    "text": "varchar",
}


def jobs(d: dict) -> str:
    """Raw job records, one for each event: messy on purpose."""
    text = lambda x: f"cast({x} as {d['text']})"
    host = f"concat('https://Portal', {text('user_id % 7')}, '.Example.com')"
    return f"""select event_id, ts, {d["sha"](f"concat('u|', {text('user_id')})")} as job_hash,
      concat({host}, '/careers//JobDetail/Role/', {text('1000 + user_id')}, '?ref=', {text('event_id')}, '#top') as source_url,
      case when event_id % 29 = 0 then '   ' when event_id % 31 = 0 then '' else concat({host}, '/careers/JobDetail/Role/', {text('1000 + user_id')}) end as canonical_source_url,
      case when event_id % 6 = 0 then null else concat(' ', {host}, '/careers/', {text('event_id')}, ' ') end as raw_source_url,
      concat('p', {text('user_id % 7')}) as portal_key, concat('r', {text('hour(ts)')}) as run_id, {d["stamp"]("ts")} as scraped_at,
      {host} as input_seed_url, case when user_id % 19 = 0 then null else {text('1000 + user_id')} end as job_id,
      case when event_id % 13 = 0 then null when event_id % 17 = 0 then '   ' else concat('  ', event_type, ' ') end as title,
      case when user_id % 5 = 0 then null else concat(' Company ', {text('user_id % 10')}, ' ') end as company,
      {d["list"]("' New   York '", "'new york'", "concat('City ', " + text('event_id % 4') + ")", "''", "'city 1'")} as locations,
      case event_id % 4 when 0 then {d["day"]("ts")} when 1 then '3/9/2026' when 2 then null else ' soon ' end as posted_date,
      case event_id % 11 when 0 then 'Work From Home' when 1 then ' Hybrid ' when 2 then 'no' when 3 then 'unknown' when 4 then 'Not remote' when 5 then 'Main OFFICE' when 6 then '' when 7 then null when 8 then 'flex' when 9 then 'YES' else 'On-Site' end as remote,
      case when event_id % 3 = 0 then 'Full time' end as employment_type, case when user_id % 4 = 0 then 'Field' end as career_area,
      case when event_id % 10 = 0 then {text('event_id')} end as ref_number,
      case when event_id % 7 = 0 then null else concat(' Work on ', event_type, ' ', {text('event_id % 5')}, ' ') end as description_text,
      case when event_id % 3 = 0 then null else concat({host}, '/apply') end as apply_url, {d["day"]("ts")} as run_date,
      event_type, user_id, value, {d["json"]("props", "k")} as k
    from events"""


def snapshots(d: dict) -> str:
    """A clean row for each job and day: the day's last event of the job."""
    text = lambda x: f"cast({x} as {d['text']})"
    return f"""select {d["sha"](f"concat('u|', {text('user_id')})")} as job_hash, concat('https://portal', {text('user_id % 7')}, '.example.com/careers/JobDetail/Role/', {text('1000 + user_id')}) as source_url,
      concat('p', {text('user_id % 7')}) as portal_key, {text('user_id')} as job_id, event_type as title, case when event_id % 5 = 0 then null else concat('Company ', {text('user_id % 10')}) end as company,
      {d["list"]("'New York'", "concat('City ', " + text('event_id % 3') + ")")} as locations, {d["day"]("ts")} as posted_date,
      case event_id % 4 when 0 then 'remote' when 1 then 'hybrid' when 2 then 'onsite' else 'unknown' end as remote, 'Full time' as employment_type, case when event_id % 9 = 0 then null else 'Field' end as career_area,
      cast(null as {d['text']}) as ref_number, concat('Pay ', {text('cast(value as decimal(18, 2))')}) as description_text, case when event_id % 8 = 0 then '  ' else 'https://x/apply' end as apply_url,
      run_date, event_id, ts, event_type
    from (select *, {d["day"]("ts")} as run_date, row_number() over (partition by user_id, {d["day"]("ts")} order by ts desc, event_id desc) as place from events) where place = 1"""


def requests(d: dict) -> str:
    return f"select concat('p', cast(user_id % 7 as {d['text']})) as portal_key, case event_type when 'view' then 'listing' when 'signup' then 'pagination' when 'error' then 'other' else 'job_detail' end as kind, case event_id % 10 when 0 then 404 when 1 then 500 when 2 then 302 when 3 then null else 200 end as status, event_id from events"


def drops(d: dict) -> str:
    return f"select concat('p', cast(user_id % 8 as {d['text']})) as portal_key, case when event_id % 3 = 0 then 'quarantined' end as status, case event_id % 4 when 0 then 'Duplicate job' when 1 then 'Validation failed: missing_title' when 2 then 'other' end as message, event_id from events where event_id % 5 = 0"


def metrics(d: dict) -> str:
    return "select ts, case event_type when 'error' then 'RunFailed' when 'click' then 'JobsExported' when 'view' then 'JobDetailSuccessRate' else 'QueueDepth' end as name, case event_type when 'error' then case when event_id % 40 = 0 then 1.0 else 0.0 end when 'click' then cast(event_id % 3 as double) when 'view' then 0.9 + cast(event_id % 10 as double) / 100 else cast(event_id % 2 as double) end as value from events"


def seeds(d: dict) -> str:
    """Seeds of all sorts from the pages' URLs."""
    text = lambda x: f"cast({x} as {d['text']})"
    return f"""select page_id as pos, case page_id % 12 when 0 then concat('  ', upper(url), ',, ') when 1 then concat('ftp://', {text('page_id')}) when 2 then 'https://Staging.Example.com/careers' when 3 then concat('https://Host', {text('page_id % 9')}, '.example.com:8443/InternalCareers/x') when 4 then concat('HTTPS://user@Host', {text('page_id % 9')}, '.example.com/Careers#x') when 5 then concat('https://h', {text('page_id % 30')}, '.example.com/careers?x=1#f') when 6 then concat('h', {text('page_id')}, '.example.com/careers') when 7 then concat('https://stagingkoch.example.com/jobs/', {text('page_id % 5')}) when 8 then concat('https://h', {text('page_id % 30')}, '.example.com/de_DE/careers/SearchJobs') when 9 then concat('https://a', {text('page_id % 4')}, '.example.com/test/uatx') else url end as raw_value from pages"""


def links(d: dict) -> str:
    """Link targets: plain, share-wrapped and listing offsets."""
    text = lambda x: f"cast({x} as {d['text']})"
    return f"""select page_id, case page_id % 6 when 0 then concat('https://s.example.com/share?u=1&shareUrl=https%3A%2F%2Fa.example.com%2Fcareers%2FJobDetail%2F', {text('page_id')}, '%3Fa%3D1') when 1 then concat('https://s.example.com/?url=a%252Bb+c', {text('page_id')}) when 2 then concat('HTTPS://A.example.com/careers//JobDetail/x///', {text('page_id * 37')}, '?jobOffset=', {text('page_id')}, '#f') when 3 then concat('https://b.example.com/careers/SearchJobs?x=1&jobOffset=', {text('page_id * 10')}) when 4 then concat('/careers/JobDetail/', {text('page_id * 1001')}) else url end as url from pages"""


VIEWS = {"jobs": jobs, "snapshots": snapshots, "requests": requests, "drops": drops, "metrics": metrics, "seeds": seeds, "links": links}
TABLES = {"seeds": "pages", "links": "pages"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = TABLES.get(name, "events")
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return spark.sql(f"select * from ({VIEWS[name](SPARK).replace(f'from {table}', 'from {rows}')})", rows=rows)


def with_views(*names: str) -> str:
    """The start of a DuckDB statement over these views."""
    return "with " + ", ".join(f"{n} as ({VIEWS[n](DUCK)})" for n in names)
