"""Runs that overlap, are repeated or corrected, and what they crawl and publish."""

import json
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from careerlake import shared
from careerlake.operators import frontier, seeds
from careerlake.plans import lakehouse, workflow
from careerlake.schemas import JOB
from careerlake.sources import readers, registry_log
from careerlake.sources.registry_log import RegistryLog
from test_lakehouse import D1, D2, D3, page, snapshots

PAGE = "url string, html string, portal_key string, input_seed_url string"


# -- crawl -----------------------------------------------------------------------------------


def site(following, jobs):
    """Pages by URL, each with links to next pages and jobs."""
    u = lambda i: f"https://a.example.com/careers/SearchJobs/{i}"
    html = lambda i: "".join(f'<article class="article article--result"><a href="/careers/JobDetail/{j}">x</a></article>' for j in jobs.get(i, ())) + (f'<a class="paginationNextLink" href="{u(following[i])}#x">next</a>' if i in following else "")
    return u, [(u(i), html(i)) for i in range(len(following) + 5)]


@pytest.mark.parametrize("seed", range(3))
def test_crawl_against_page_by_page(spark, seed):
    rng = random.Random(seed)
    n = 120
    following = {i: rng.choice([i + 1, i + 1, i + 1, rng.randrange(n), n + 50, i]) for i in range(n - 5)}
    jobs = {i: rng.sample(range(40), rng.randrange(4)) for i in range(n)}
    u, pages = site(following, jobs)
    start = [rng.randrange(n + 10) for _ in range(4)] + [n + 3]
    start.append(start[0])
    depth = {}
    todo = deque((u(i), 0, p) for p, i in enumerate(start))
    stored = dict(pages)
    while todo:  # breadth first, so that the first way to a page is a shortest one
        at, d, p = todo.popleft()
        if at in depth and depth[at] <= (d, p):
            continue
        depth[at] = (d, p)
        i = int(at.rsplit("/", 1)[1])
        if at in stored and i in following:
            todo.append((u(following[i]), d + 1, p))
    found = {}
    for at, (d, p) in depth.items():
        for j in jobs.get(int(at.rsplit("/", 1)[1]), ()) if at in stored else ():
            job = f"https://a.example.com/careers/JobDetail/{j}"
            found[job] = min(found.get(job, (d + 1, p)), (d + 1, p))
    asked = spark.createDataFrame([(p, u(i) + "#seed", f"portal{p}", f"seed{p}") for p, i in enumerate(start)], "pos long, url string, portal_key string, input_seed_url string")
    got = frontier.crawl(asked, spark.createDataFrame([*pages, (None, "<a href='?jobOffset=1'>"), ("https://a.example.com/none", None)], "url string, html string"))
    rows = {r.url: r for r in got.collect()}
    assert got.count() == len(rows)
    assert {k: (r.depth, r.portal_key, r.input_seed_url) for k, r in rows.items() if r.request_kind != "job_detail"} == {k: (d, f"portal{p}", f"seed{p}") for k, (d, p) in depth.items()}
    assert {k: (r.depth, r.portal_key) for k, r in rows.items() if r.request_kind == "job_detail"} == {k: (d, f"portal{p}") for k, (d, p) in found.items()}
    assert all(r.captured == (k in stored) and (r.request_kind == "listing") == (k in depth and depth[k][0] == 0) for k, r in rows.items())


def test_pages_to_be_asked_again_are_not_stored(spark):
    asked = spark.createDataFrame([(1, "https://x/", "p", "s")], "pos long, url string, portal_key string, input_seed_url string")
    for status, captured in ((200, True), (None, True), (404, True), (503, False), (429, False)):
        pages = spark.createDataFrame([("https://x/", "<a class='paginationNextLink' href='/2'>n</a>", status)], "url string, html string, status int")
        got = {r.url: r.captured for r in frontier.crawl(asked, pages).collect()}
        assert got == ({"https://x/": True, "https://x/2": False} if captured else {"https://x/": False})


def test_crawl_of_nothing(spark):
    none = spark.createDataFrame([], "pos long, url string, portal_key string, input_seed_url string")
    assert frontier.crawl(none, spark.createDataFrame([], "url string, html string")).count() == 0
    alone = none.union(spark.createDataFrame([(1, "https://x/", "p", "s")], none.schema))
    assert [tuple(r) for r in frontier.crawl(alone, spark.createDataFrame([], "url string, html string")).collect()] == [("https://x/", "listing", 0, "p", "s", False)]


# -- registry --------------------------------------------------------------------------------


def jobs(spark, *names, at="2026-03-01"):
    return spark.createDataFrame([(h, "p", f"u{h}", f"{at}T0{i % 10}") for i, h in enumerate(names)], "job_hash string, portal_key string, source_url string, scraped_at string")


def hashes(df):
    return sorted((r.job_hash or "" for r in df.collect()))


def test_overlapping_runs_have_one_first_sight(spark, tmp_path):
    log, now = RegistryLog(spark, str(tmp_path)), F.lit(1_000)
    put = lambda names, run, **how: registry_log.put(log, jobs(spark, *names).withColumn("run_id", F.lit("x")), run, how.pop("now", now), ["scraped_at"], **how)
    assert hashes(put(["a", "b", "a", None, None], "r1")) == ["", "", "a", "b"]
    kept = {}

    def meanwhile(version):  # both read commit 1; the other commits first, twice
        if version == 2:
            kept["r3"] = hashes(put(["c", "d", "a"], "r3"))
        if version == 3:
            kept["r4"] = hashes(put(["e", None], "r4"))

    assert hashes(put(["b", "c", "e", "f"], "r2", before_commit=meanwhile)) == ["f"]
    assert kept == {"r3": ["c", "d"], "r4": ["", "e"]}
    assert {r.job_hash: r.first_seen_run_id for r in log.entries().collect()} == {"a": "r1", "b": "r1", "c": "r3", "d": "r3", "e": "r4", "f": "r2"}
    assert log.entries().count() == 6 and log.last()[0] == 4
    assert hashes(put(["c", "d", "a", "z"], "r3")) == ["c", "d", "z"]  # a rerun isn't its own duplicate, and its folder replaces the one before
    assert log.entries().count() == 7
    with pytest.raises(registry_log.ConflictError):
        put(["q"], "r9", tries=1, before_commit=lambda v: log.commit(v, log.last()[1]))
    assert "q" not in hashes(log.entries())


def test_expired_entries_go_and_first_sights_stay(spark, tmp_path):
    log, day = RegistryLog(spark, str(tmp_path)), 86_400
    put = lambda names, run, at: hashes(registry_log.put(log, jobs(spark, *names).withColumn("run_id", F.lit(run)), run, F.lit(at), ["scraped_at"], ttl_days=2))
    assert put(["a", "b"], "r1", 0) == ["a", "b"]
    assert put(["b", "c"], "r2", day) == ["c"]
    assert put(["a"], "r3", 2 * day) == ["a"]  # expired
    before = {r.job_hash: (r.first_seen_run_id, r.first_seen_ts, r.expires_at) for r in log.entries().filter(F.col("expires_at") > 2 * day).collect()}
    old = log.last()[1]
    version = registry_log.compact(log, F.lit(2 * day))
    assert {r.job_hash: (r.first_seen_run_id, r.first_seen_ts, r.expires_at) for r in log.entries().collect()} == before == {"a": ("r3", 2 * day, 4 * day), "c": ("r2", day, 3 * day)}
    assert log.read(old).count() == 4  # readers of the commit before still have theirs
    assert sorted(registry_log.vacuum(log)) == sorted(old)
    assert log.last()[0] == version and shared.names(spark, f"{tmp_path}/_log") == [f"{version:020d}.json"]
    assert put(["a", "b", "c"], "r4", 2 * day + 1) == ["b"]


# -- daily run -------------------------------------------------------------------------------


def test_a_rerun_replaces_its_feed(spark, tmp_path):
    """A page that was good and turns bad leaves the feed, and counts once."""
    spark.sql("create database if not exists rerun")
    config = workflow.Config(str(tmp_path), "rerun", deploy_env="test", image_tag="v1", git_sha="abc")
    pages = lambda title: spark.createDataFrame([(*page(7001, title), None, "seed")], PAGE)
    own = f"run_date={D1}/run_id=r1"
    for title, good in (("Role", 1), (" ", 0), ("Role", 1)):
        workflow.run_daily(spark, pages(title), config, D1, "r1")
        assert readers.bronze_jobs(spark, f"{tmp_path}/bronze/jobs").count() == good
        run = readers.manifest(spark, f"{tmp_path}/manifest/{own}").collect()
        assert [(r.counts.jobs_exported_total, r.counts.jobs_quarantined_total, r.spider, r.deploy_env, r.image_tag, r.git_sha, r.input_seed_count) for r in run] == [(good, 1 - good, "careers", "test", "v1", "abc", None)]
        assert spark.read.json(f"{tmp_path}/quarantine/{own}").count() == 1 - good if not good else True
        assert len(list((tmp_path / "manifest" / f"run_date={D1}" / "run_id=r1").glob("[!._]*"))) == 1
    dumped = json.loads((tmp_path / "metrics" / f"run_date={D1}" / "run_id=r1" / "metrics.json").read_text())["metrics"]
    assert dumped["_dump_reason"] == "close" and dumped["duplicates/in_run"] == "0"


def test_unreadable_registry(spark, tmp_path):
    """The policy decides: the run fails, or all of its jobs pass."""
    spark.sql("create database if not exists unreadable")
    shared.create_text(spark, f"{tmp_path}/registry/_log/{1:020d}.json", "{broken")
    pages = spark.createDataFrame([(*page(7101), None, "seed"), (*page(7102), None, "seed")], PAGE)
    with pytest.raises(ValueError, match="Expecting"):
        workflow.run_daily(spark, pages, workflow.Config(str(tmp_path), "unreadable", registry=True), D1, "r1")
    assert workflow.run_daily(spark, pages, workflow.Config(str(tmp_path), "unreadable", registry=True, registry_errors="pass"), D1, "r1")["curated"] == 2


def test_daily_run_from_seeds(spark, tmp_path):
    """Only pages that the seeds lead to are taken, each with its request's kind, portal and seed."""
    spark.sql("create database if not exists seeded")
    (tmp_path / "seeds.csv").write_text("url\nhttps://p.example.com/careers/SearchJobs\n# none\nhttps://p.example.com/internalcareers\n")
    listing = "".join(f'<article class="article article--result"><a href="{page(k)[0]}?x=1">x</a></article>' for k in (8001, 8002)) + '<a href="?jobOffset=10">2</a>'
    second = f'<article class="article article--result"><a href="{page(8003)[0]}">x</a></article>'
    rows = [("https://p.example.com/careers/SearchJobs", listing), ("https://p.example.com/careers/SearchJobs?jobOffset=10", second), page(8001), page(8003), page(9999)]
    pages = spark.createDataFrame([(*r, None, None) for r in rows], PAGE)
    assert workflow.run_daily(spark, pages, workflow.Config(str(tmp_path), "seeded"), D1, "r1", seed_file=str(tmp_path / "seeds.csv")) == {"curated": 2, "history": 2}
    assert {(r.job_id, r.input_seed_url, r.portal_key) for r in spark.table("seeded.silver_jobs_curated").collect()} == {("8001", "https://p.example.com/careers/SearchJobs", "p.example.com/careers"), ("8003", "https://p.example.com/careers/SearchJobs", "p.example.com/careers")}
    run = readers.manifest(spark, f"{tmp_path}/manifest/run_date={D1}/run_id=r1").first()
    assert run.input_seed_count == 1 and len(run.input_file_sha256) == 64 and run.input_seed_file.endswith("seeds.csv")
    last = readers.portal_summary_file(spark, f"{tmp_path}/ops/portal_summary/run_date={D1}/run_id=r1").first()
    assert (last.listing_requests_total, last.pagination_requests_total, last.job_detail_requests_total) == (1, 1, 2)


DAYS = [D1, D2, D3, "2026-03-04", "2026-03-05"]


@pytest.mark.parametrize("seed", range(4))
def test_restated_day_equals_a_new_start(spark, seed):
    rng = random.Random(seed)
    gone = DAYS[2] if seed == 3 else None  # a day that the restatement empties, or fills
    made = lambda skip: [(j, d, rng.choice("xy")) for d in DAYS for j in "ABCDEFGHIJ" if rng.random() < 0.6 and d != skip]
    day = DAYS[2] if seed == 3 else rng.choice(DAYS)
    before = made(gone if seed == 2 else None)
    after = [r for r in before if r[1] != day] + ([] if seed == 3 else [r for r in made(None) if r[1] == day])
    old, new = snapshots(spark, *before), snapshots(spark, *after)
    got = lakehouse.restated_events(lakehouse.change_events(old), old, new, day)
    want = lakehouse.change_events(new)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len(lakehouse.restated_dates(old, new, day)) <= len(DAYS)
    assert lakehouse.restated_dates(old, old, DAYS[0]) == DAYS[:2] if seed == 0 else True


def test_restating_tables(spark):
    """Partitions of the corrected day are replaced, events of untouched dates stay as they are."""
    spark.sql("create database if not exists restated")
    record = lambda j, d, title: (j, f"https://x/{j}", "valid", title, d)
    first = [record(j, d, "t") for j, days in {"A": DAYS, "B": DAYS[:3], "C": DAYS[2:], "D": [DAYS[0], DAYS[4]]}.items() for d in days]

    def bronze(rows):
        df = spark.createDataFrame(rows, "job_hash string, source_url string, record_status string, title string, run_date string")
        for f in JOB:
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        return df

    lakehouse.create(lakehouse.curated(bronze(first)), "restated.curated")
    lakehouse.create(lakehouse.history(bronze(first)), "restated.history")
    events = lakehouse.change_events(spark.table("restated.history"))
    events.select(*[c for c in events.columns if c != "event_run_date"], "event_run_date").write.partitionBy("event_run_date").saveAsTable("restated.events")
    for rows, dates in (([record("A", DAYS[1], "other"), record("D", DAYS[1], "t")], [DAYS[1], DAYS[2], DAYS[4]]), ([], [DAYS[1], DAYS[2], DAYS[4]])):
        assert lakehouse.restate(spark, bronze([*rows, record("Z", D1, "not this day")]), DAYS[1], "restated.curated", "restated.history", "restated.events") == dates
        for t in ("curated", "history"):
            assert sorted(r.job_hash for r in spark.table(f"restated.{t}").filter(F.col("run_date") == DAYS[1]).collect()) == sorted(r[0] for r in rows)
            assert spark.table(f"restated.{t}").filter(F.col("run_date") != DAYS[1]).count() == len([r for r in first if r[4] != DAYS[1]])
        want = lakehouse.change_events(spark.table("restated.history"))
        assert sorted(map(repr, spark.table("restated.events").select(*want.columns).collect())) == sorted(map(repr, want.collect()))


# -- files -----------------------------------------------------------------------------------


def test_projection_touches_no_other_date(spark, tmp_path):
    for d, text in ((D1, "{broken"), (D2, '{"title": "a"}'), ("2026-03-04", '{"title": "b"}'), ("2026-03-05", "{broken")):
        at = tmp_path / f"run_date={d}" / "run_id=r"
        at.mkdir(parents=True)
        (at / "x.jsonl").write_text(text)
    got = readers.bronze_jobs(spark, str(tmp_path), earliest=D2, latest="2026-03-04")
    assert sorted((r.title, r.run_date, r.run_id) for r in got.collect()) == [("a", D2, "r"), ("b", "2026-03-04", "r")]
    assert sorted(f.split("run_date=")[1][:10] for f in got.inputFiles()) == [D2, "2026-03-04"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(2 paths)" in plan and D1 not in plan
    assert readers.bronze_jobs(spark, str(tmp_path), earliest="2027-01-01", latest="2027-01-02").count() == 0
    assert readers.folders("/x/", "2026-02-28", D1, "day={run_date}/all") == ["/x/day=2026-02-28/all", f"/x/day={D1}/all"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.bronze_jobs(spark, str(tmp_path), earliest=D1, latest=D1).collect()


def test_published_files_are_whole(spark, tmp_path):
    at = f"{tmp_path}/out/summary.jsonl"
    rows = spark.range(500, numPartitions=7).orderBy(F.desc("id"))
    assert shared.publish(rows, at)
    assert [json.loads(x)["id"] for x in (tmp_path / "out" / "summary.jsonl").read_text().splitlines()] == list(range(499, -1, -1))
    failing = rows.select(F.raise_error(F.lit("no")).alias("x"))
    assert shared.publish(failing, at, must=False) is False
    with pytest.raises(Exception, match="no"):
        shared.publish(failing, at)
    assert len((tmp_path / "out" / "summary.jsonl").read_text().splitlines()) == 500
    assert shared.publish(rows.limit(0), at) and (tmp_path / "out" / "summary.jsonl").read_text() == ""
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")] == ["summary.jsonl"]
    assert shared.create_text(spark, f"{tmp_path}/log/1", "a") and not shared.create_text(spark, f"{tmp_path}/log/1", "b")
    assert shared.read_text(spark, f"{tmp_path}/log/1") == "a"
    shared.replace_text(spark, f"{tmp_path}/log/1", "é")
    assert shared.read_text(spark, f"{tmp_path}/log/1") == "é"


def test_seed_hosts(spark):
    got = seeds.allowed_hosts(spark.createDataFrame([(1, "https://B.example.com/x"), (2, "https://a.example.com")], "pos long, url string")).first()
    assert (got.input_seed_count, got.hosts) == (2, ["a.example.com", "b.example.com"])


def test_retention(spark, tmp_path):
    """Folders of an artefact and partitions of a table go by their dates alone."""
    from careerlake.sources import writers

    for d in (D1, D2, D3):
        for name in ("bronze/jobs", "metrics"):
            (tmp_path / name / f"run_date={d}" / "run_id=r").mkdir(parents=True)
    (tmp_path / "metrics" / "other").mkdir()
    assert writers.expire_all(spark, str(tmp_path), D3, {"bronze/jobs": 1, "metrics": 0, "none": 5}) == {"bronze/jobs": [D1], "metrics": [D1, D2], "none": []}
    assert sorted(p.name for p in (tmp_path / "metrics").iterdir()) == ["other", f"run_date={D3}"]
    spark.sql("create database if not exists kept")
    lakehouse.create(snapshots(spark, ("A", D1, "a"), ("B", D2, "b"), ("C", D3, "c")), "kept.t")
    dates = [r.run_date for r in lakehouse.expired_partitions(spark.table("kept.t"), D3, 0).collect()]
    writers.drop_partitions(spark, "kept.t", dates)
    assert [r.job_hash for r in spark.table("kept.t").collect()] == ["C"]
