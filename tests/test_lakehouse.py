import pytest
from pyspark.sql import functions as F

from careerlake.plans import gate, lakehouse, named, workflow
from careerlake.schemas import HISTORY
from careerlake.sources import readers
from careerlake.sources.registry_log import RegistryLog

D1, D2, D3 = "2026-03-01", "2026-03-02", "2026-03-03"


def snapshots(spark, *rows):
    """(job, day, content)"""
    df = spark.createDataFrame(rows, "job_hash string, run_date string, content_hash string")
    for c in HISTORY:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("array<string>" if c in ("locations", "validation_warnings") else "string"))
    return df.select(*HISTORY)


def test_change_events_over_three_days(spark):
    s = snapshots(spark, *[("A", d, "a") for d in (D1, D2, D3)], ("B", D1, "b"), ("B", D2, "b2"), ("B", D3, "b2"), ("C", D1, "c"), ("D", D2, "d"), ("D", D3, "d"), ("E", D1, "e"), ("E", D3, "e2"))
    got = {(r.event_type, r.job_hash, r.event_run_date) for r in lakehouse.change_events(s).collect()}
    new = {("new_job", j, D1) for j in "ABCE"} | {("new_job", "D", D2)}
    assert got == new | {("updated_job", "B", D2), ("updated_job", "E", D3), ("missing_from_latest_run", "C", D2), ("missing_from_latest_run", "E", D2)}


def test_copies_on_a_day(spark):
    s = snapshots(spark, ("F", D1, "f"), ("F", D1, "f"), ("F", D2, "f"))
    kinds = sorted(r.event_type for r in lakehouse.change_events(s).collect())
    assert kinds == ["missing_from_latest_run", "new_job"]  # the first copy's next row isn't on the next day
    assert [r.event_type for r in lakehouse.change_events(s, one_per_day=True).collect()] == ["new_job"]


def test_lifecycle_keeps_nulls_of_the_last_day(spark):
    s = snapshots(spark, ("A", D1, "a"), ("A", D2, "a"), ("B", D1, "b")).withColumn("title", F.when(F.col("run_date") == D1, "old"))
    got = {r.job_hash: r for r in lakehouse.lifecycle_summary(s).collect()}
    assert got["A"].title is None and got["A"].snapshot_count == 2 and not got["A"].missing_from_latest_run
    assert got["B"].title == "old" and got["B"].missing_from_latest_run


def test_percentages_can_be_rounded(spark):
    s = snapshots(spark, ("A", D1, "a"), ("B", D1, "b"), ("C", D1, "c")).withColumn("portal_key", F.lit("p")).withColumn("title", F.when(F.col("job_hash") == "A", "x").otherwise("\t"))
    assert lakehouse.portal_daily_summary(s, 1).first().title_completeness_pct == 33.3
    assert lakehouse.portal_daily_summary(s).first().title_present_total == 1


def page(k, title="Role"):
    return (f"https://p.example.com/careers/JobDetail/Role/{k}", f"<html><head><title>{title}</title></head><body><article class='article article--details'><h3 class='article__header__text__title'>About</h3><div class='article__content__view__field'><div class='article__content__view__field__value'>Do <b>things</b></div></div></article></body></html>")


def test_daily_run_is_idempotent(spark, tmp_path):
    spark.sql("create database if not exists daily")
    pages = spark.createDataFrame([(u, h, None, "seed") for u, h in (page(1001), page(1002), page(1002), page(1003, ""))], "url string, html string, portal_key string, input_seed_url string")
    config = workflow.Config(str(tmp_path), "daily")
    assert workflow.run_daily(spark, pages, config, D1, "r1") == {"curated": 2, "history": 2}
    assert workflow.run_daily(spark, pages, config, D1, "r1") == {"curated": 0, "history": 0}
    assert workflow.run_daily(spark, pages.limit(1), config, D2, "r2") == {"curated": 1, "history": 1}
    named.views(spark, "daily.silver_jobs_curated", "daily.silver_jobs_history_snapshot")
    assert spark.table("gold_job_lifecycle_summary").count() == 2
    assert {r.event_type for r in spark.table("gold_job_change_events").collect()} == {"new_job", "missing_from_latest_run"}
    assert named.run(spark, "day_counts", target="daily.silver_jobs_curated").count() == 2
    assert readers.bronze_jobs(spark, f"{tmp_path}/bronze/jobs", latest=D1).count() == 2
    bad = spark.read.json(f"{tmp_path}/quarantine/run_date={D1}/run_id=r1")
    assert bad.count() == 1 and bad.first().errors == ["missing_title"]  # the rerun replaced its folder
    run = readers.manifest(spark, f"{tmp_path}/manifest/run_date={D1}/run_id=r1").first()
    assert (run.counts.jobs_exported_total, run.counts.jobs_quarantined_total, run.counts.duplicates_dropped_total, run.counts.jobs_discovered_total) == (2, 1, 1, 3)
    portal = readers.portal_summary_file(spark, f"{tmp_path}/ops/portal_summary/run_date={D1}/run_id=r1").collect()
    assert [(r.portal_key, r.job_detail_requests_total, r.job_detail_success_rate) for r in portal] == [("p.example.com/careers", 4, 0.5)]
    assert spark.read.json(f"{tmp_path}/metrics/run_date={D1}/run_id=r1").count() == 1
    with pytest.raises(ValueError, match="allowed"):
        workflow.guard_scan(spark.table("daily.silver_jobs_curated"), 1)


def test_registry_and_gate_of_the_daily_run(spark, tmp_path):
    """Jobs of an earlier run are left out, a rerun isn't its own duplicate, and a bad run raises once all is written."""
    spark.sql("create database if not exists registered")
    rows = [(*page(k), None, "seed", "job_detail", 200) for k in (2001, 2002, 2003, 2004, 2005)]
    pages = spark.createDataFrame([*rows, ("https://p.example.com/careers/SearchJobs", "<html></html>", None, "seed", "listing", 500)], "url string, html string, portal_key string, input_seed_url string, request_kind string, status int")
    config = workflow.Config(str(tmp_path), "registered", registry=True, gated=True)
    for _ in range(2):
        workflow.run_daily(spark, pages, config, D1, "r1")
        assert spark.table("registered.silver_jobs_curated").count() == 5
    with pytest.raises(gate.GateError, match="no_jobs"):
        workflow.run_daily(spark, pages, config, D2, "r2")
    assert RegistryLog(spark, f"{tmp_path}/registry").entries().count() == 5
    late = workflow.Config(str(tmp_path), "registered", registry=True)
    assert workflow.run_daily(spark, pages, late, "2026-06-01", "r3") == {"curated": 5, "history": 5}  # expired by then
    last = readers.portal_summary_file(spark, f"{tmp_path}/ops/portal_summary/run_date=2026-06-01/run_id=r3").first()
    assert (last.listing_requests_total, last.error_responses_total, last.requests_total) == (1, 1, 6)


def test_anti_join_prunes_partitions(spark, tmp_path):
    spark.sql("create database if not exists pruned")
    rows = snapshots(spark, ("A", D1, "a"), ("A", D2, "a"))
    lakehouse.create(rows, "pruned.t")
    plan = lakehouse.new_rows(spark.table("pruned.t"), spark.table("pruned.t"), D1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"(run_date") >= 2 and "LeftAnti" in plan
    with pytest.raises(Exception, match="exist"):
        lakehouse.create(rows, "pruned.t")
    assert [r.run_date for r in lakehouse.expired_partitions(rows, "2026-03-10", 8).collect()] == [D1]


def test_named_statements_and_stored_views(spark, tmp_path):
    """Tables by DDL, promotion by insert, and gold views that another session sees, each equal to the DataFrame plan."""
    spark.sql("create database if not exists named")
    pages = spark.createDataFrame([(u, h, None, "seed") for u, h in (page(3001), page(3002, " x"), page(3003))], "url string, html string, portal_key string, input_seed_url string")
    for day, some in ((D1, pages), (D2, pages.limit(2)), (D3, pages)):
        workflow.run_daily(spark, some, workflow.Config(str(tmp_path), "named"), day, "r")
    named.run(spark, "bronze_table", table="named.bronze", location=f"{tmp_path}/bronze/jobs")
    spark.sql("msck repair table named.bronze")
    bronze = spark.table("named.bronze")
    assert bronze.count() == 8
    for name, rows in (("curated", lakehouse.curated(bronze)), ("history", lakehouse.history(bronze))):
        named.run(spark, f"{name}_create", target=f"named.{name}", bronze="named.bronze")
        assert spark.table(f"named.{name}").exceptAll(rows).count() == 0 and spark.table(f"named.{name}").count() == 8
        named.run(spark, f"{name}_insert", target=f"named.{name}", bronze="named.bronze", run_date=D2)
        assert spark.table(f"named.{name}").count() == 8
    named.views(spark, "named.curated", "named.history", "named")
    other = spark.newSession()
    plans = {"gold_portal_daily_summary": lakehouse.portal_daily_summary(spark.table("named.curated")), "gold_job_change_events": lakehouse.change_events(spark.table("named.history")), "gold_job_lifecycle_summary": lakehouse.lifecycle_summary(spark.table("named.history"))}
    for name, plan in plans.items():
        got = other.table(f"named.{name}")
        assert got.columns == plan.columns and sorted(map(repr, got.collect())) == sorted(map(repr, plan.collect())) and plan.count()


def test_overrides_and_retries():
    assert workflow.override(None, None) is None and workflow.override(D1, "r") == (D1, "r")
    with pytest.raises(ValueError):
        workflow.override(D1, None)
    with pytest.raises(ValueError):
        workflow.Config("/x", schedule_target="cron")
    tries = []
    assert workflow.retry(lambda: tries.append(1) or (1 if len(tries) > 1 else (_ for _ in ()).throw(OSError())), wait=0) == 1


def test_gate(spark):
    schema = "run_id string, close_reason string, jobs_exported_total long, jobs_quarantined_total long, job_detail_success_rate double"
    runs = spark.createDataFrame([("a", "finished", 8, 2, 0.75), ("b", "finished", 7, 3, 0.9), ("c", "shutdown", 8, 0, 1.0), ("d", "finished", 0, 0, 1.0), ("e", "finished", 5, 0, None)], schema)
    assert {r.run_id: r.failure for r in gate.checked(runs).collect()} == {"a": None, "b": "quarantine_rate", "c": "close_reason", "d": "no_jobs", "e": "success_rate"}
    gate.require(runs.filter("run_id = 'a'"), {"jobs.jsonl": True})
    with pytest.raises(gate.GateError, match="missing artifacts"):
        gate.require(runs, {"jobs.jsonl": False})
    with pytest.raises(gate.GateError, match="run b"):
        gate.require(runs.filter("run_id = 'b'"))
