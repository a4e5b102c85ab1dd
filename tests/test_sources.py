import json

import pytest
from pyspark.sql import functions as F

from careerlake.operators import seeds, telemetry
from careerlake.sources import readers, writers
from careerlake.streaming import records as stream


def test_seed_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("﻿Label, URL \nx,https://example.com/careers \n,\ny,# note\nz,https://staging.example.com/careers\nw,https://a.com/internalcareers/\nv,notaurl\n".encode())
    got = readers.seed_csv(spark, str(tmp_path / "s.csv"))
    assert got.count() == 4
    assert [r.url for r in seeds.load(got).orderBy("pos").collect()] == ["https://example.com/careers", "https://staging.example.com/careers"]
    (tmp_path / "t.csv").write_text("name\nx\n")
    with pytest.raises(ValueError, match="url"):
        readers.seed_csv(spark, str(tmp_path / "t.csv"))


def test_audit(spark, tmp_path):
    raw = ["https://a.com/careers", "https://a.com/careers#x", "ftp://x", "https://uat.a.com", "https://b.com/careers", "https://c.com/careers"]
    s = spark.createDataFrame(list(enumerate(raw)), "pos long, raw_value string")
    probes = spark.createDataFrame([("https://a.com/careers", True, 200, "ok"), ("https://c.com/careers", True, 404, "HTTP 404")], "url string, dns_resolved boolean, http_status int, reason string")
    got = seeds.classify(s, probes)
    assert [r.classification for r in got.orderBy("pos").collect()] == ["valid_keep", "duplicate", "invalid_url", "excluded_internal_or_staging", "dns_unresolvable", "http_unhealthy"]
    alone = seeds.recommend(got, None)
    assert {r.name: r.n for r in seeds.audit_totals(alone).collect()}["recommended"] == 1
    schema = "portal_key string, responses_total long, error_responses_total long, jobs_exported_total long, job_detail_success_rate double"
    for row, want in ((("a.com/careers", 10, 2, 5, 0.95), True), (("a.com/careers", 10, 3, 5, 0.95), False), (("a.com/careers", 0, 0, 5, 0.9), True), (("z", 1, 0, 1, 1.0), False)):
        audited = seeds.recommend(got, spark.createDataFrame([row], schema))
        assert audited.orderBy("pos").first().recommended is want
    writers.audit(alone, str(tmp_path / "r"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().url == "https://a.com/careers"


def test_portal_summary_files(spark, tmp_path):
    for run in ("run_1", "run_2"):
        (tmp_path / run).mkdir()
        (tmp_path / run / "portal_summary.jsonl").write_text("".join(json.dumps({"portal_key": "p", "jobs_exported_total": k}) + "\n\n" for k in (1, 2)))
    last = readers.latest_run(spark, str(tmp_path))
    assert "run_2" in last and readers.latest_run(spark, str(tmp_path / "none")) is None
    assert [r.jobs_exported_total for r in readers.portal_summary_file(spark, last).collect()] == [2]
    assert len(readers.file_digest(spark, last).first().sha256) == 64


def test_bad_bronze_rows_fail(spark, tmp_path):
    (tmp_path / "run_date=2026-03-01").mkdir()
    (tmp_path / "run_date=2026-03-01" / "x.jsonl").write_text('{"title": "a"}\n{broken\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.bronze_jobs(spark, str(tmp_path)).collect()


def test_telemetry_without_facts(spark):
    none = spark.createDataFrame([], "portal_key string, kind string, status int, reason string, title string, description_text string, apply_url string, posted_date string, company string, locations array<string>, source_url string")
    rows = telemetry.portal_rows(none, none, none, none)
    assert rows.count() == 0
    got = telemetry.run_summary(rows).first()
    assert got.jobs_exported_total == 0 and got.job_detail_success_rate is None
    assert telemetry.run_counters(none).first().title_completeness_pct == 0.0


def test_portal_rates(spark):
    asked = spark.createDataFrame([("p", "job_detail", 200)] * 3 + [("p", "other", None), ("q", "listing", 404)], "portal_key string, kind string, status int")
    items = spark.createDataFrame([("p", "t", ["x"]), ("p", "", [])], "portal_key string, title string, locations array<string>")
    for c in ("description_text", "apply_url", "posted_date", "company"):
        items = items.withColumn(c, F.lit(None).cast("string"))
    drops = spark.createDataFrame([("p", "duplicate")], "portal_key string, reason string")
    got = {r.portal_key: r for r in telemetry.portal_rows(asked, asked, items, drops).collect()}
    assert (got["p"].requests_total, got["p"].duplicate_rate, got["p"].job_detail_success_rate, got["p"].title_completeness_pct) == (4, 0.333333, 0.666667, 50.0)
    assert (got["q"].error_responses_total, got["q"].duplicate_rate, got["q"].job_detail_success_rate, got["q"].title_completeness_pct) == (1, 0.0, None, None)
    assert telemetry.ranked(telemetry.portal_rows(asked, asked, items, drops)).first().portal_key == "q"
    assert {(r.kind, r.bucket) for r in telemetry.response_buckets(asked).collect()} == {("job_detail", "2xx"), ("other", "0xx"), ("listing", "4xx")}


def test_stream_keeps_the_first_of_each_job(spark, tmp_path):
    from careerlake.schemas import JOB

    def job(k, hour):
        return json.dumps({"job_hash": k, "title": "t", "description_text": "d", "canonical_source_url": "u", "scraped_at": f"2026-03-01T{hour:02d}:00:00+00:00", "run_date": "2026-03-01"})

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text("\n".join([job("a", 1), job("a", 2), job("b", 3)]))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for n in (2, 3):
        rows = stream.first_seen_stream(stream.stream_jsonl(spark, str(tmp_path / "in"), JOB)).select("job_hash")
        stream.run_available(rows, out, state).awaitTermination(120)
        assert spark.read.parquet(out).count() == n
        (tmp_path / "in" / "2.jsonl").write_text("\n".join([job("a", 5), job("c", 6)]))
    counts = stream.windowed_counts(stream.stream_jsonl(spark, str(tmp_path / "in"), JOB))
    assert counts.isStreaming and counts.columns == ["window_start", "portal_key", "record_status", "n"]


def test_commands(spark, tmp_path, capsys):
    from careerlake import cli

    run = {"run_id": "r", "close_reason": "finished", "counts": {"jobs_exported_total": 5, "jobs_quarantined_total": 0}, "quality": {"job_detail_success_rate": 0.8}}
    (tmp_path / "m.json").write_text(json.dumps(run, indent=1))
    assert cli.main(["smoke", str(tmp_path / "m.json")]) == 0
    assert cli.main(["smoke", str(tmp_path / "m.json"), "--least-success", "0.9"]) == 1
    (tmp_path / "s.csv").write_text("url\nhttps://a.com/careers\nhttps://a.com/careers\n")
    (tmp_path / "p.jsonl").write_text(json.dumps({"url": "https://a.com/careers", "dns_resolved": True, "http_status": 200, "reason": "ok"}))
    assert cli.main(["audit", str(tmp_path / "s.csv"), str(tmp_path / "p.jsonl"), str(tmp_path / "out")]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"duplicate": 1, "recommended": 1, "total": 2, "valid_keep": 1}


def test_snapshots_and_registry_policy(spark):
    from careerlake.operators import dedupe

    stats = spark.createDataFrame([("a", 1)], "name string, value long")
    got = telemetry.metrics_snapshot(stats, spark.range(1), "close", "now").first().metrics
    assert got == {"a": "1", "_dump_ts": "now", "_dump_reason": "close", "_summary": '{"id":0}'}
    jobs = spark.createDataFrame([("a", "r", "p", "u")], "job_hash string, run_id string, portal_key string, source_url string")
    gone = lambda: spark.read.parquet("/none/such")
    assert dedupe.first_seen_or_pass(jobs, None, F.lit(1), ["job_hash"])[1] is None
    assert dedupe.first_seen_or_pass(jobs, gone, F.lit(1), ["job_hash"], on_error="pass")[0].count() == 1
    with pytest.raises(Exception, match="(?i)path"):
        dedupe.first_seen_or_pass(jobs, gone, F.lit(1), ["job_hash"])


def test_stream_of_first_sights_equals_daily_batches(spark, tmp_path):
    """Over days with rows out of order, repeats, rows without a hash, and entries that expire exactly on a day."""
    import random

    from careerlake.operators import dedupe
    from careerlake.streaming import registry

    rng, day = random.Random(4), 86_400
    schema = "job_hash string, run_id string, portal_key string, source_url string, run_date string, scraped_at string"
    days = [[(rng.choice(["a", "b", "c", "d", None]), f"r{d}", "p", f"u{rng.randrange(99)}", f"2026-03-0{d + 1}", f"T{rng.randrange(1000):04d}") for _ in range(9)] for d in range(6)]
    known = spark.createDataFrame([], "job_hash string, first_seen_run_id string, portal_key string, source_url string, first_seen_ts long, expires_at long")
    for rows in days:
        jobs = spark.createDataFrame(rows, schema)
        now = F.unix_timestamp(F.lit(rows[0][4]), "yyyy-MM-dd")
        entries = dedupe.first_seen(jobs, known, now, ["scraped_at", "source_url"], ttl_days=2)[1]
        known = spark.createDataFrame([*known.collect(), *entries.collect()], known.schema)
    want = sorted(map(tuple, known.collect()))
    assert len({r[0] for r in want}) == 4 < len(want) and all(r[5] == r[4] + 2 * day for r in want)
    for name, per_batch in (("each", 1), ("two", 2), ("all", 6)):  # however the days fall into batches
        at = tmp_path / name
        for i in range(0, 6, per_batch):
            spark.createDataFrame([r for rows in days[i : i + per_batch] for r in rows], schema).coalesce(1).write.mode("append").parquet(str(at / "in"))
            with registry.rocks_state(spark):
                come = spark.readStream.schema(schema).parquet(str(at / "in"))
                stream.run_available(registry.first_sights(come, F.to_timestamp("run_date"), ["scraped_at", "source_url"], ttl_days=2), str(at / "out"), str(at / "state")).awaitTermination(120)
        assert sorted(map(tuple, spark.read.parquet(str(at / "out")).collect())) == want
    assert spark.conf.get(registry.PROVIDER) != registry.ROCKS


def test_metrics_of_a_stream(spark, tmp_path):
    """Dumps at the start, by interval and at the end; what can't be written doesn't stop the stream."""
    import time

    from careerlake.operators import telemetry
    from careerlake.streaming.metrics import MetricsDump

    schema = "record_status string, validation_warnings array<string>"
    path, now = f"{tmp_path}/metrics/metrics.json", [1000.0]
    listen, bad = MetricsDump(spark, path, "jobs", 60, clock=lambda: now[0]), MetricsDump(spark, "none://x/y", "jobs")
    for one in (listen, bad):
        spark.streams.addListener(one)
    try:
        def arrive(n):
            spark.createDataFrame([("valid", ["w"])] * n + [("quarantined", [])], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))

        arrive(3)
        rows = telemetry.observed(spark.readStream.schema(schema).json(str(tmp_path / "in")))
        q = rows.writeStream.format("noop").queryName("jobs").option("checkpointLocation", str(tmp_path / "state")).start()
        wait = lambda test: next((True for _ in range(300) if test() or time.sleep(0.1)), False)
        assert wait(lambda: listen.totals["batches_total"] >= 1) and listen.dumps == ["open"]
        now[0] += 61
        arrive(2)
        assert wait(lambda: "periodic" in listen.dumps)
        got = json.loads((tmp_path / "metrics" / "metrics.json").read_text())
        assert got["_dump_reason"] == "periodic" and got["jobs_exported_total"] in (3, 5) and got["_summary"]["run_duration_seconds"] == 61
        wait(lambda: listen.totals["rows_total"] == 7)
        q.stop()
        assert wait(lambda: "close" in listen.dumps)
        got = json.loads((tmp_path / "metrics" / "metrics.json").read_text())
        assert (got["jobs_exported_total"], got["jobs_quarantined_total"], got["validation_warning_total"], got["failed"], got["_dump_reason"]) == (5, 2, 5, 0, "close")
        assert bad.dumps == [] and [p.name for p in (tmp_path / "metrics").iterdir() if not p.name.startswith(".")] == ["metrics.json"]
    finally:
        for one in (listen, bad):
            spark.streams.removeListener(one)


def test_lines_keep_their_order_over_files_and_splits(spark, tmp_path):
    """Three files of different sizes, cut into many splits, which tasks get by size and not in order."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = []
    for name, n in (("a.csv", 40), ("b.csv", 900), ("c.csv", 7)):
        rows = [f"https://{name[0]}{k}.example.com/careers" for k in range(n)]
        (tmp_path / name).write_text("\n".join(["url", *rows[: n // 2], "# note", "", *rows[n // 2 :]]) + "\n")
        want += rows
    (tmp_path / "runs").mkdir()
    for name, n in (("x.jsonl", 300), ("y.jsonl", 5)):
        (tmp_path / "runs" / name).write_text("".join(json.dumps({"portal_key": f"p{k % 4}", "requests_total": k, "run_date": name}) + "\n" for k in range(n)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = readers.seed_csv(spark, str(tmp_path / "*.csv"))
        last = {r.portal_key: (r.run_date, r.requests_total) for r in readers.portal_summary_file(spark, str(tmp_path / "runs")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    rows = got.collect()
    assert [r.raw_value for r in sorted(rows, key=lambda r: r.pos)] == want and len({r.pos for r in rows}) == len(rows)
    assert max(r.pos for r in rows) == len(want) + 3 - 1  # places are without gaps but for rows that don't count
    assert last == {"p0": ("y.jsonl", 4), "p1": ("y.jsonl", 1), "p2": ("y.jsonl", 2), "p3": ("y.jsonl", 3)}


def test_table_functions_in_sql(spark):
    from careerlake.functions import tables
    from careerlake.operators import extraction

    page = "<article class='article article--result'><a href='/careers/JobDetail/1?x'>1</a><a href='mailto:x?/JobDetail/2'>2</a></article><a href='?jobOffset=5'>next</a>"
    field = "<div class='article__content__view__field'><div class='article__content__view__field__label'>{}</div><div class='article__content__view__field__value'>{}</div></div>"
    rows = [(1, "https://a.com/careers/", page), (2, None, page), (3, "https://a.com/", None), (4, "https://b.com/JobDetail/5", field.format("City:", "Rome") + field.format("City:", "Oslo"))]
    pages = spark.createDataFrame(rows, "id int, url string, html string")
    tables.register(spark)
    got = spark.sql("select p.id, l.* from {p} p, lateral listing_links(p.url, p.html) l order by id, place", p=pages).collect()
    assert [tuple(r) for r in got] == [(1, "https://a.com/careers/JobDetail/1", "job_detail", 0), (1, "https://a.com/careers/?jobOffset=5", "pagination", 1)]
    want = extraction.extract_links(pages.selectExpr("url", "html", "cast(null as string) as portal_key", "cast(null as string) as input_seed_url"))
    assert sorted((r.target, r.request_kind, r.place) for r in want.collect()) == sorted(tuple(r)[1:] for r in got)
    assert [tuple(r) for r in spark.sql("select p.id, l.* from {p} p, lateral job_labels(p.url, p.html) l", p=pages).collect()] == [(4, "city", "Oslo")]
    for name, want_id in (("x.portallist.search", "7"), ("a.b.portallist.search", "555"), ("portallist.search", "555")):  # the whole name counts
        assert extraction.job_fields("https://b.com/JobDetail/555", f"<meta name='{name}' content=' 7 '>")["job_id"] == want_id
