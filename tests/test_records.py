from pyspark.sql import functions as F

from careerlake.operators import dedupe, records
from careerlake.schemas import JOB


def jobs(spark, *rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in JOB) for r in rows], JOB)


GOOD = {"canonical_source_url": "https://a.com/1", "source_url": "https://a.com/1", "job_id": "1", "title": "  Example Role  ", "description_text": " Useful ", "locations": [" New York ", "new york", "Boston"], "remote": "Work From Home", "posted_date": "02-18-26"}


def test_validation(spark):
    got = records.validate(jobs(spark, GOOD), "2026-03-18").first()
    assert (got.title, got.remote, got.posted_date, got.locations) == ("Example Role", "remote", "2026-02-18", ["New York", "Boston"])
    assert got.record_status == "valid" and got.validation_errors == [] and got.validation_warnings == ["missing_apply_url", "missing_company"]


def test_quarantine(spark):
    bad = GOOD | {"description_text": None, "locations": None, "canonical_source_url": "  ", "job_id": ""}
    checked = records.validate(jobs(spark, bad))
    got = records.quarantined(checked).first()
    assert got.errors == ["missing_description_text", "missing_canonical_source_url", "missing_job_identity"]
    assert got["item"].record_status == "quarantined" and "missing_locations" in got.warnings
    assert records.valid(checked).count() == 0


def test_empty_table(spark):
    checked = records.validate(spark.createDataFrame([], JOB))
    assert checked.count() == 0 and records.issue_counts(checked).count() == 0


def test_first_in_run_keeps_all_without_hash(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4), ("b", 5)], "job_hash string, seq int")
    assert sorted(r.seq for r in dedupe.first_in_run(df, ["seq"]).collect()) == [1, 3, 4, 5]
    assert dedupe.duplicates_in_run(df).first()[0] == 1


def test_anti_join_keeps_copies_in_the_batch(spark):
    batch = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", "b"), ("d", None)], "run_date string, job_hash string")
    left = dedupe.not_yet_in(batch, batch.filter("job_hash = 'a'"), ["run_date", "job_hash"])
    assert sorted(r.job_hash or "" for r in left.collect()) == ["", "b", "b"]


def test_registry(spark):
    schema = "job_hash string, run_id string, portal_key string, source_url string, seq int"
    batch = spark.createDataFrame([("old", "r", "p", "u", 1), ("gone", "r", "p", "u", 2), ("new", "r", "p", "u", 3), ("new", "r", "p", "u", 4), (None, "r", "p", "u", 5)], schema)
    registry = spark.createDataFrame([("old", 100), ("gone", 10)], "job_hash string, expires_at long")
    fresh, entries = dedupe.first_seen(batch, registry, F.lit(50), ["seq"], ttl_days=1)
    assert sorted(r.seq for r in fresh.collect()) == [2, 3, 5]
    assert {(r.job_hash, r.first_seen_ts, r.expires_at) for r in entries.collect()} == {("gone", 50, 86450), ("new", 50, 86450)}
    assert sorted(r.seq for r in dedupe.first_seen(batch, registry, F.lit(50), ["seq"], on_missing_hash="drop")[0].collect()) == [2, 3]


def test_drop_reasons(spark):
    df = spark.createDataFrame([("quarantined", None), (None, "Duplicate"), ("x", "Validation failed: t"), (None, None)], "s string, m string")
    assert [r[0] for r in df.select(records.drop_reason(F.col("s"), F.col("m"))).collect()] == ["quarantine", "duplicate", "quarantine", None]
