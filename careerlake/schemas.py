"""Explicit schemas of all tables; nothing is inferred. Partition values stay strings."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType


def _fields(names: str, kind) -> list[StructField]:
    return [StructField(n, kind) for n in names.split()]


_TEXT, _TEXTS = StringType(), ArrayType(StringType())

JOB = StructType(
    [
        *_fields("job_hash source_url raw_source_url canonical_source_url portal_key run_id scraped_at input_seed_url job_id title company", _TEXT),
        StructField("locations", _TEXTS),
        *_fields("posted_date remote employment_type career_area ref_number description_text apply_url", _TEXT),
        StructField("raw_fields", MapType(_TEXT, _TEXT)),
        StructField("record_status", _TEXT),
        *_fields("validation_errors validation_warnings", _TEXTS),
        StructField("run_date", _TEXT),
    ]
)
#: The curated table leaves out what only describes the extraction; run_date is last, as the partition.
CURATED = [f.name for f in JOB if f.name not in ("raw_fields", "record_status", "validation_errors")]
HISTORY = [CURATED[0], "content_hash", *CURATED[1:]]
#: What content_hash covers, in this order.
CONTENT = ["title", "company", "locations", "posted_date", "remote", "employment_type", "career_area", "ref_number", "description_text", "apply_url"]

PORTAL_SUMMARY = StructType(
    [
        StructField("portal_key", _TEXT),
        *_fields("requests_total responses_total error_responses_total listing_requests_total pagination_requests_total job_detail_requests_total jobs_exported_total jobs_quarantined_total duplicates_dropped_total", LongType()),
        *_fields("duplicate_rate job_detail_success_rate title_completeness_pct description_completeness_pct apply_url_completeness_pct posted_date_completeness_pct company_completeness_pct", DoubleType()),
        StructField("run_date", _TEXT),
    ]
)
REGISTRY = StructType([*_fields("job_hash first_seen_run_id portal_key source_url", _TEXT), *_fields("first_seen_ts expires_at", LongType())])
PAGE = StructType([*_fields("url html portal_key input_seed_url request_kind", _TEXT), StructField("status", IntegerType())])
PROBE = StructType([StructField("url", _TEXT), StructField("dns_resolved", BooleanType()), StructField("http_status", IntegerType()), StructField("reason", _TEXT)])
MANIFEST = StructType(
    [
        *_fields("run_id run_date started_at finished_at close_reason project stage spider deploy_env image_tag git_sha input_seed_file input_file_sha256", _TEXT),
        StructField("input_seed_count", LongType()),
        StructField("run_duration_seconds", DoubleType()),
        StructField("counts", StructType(_fields("jobs_discovered_total job_detail_requests_total jobs_exported_total jobs_quarantined_total duplicates_dropped_total", LongType()))),
        StructField("quality", StructType(_fields("job_detail_success_rate description_completeness_pct apply_url_completeness_pct posted_date_completeness_pct", DoubleType()))),
        StructField("artifacts", StructType(_fields("jobs_feed_uri metrics_uri run_manifest_uri quarantine_uri portal_summary_uri", _TEXT))),
    ]
)
