"""Validation and normalisation of job records, and the split into valid and quarantined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careerlake.functions import dates, text


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _named(*rules: tuple[str, Column]) -> Column:
    """The names of the rules that hold, in order."""
    return F.filter(F.array(*[F.when(rule, name) for name, rule in rules]), lambda x: x.isNotNull())


def validate(jobs: DataFrame, run_date: str | None = None, lenient: bool = True) -> DataFrame:
    """Normalised columns with validation_errors, validation_warnings and record_status (quarantined if there are errors).

    A canonical URL of only spaces doesn't fall back to the source URL; it is missing. Posting dates are read leniently: what they leave
    out comes from run_date, or else from the row's own; that looks for texts that need a parser first, in a read of that column alone.
    lenient=False leaves all but ISO and M/d/yyyy as they are.
    """
    own = F.col("run_date") if "run_date" in jobs.columns else F.lit(None)
    jobs = dates.normalize_dates(jobs, "posted_date", own if run_date is None else run_date) if lenient else jobs.withColumn("posted_date", dates.normalize_date(F.col("posted_date")))
    canonical = text.strip(F.coalesce(_truthy(F.col("canonical_source_url")), F.col("source_url"), F.lit("")))
    out = jobs.withColumns(
        {
            "canonical_source_url": canonical,
            "source_url": canonical,
            "raw_source_url": text.strip(F.coalesce(_truthy(F.col("raw_source_url")), canonical)),
            **{c: text.blank_to_null(F.col(c)) for c in ("title", "description_text", "company", "apply_url")},
            "locations": text.clean_locations(F.col("locations")),
            "remote": text.normalize_remote(F.col("remote")),
        }
    )
    missing = lambda c: _truthy(F.col(c)).isNull()
    errors = _named(
        ("missing_title", missing("title")),
        ("missing_description_text", missing("description_text")),
        ("missing_canonical_source_url", missing("canonical_source_url")),
        ("missing_job_identity", missing("job_id") & missing("canonical_source_url")),
    )
    warnings = _named(
        ("missing_apply_url", missing("apply_url")),
        ("missing_company", missing("company")),
        ("missing_locations", F.size("locations") == 0),
        ("missing_posted_date", missing("posted_date")),
    )
    out = out.withColumns({"validation_errors": errors, "validation_warnings": warnings})
    return out.withColumn("record_status", F.when(F.size("validation_errors") > 0, "quarantined").otherwise("valid"))


def valid(validated: DataFrame) -> DataFrame:
    return validated.filter("record_status = 'valid'")


def quarantined(validated: DataFrame, at: Column | None = None) -> DataFrame:
    """Quarantine payloads: quarantined_at, errors, warnings and the item as a nested row."""
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") if at is None else at
    item = F.struct(*[F.col(c) for c in validated.columns])
    return validated.filter("record_status = 'quarantined'").select(at.alias("quarantined_at"), F.col("validation_errors").alias("errors"), F.col("validation_warnings").alias("warnings"), item.alias("item"))


def issue_counts(validated: DataFrame) -> DataFrame:
    """How often each error and warning occurs, quarantined rows included: kind, issue, n."""
    issues = F.explode(F.concat(F.transform("validation_errors", lambda x: F.struct(F.lit("error").alias("kind"), x.alias("issue"))), F.transform("validation_warnings", lambda x: F.struct(F.lit("warning").alias("kind"), x.alias("issue")))))
    return validated.select(issues.alias("i")).groupBy("i.kind", "i.issue").agg(F.count("*").alias("n"))


def drop_reason(status: Column, message: Column) -> Column:
    """quarantine, duplicate or null, from a dropped item's status and the message that dropped it."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return F.when(F.coalesce(status == "quarantined", F.lit(False)) | m.contains("validation failed") | m.contains("quarantine"), "quarantine").when(m.contains("duplicate"), "duplicate")
