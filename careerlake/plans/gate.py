"""The smoke gate: whether a run's manifest is good enough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_QUARANTINED, LEAST_SUCCESS = 0.20, 0.75


class GateError(ValueError):
    """A run that doesn't pass."""


def quarantine_rate(exported, dropped):
    """Quarantined share of all; 1 if there are none at all."""
    both = exported + dropped
    return F.when(both == 0, F.lit(1.0)).otherwise(dropped / both)


def checked(runs: DataFrame, most_quarantined: float = MOST_QUARANTINED, least_success: float = LEAST_SUCCESS) -> DataFrame:
    """runs: run_id, close_reason, jobs_exported_total, jobs_quarantined_total, job_detail_success_rate. Adds quarantine_rate and failure.

    failure is the first that applies: close_reason, no_jobs, quarantine_rate, success_rate; null if the run passes.
    """
    out = runs.withColumn("quarantine_rate", quarantine_rate(F.col("jobs_exported_total"), F.col("jobs_quarantined_total")))
    failure = (
        F.when(~F.col("close_reason").eqNullSafe("finished"), "close_reason")
        .when(F.coalesce("jobs_exported_total", F.lit(0)) <= 0, "no_jobs")
        .when(F.col("quarantine_rate") > most_quarantined, "quarantine_rate")
        .when(F.col("job_detail_success_rate").isNull() | (F.col("job_detail_success_rate") < least_success), "success_rate")
    )
    return out.withColumn("failure", failure)


def require(runs: DataFrame, artifacts: dict[str, bool] | None = None, **thresholds: float) -> None:
    """Raises GateError for a missing artifact, then for the first run that fails."""
    missing = sorted(k for k, there in (artifacts or {}).items() if not there)
    if missing:
        raise GateError(f"missing artifacts: {', '.join(missing)}")
    bad = checked(runs, **thresholds).filter("failure is not null").first()
    if bad is not None:
        raise GateError(f"run {bad['run_id']}: {bad['failure']}")
