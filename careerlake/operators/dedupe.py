"""Duplicates within a run and across runs."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_in_run(jobs: DataFrame, order: list[str], key: str = "job_hash") -> DataFrame:
    """The first row of each key; rows with a null key all stay, and aren't shuffled. Rows are dealt by the key alone, which a join by it can reuse."""
    w = Window.partitionBy(key).orderBy(*order)
    named = jobs.filter(F.col(key).isNotNull()).withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")
    return named.unionByName(jobs.filter(F.col(key).isNull()))


def duplicates_in_run(jobs: DataFrame, key: str = "job_hash") -> DataFrame:
    """One row: rows that first_in_run drops."""
    return jobs.agg((F.count(key) - F.count_distinct(key)).alias("duplicates_dropped_total"))


def not_yet_in(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of batch whose keys target doesn't have. Copies within batch all stay, as do rows with a null key."""
    return batch.join(target.select(*keys), keys, "left_anti")


def live_registry(registry: DataFrame, now: Column, ignore_expiry: bool = False) -> DataFrame:
    """Entries that still count: those that haven't expired, or all if only existence counts."""
    return registry if ignore_expiry else registry.filter(F.col("expires_at") > now)


def first_seen(jobs: DataFrame, registry: DataFrame, now: Column, order: list[str], ttl_days: int = 60, on_missing_hash: str = "pass") -> tuple[DataFrame, DataFrame]:
    """(new jobs, registry entries to append). A job is new if no live entry has its hash; the first of a batch counts.

    Rows without a hash pass, or go with on_missing_hash="drop". Expiry runs from the first sight and is never put off.
    """
    if on_missing_hash not in ("pass", "drop"):
        raise ValueError("on_missing_hash is 'pass' or 'drop'")
    fresh = first_in_run(jobs, order).join(live_registry(registry, now).select("job_hash"), "job_hash", "left_anti")
    if on_missing_hash == "drop":
        fresh = fresh.filter("job_hash is not null")
    entries = fresh.filter("job_hash is not null").select("job_hash", F.col("run_id").alias("first_seen_run_id"), "portal_key", "source_url", now.cast("long").alias("first_seen_ts"), (now + ttl_days * 86_400).cast("long").alias("expires_at"))
    return fresh, entries


def first_seen_or_pass(jobs: DataFrame, registry: Callable[[], DataFrame] | None, now: Column, order: list[str], on_error: str = "fail", **how) -> tuple[DataFrame, DataFrame | None]:
    """first_seen over a registry that may be missing or unreadable.

    No registry: everything passes, no entries. One that can't be read: with on_error="pass" everything passes, with "fail" the error is raised.
    """
    if on_error not in ("fail", "pass"):
        raise ValueError("on_error is 'fail' or 'pass'")
    if registry is None:
        return jobs, None
    try:
        known = registry()
        if on_error == "pass":  # a registry that fails when it is read counts as unreadable too, so its keys are read once
            known.select(F.count("job_hash"), F.max("expires_at")).first()
    except (PySparkException, Py4JJavaError, OSError):
        if on_error == "fail":
            raise
        return jobs, None
    return first_seen(jobs, known, now, order, **how)
