"""Writers. Paths may be in any store; Spark's committer publishes whole folders only, and single files are renamed into place once they are whole."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careerlake import shared
from careerlake.operators.records import quarantined
from careerlake.operators.telemetry import ranked


def run_folder(path: str, run_date: str, run_id: str) -> str:
    return f"{path.rstrip('/')}/run_date={run_date}/run_id={run_id}"


def jobs_feed(jobs: DataFrame, path: str, run_date: str, run_id: str) -> None:
    """JSON Lines under run_date=/run_id=. The run's folder is written as a whole, so that a rerun leaves nothing of the run before, even if it has no rows."""
    jobs.drop("run_date", "run_id").write.mode("overwrite").json(run_folder(path, run_date, run_id))


def quarantine(validated: DataFrame, path: str) -> None:
    """A run's folder as a whole, so that a rerun doesn't repeat its rows."""
    quarantined(validated).write.mode("overwrite").json(path)


def metrics(snapshot: DataFrame, path: str) -> None:
    """One JSON object of all metrics, replaced at each dump; a failure is logged and passed, and the last dump stays."""
    shared.publish(snapshot.select("metrics"), f"{path.rstrip('/')}/metrics.json", must=False)


def manifest(one_row: DataFrame, path: str) -> None:
    shared.publish(one_row, f"{path.rstrip('/')}/run_manifest.json")


def portal_summary(rows: DataFrame, path: str) -> None:
    """Sorted, in one file: a row for each portal. A failure is logged and passed, and the file before stays."""
    shared.publish(ranked(rows), f"{path.rstrip('/')}/portal_summary.jsonl", must=False)


def audit(audited: DataFrame, report: str, recommended: str) -> None:
    """The report as JSON and the recommended seeds as CSV (header url), each one file in input order."""
    shared.publish(audited.orderBy("pos"), report)
    shared.publish(audited.filter("recommended").orderBy("pos").select(F.col("normalized_url").alias("url")), recommended, "csv", header=True)


def drop_partitions(spark: SparkSession, table: str, dates: list[str]) -> None:
    """Retention: removes whole run_date partitions of a table."""
    for d in dates:
        spark.sql(f"alter table {table} drop if exists partition (run_date = '{d}')")


def expire(spark: SparkSession, path: str, run_date: str, days: int) -> list[str]:
    """Retention of an artefact: removes its run_date= folders that are more than so many days older than run_date; returns their dates. Other names stay."""
    first = (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
    old = [d for n in shared.names(spark, path) if (d := n.removeprefix("run_date=")) != n and re.fullmatch(r"\d{4}-\d{2}-\d{2}", d) and d < first]
    for d in old:
        shared.remove(spark, f"{path.rstrip('/')}/run_date={d}")
    return old


#: Days that each artefact of a run is kept, by its folder under the root.
KEPT = {"bronze/jobs": 365, "quarantine": 90, "checked": 30, "metrics": 90, "manifest": 365, "ops/portal_summary": 365}


def expire_all(spark: SparkSession, root: str, run_date: str, kept: dict[str, int] | None = None) -> dict[str, list[str]]:
    """Retention of all artefacts: the dates removed of each."""
    return {name: expire(spark, f"{root.rstrip('/')}/{name}", run_date, days) for name, days in (KEPT if kept is None else kept).items()}
