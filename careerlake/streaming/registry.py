"""First sights of jobs as keyed state that expires from the first sight: what the registry keeps, for a stream.

The state of a job is its live entry. A row of a job without one, or whose entry has expired by the row's time, is a first sight: it makes an
entry, and a timer that clears it once the watermark has passed its end. Later sights never put the end off. Entries are what the
stream returns, in the registry's form, so that a stream and daily batches over the same rows make the same registry.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from careerlake.schemas import REGISTRY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSight(StatefulProcessor):
    def __init__(self, ttl_seconds: int, order: int):
        self.ttl, self.order = ttl_seconds, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "expires_at long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first: dict[int, tuple] = {}  # the first row of each time: runs have one time for all of their rows
        for r in rows:
            place = [(v is not None, v) for v in (r[f"place{i}"] for i in range(self.order))]  # nulls first
            row = (place, r["run_id"], r["portal_key"], r["source_url"])
            at = r["seen_ts"]
            if at not in first or row[0] < first[at][0]:
                first[at] = row
        expires = self.entry.get()[0] if self.entry.exists() else None
        for at in sorted(first):
            if expires is not None and expires > at:
                continue
            if expires is not None:
                self.handle.deleteTimer(expires * 1000)
            expires = at + self.ttl
            self.entry.update((expires,))
            self.handle.registerTimer(expires * 1000)
            _, run, portal, url = first[at]
            yield Row(job_hash=key[0], first_seen_run_id=run, portal_key=portal, source_url=url, first_seen_ts=at, expires_at=expires)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.entry.exists() and self.entry.get()[0] * 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.entry.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def rocks_state(spark: SparkSession):
    """Streams that start within keep their state in RocksDB, which timers need; the session's own setting is put back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def first_sights(jobs: DataFrame, seen_at: Column, order: list[str], ttl_days: int = 60, late: str = "1 day") -> DataFrame:
    """A stream of registry entries from a stream of jobs: start it within rocks_state.

    seen_at: when a row counts as seen (a run's time); order: columns that say which of a job's rows of one time comes first. Rows without a hash make no entry;
    rows later than the watermark (the latest time less `late`) are left out.
    """
    timed = jobs.filter("job_hash is not null").select("job_hash", "run_id", "portal_key", "source_url", *[F.col(c).alias(f"place{i}") for i, c in enumerate(order)], seen_at.cast("timestamp").alias("seen_at")).filter("seen_at is not null")
    timed = timed.withWatermark("seen_at", late).withColumn("seen_ts", F.unix_timestamp("seen_at"))
    return timed.groupBy("job_hash").transformWithState(FirstSight(ttl_days * 86_400, len(order)), REGISTRY, "Append", "EventTime")
