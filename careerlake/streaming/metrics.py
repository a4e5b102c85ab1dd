"""The metrics file of a stream, kept up to date while it runs: written at its start, at intervals, and at its end."""

from __future__ import annotations

import json
import logging
import time
from collections import Counter
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from careerlake import shared

log = logging.getLogger(__name__)


class MetricsDump(StreamingQueryListener):
    """Adds up what telemetry.observed counts in each batch of one stream (by its name) and replaces the file at path as a whole.

    Register it with spark.streams.addListener before the stream starts. Totals begin with the listener. A dump that fails is logged
    and passed, and the file before stays.
    """

    def __init__(self, spark: SparkSession, path: str, stream: str, seconds: float = 60.0, counters: str = "run_counters", clock: Callable[[], float] = time.time):
        self.spark, self.path, self.stream, self.seconds, self.counters, self.clock = spark, path, stream, seconds, counters, clock
        self.totals: Counter = Counter()
        self.began = self.last = clock()
        self.ids: set[str] = set()
        self.dumps: list[str] = []

    def dump(self, reason: str) -> None:
        self.last = self.clock()
        n = self.totals
        seen = n["jobs_exported_total"] + n["jobs_quarantined_total"]
        summary = {"rows_total": n["rows_total"], "batches_total": n["batches_total"], "quarantine_rate": round(n["jobs_quarantined_total"] / seen, 6) if seen else None, "run_duration_seconds": round(self.last - self.began, 3)}
        text = json.dumps({**n, "_dump_ts": datetime.fromtimestamp(self.last, UTC).isoformat(), "_dump_reason": reason, "_summary": summary}, indent=1, sort_keys=True)
        try:
            shared.replace_text(self.spark, self.path, text)
            self.dumps.append(reason)
        except Exception as e:  # noqa: BLE001  telemetry doesn't stop a stream
            log.error("metrics weren't written to %s: %s", self.path, str(e).splitlines()[0])

    def onQueryStarted(self, event) -> None:
        if event.name == self.stream:
            self.ids.add(str(event.id))
            self.dump("open")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.stream:
            return
        row = p.observedMetrics.get(self.counters)
        if row is not None:
            self.totals.update({k: v or 0 for k, v in row.asDict().items()})
        self.totals.update({"rows_total": p.numInputRows, "batches_total": 1})
        if self.clock() - self.last >= self.seconds:
            self.dump("periodic")

    def onQueryIdle(self, event) -> None:
        if str(event.id) in self.ids and self.clock() - self.last >= self.seconds:
            self.dump("periodic")

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.ids:
            self.totals["failed"] = int(event.exception is not None)
            self.dump("close")
