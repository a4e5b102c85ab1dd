"""The registry of first sights under runs that overlap: folders of entries, and a numbered log that says which of them count.

Each commit is a file of the log, named by its number, that lists the folders that make up the registry from then on. A run reads the last
commit, writes the entries that are new to it to a folder of its own, and commits under the next number. Only one run can create a file of that name; the
other reads what was committed meanwhile, drops what is there already from its own entries, and tries the next number. So of
runs at the same time one has the first sight of a job, whatever their order. Nothing is changed in place: readers keep the commit
that they began with, and an interrupted run leaves a folder that no commit names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careerlake import shared
from careerlake.operators import dedupe
from careerlake.schemas import REGISTRY


class ConflictError(RuntimeError):
    """Other runs committed first as often as was tried."""


class RegistryLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, version: int) -> str:
        return f"{self.path}/_log/{version:020d}.json"

    def last(self) -> tuple[int, list[str]]:
        """The last commit's number and folders; 0 and none before the first."""
        found = [n for n in shared.names(self.spark, f"{self.path}/_log") if n[:20].isdigit() and n.endswith(".json")]
        if not found:
            return 0, []
        return int(found[-1][:20]), json.loads(shared.read_text(self.spark, f"{self.path}/_log/{found[-1]}"))["folders"]

    def at(self, version: int) -> list[str]:
        return json.loads(shared.read_text(self.spark, self._file(version)))["folders"] if version else []

    def commit(self, version: int, folders: list[str], **note: str) -> bool:
        """False if there is a commit of this number already."""
        return shared.create_text(self.spark, self._file(version), json.dumps({"folders": folders, **note}))

    def read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], REGISTRY)
        return self.spark.read.schema(REGISTRY).parquet(*[f"{self.path}/{f}" for f in folders])

    def entries(self) -> DataFrame:
        return self.read(self.last()[1])

    def write(self, entries: DataFrame, name: str) -> str:
        folder = f"entries/{name}-{uuid.uuid4().hex}"
        entries.select(*REGISTRY.fieldNames()).write.parquet(f"{self.path}/{folder}")
        return folder


def put(log: RegistryLog, jobs: DataFrame, run_id: str, now: Column, order: list[str], ttl_days: int = 60, tries: int = 20, ignore_expiry: bool = False, before_commit: Callable[[int], None] | None = None) -> DataFrame:
    """The first row of each job that no other run's live entry has, once its entry is committed; rows without a hash pass.

    A rerun isn't its own duplicate: entries of the same run_id don't count, and the folder of its former try gives way to the new one.
    before_commit is called with the number that is tried. ConflictError after so many lost tries.
    """
    theirs = lambda folders: dedupe.live_registry(log.read(folders).filter(F.col("first_seen_run_id") != run_id), now, ignore_expiry)
    version, folders = log.last()
    own = hashlib.sha256(run_id.encode()).hexdigest()[:16]
    first = dedupe.first_in_run(jobs, order)
    _, entries = dedupe.first_seen(jobs, theirs(folders), now, order, ttl_days)
    mine = log.write(entries.withColumn("first_seen_run_id", F.lit(run_id)), own)
    for _ in range(tries):
        if before_commit:
            before_commit(version + 1)
        old = [f for f in folders if f.startswith(f"entries/{own}-")]
        if log.commit(version + 1, [f for f in folders if f not in old] + [mine], run_id=run_id):
            break
        version, since = log.last()
        other = theirs([f for f in since if f not in folders]).select("job_hash")
        folders, lost = since, mine
        mine = log.write(log.read([lost]).join(other, "job_hash", "left_anti"), own)
        shared.remove(log.spark, f"{log.path}/{lost}")
    else:
        shared.remove(log.spark, f"{log.path}/{mine}")
        raise ConflictError(f"{tries} commits of run {run_id} were lost to other runs")
    won = first.join(log.read([mine]).select("job_hash"), "job_hash", "left_semi").select(*first.columns)
    return won.unionByName(first.filter("job_hash is null"))


def compact(log: RegistryLog, now: Column, tries: int = 20) -> int:
    """Live entries in one folder instead of all that are there, expired ones gone; first sights stay as they are. Returns the commit's number.

    The folders that are replaced stay for readers of earlier commits, until vacuum.
    """
    _, folders = log.last()
    entry = F.min(F.struct("first_seen_ts", *[c for c in REGISTRY.fieldNames() if c not in ("job_hash", "first_seen_ts")])).alias("e")
    live = dedupe.live_registry(log.read(folders), now).groupBy("job_hash").agg(entry)
    merged = log.write(live.select("job_hash", "e.*"), "compacted")
    for _ in range(tries):
        version, there = log.last()
        if not set(folders) <= set(there):
            raise ConflictError("another run replaced folders that were being compacted")
        if log.commit(version + 1, [merged, *[f for f in there if f not in folders]], compacted="true"):  # what was committed meanwhile stays
            return version + 1
    raise ConflictError(f"{tries} commits of a compaction were lost to other runs")


def vacuum(log: RegistryLog, keep: int = 1) -> list[str]:
    """Removes folders that none of the last `keep` commits names, and the log's files before those; returns the folders.

    For times when no run is under way: the folder of a run that hasn't committed yet is one that no commit names.
    """
    version, _ = log.last()
    first = max(1, version - keep + 1)
    named = {f for v in range(first, version + 1) for f in log.at(v)}
    gone = [f"entries/{n}" for n in shared.names(log.spark, f"{log.path}/entries") if f"entries/{n}" not in named]
    for f in gone:
        shared.remove(log.spark, f"{log.path}/{f}")
    for n in shared.names(log.spark, f"{log.path}/_log"):
        if n[:20].isdigit() and int(n[:20]) < first:
            shared.remove(log.spark, f"{log.path}/_log/{n}")
    return gone
