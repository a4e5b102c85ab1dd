"""Readers. All take any path Spark can read and an explicit schema; nothing is inferred."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from careerlake import shared
from careerlake.functions.text import strip
from careerlake.schemas import JOB, MANIFEST, PORTAL_SUMMARY


def jsonl(spark: SparkSession, path: str, schema: StructType, earliest: str | None = None, latest: str | None = None) -> DataFrame:
    """JSON Lines under run_date= (and run_id=) folders. A bad row fails the read. Dates outside [earliest, latest] are invisible.

    The range is on the partition column, so other days' files aren't listed into the scan.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for bound, keep in ((earliest, F.col("run_date") >= F.lit(earliest)), (latest, F.col("run_date") <= F.lit(latest))):
        rows = rows.filter(keep) if bound else rows
    return rows


def folders(path: str, earliest: str, latest: str, template: str = "run_date={run_date}") -> list[str]:
    """The folders of a range of dates, made from the dates and the template alone."""
    first, last = date.fromisoformat(earliest), date.fromisoformat(latest)
    return [f"{path.rstrip('/')}/{template.format(run_date=first + timedelta(days=k))}" for k in range((last - first).days + 1)]


def projected(spark: SparkSession, path: str, schema: StructType, earliest: str, latest: str, template: str = "run_date={run_date}") -> DataFrame:
    """JSON Lines of a range of dates by partition projection: no folder outside the range is looked at, and the root isn't listed. Dates without a folder have no rows."""
    there = [f for f in folders(path, earliest, latest, template) if shared.exists(spark, f)]
    typed = StructType([*schema.fields, *[StructField(c, StringType()) for c in ("run_date", "run_id") if c not in schema.fieldNames()]])
    if not there:
        return spark.createDataFrame([], typed)
    return spark.read.schema(typed).option("mode", "FAILFAST").option("basePath", path).json(there)


def bronze_jobs(spark: SparkSession, path: str, **dates: str) -> DataFrame:
    """The feed; with both ends of a range of dates its folders are projected, not listed."""
    return projected(spark, path, JOB, **dates) if {"earliest", "latest"} <= set(dates) else jsonl(spark, path, JOB, **dates)


def ops_portal_summary(spark: SparkSession, path: str, **dates: str) -> DataFrame:
    return jsonl(spark, path, PORTAL_SUMMARY, **dates)


def lines_in_order(rows: DataFrame, name: str = "pos") -> DataFrame:
    """rows read from text files, with their place over all files: files by name, each from its start, however they were cut into splits and dealt to tasks.

    A task reads a split from its start, so a row's place is the count of rows in the splits before and its own number within its split. Only the
    counts, one for each split, are put in order in one place. rows have the columns of line_place.
    """
    kept = shared.saved(rows, "lines")
    splits = kept.groupBy("_file", "_start").agg(F.count("*").alias("_n"), F.min("_line").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return kept.join(splits.withColumn("_before", before).drop("_n"), ["_file", "_start"]).withColumn(name, F.col("_before") + F.col("_line") - F.col("_first")).drop("_file", "_start", "_line", "_first", "_before")


def line_place() -> list[Column]:
    """A row's file, where its split starts, and its number in its task: larger down a split."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line")]


def seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """(pos, raw_value): the url column of a seed CSV, or of a folder of them by name, stripped, in order, without empty and # rows.

    The header is found whatever its case and spaces, after a byte-order mark too; ValueError if there is no such header.
    """
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    if not rows.columns:
        raise ValueError(f"seed CSV at {path} has no header row")
    named = {c.replace("﻿", "").strip().lower(): c for c in rows.columns}
    if "url" not in named:
        raise ValueError(f"seed CSV at {path} has no 'url' column")
    value = strip(F.coalesce(F.col(f"`{named['url']}`"), F.lit("")))
    placed = lines_in_order(rows.select(value.alias("raw_value"), *line_place())).select("pos", "raw_value")
    return placed.filter("raw_value <> '' and not startswith(raw_value, '#')")


def file_digest(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of whole files."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"))


def last_row_wins(rows: DataFrame, key: str, place: str) -> DataFrame:
    """The row of each key with the largest place."""
    row = F.max_by(F.struct(*rows.columns), place).alias("r")
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(row).select("r.*")


def portal_summary_file(spark: SparkSession, path: str) -> DataFrame:
    """A run's portal rows; of rows with one portal the last line counts, in the last file by name."""
    rows = spark.read.schema(PORTAL_SUMMARY).json(path)
    return last_row_wins(rows.select("*", F.struct(*line_place()).alias("_place")), "portal_key", "_place").drop("_place")


def latest_run(spark: SparkSession, root: str) -> str | None:
    """The last, by name, of the portal summaries in run_* folders under root; null if there is none."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/run_*/portal_summary.jsonl")
    found = pattern.getFileSystem(conf).globStatus(pattern)
    return max((s.getPath().toString() for s in found or []), default=None)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)
