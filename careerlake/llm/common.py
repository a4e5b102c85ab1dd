"""Helpers shared by the corpus operators: reading tables, shared-folder tables, id splits."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a dataset folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty; bytes that aren't UTF-8: U+FFFD), so that further columns can't clash."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.make_valid_utf8(F.col(text_col).cast("string")), F.lit("")).alias("text"))


def id_hash(col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def held_out(mod: int, rest: int, col: str = "doc_id") -> Column:
    return id_hash(col) % mod == rest


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a session without one (tests) gets a local one, if it runs on this machine alone."""
    ctx = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = ctx._jsc.sc().getCheckpointDir()
        if known.isEmpty():
            if not re.fullmatch(r"local(\[[^\]]*\])?", ctx.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            ctx.setCheckpointDir(tempfile.mkdtemp(prefix="careerlake-"))
            known = ctx._jsc.sc().getCheckpointDir()
        found = known.get()
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def _remove_late(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone when Python ends; the folder is temporary anyway
        return


class Saved:
    """A DataFrame written as a table in the shared folder, so that its lineage ends there.

    Lost executors cost only the tasks that were running: readers go back to the files.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)
        atexit.register(_remove_late, self.spark, self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, rows: int | None = None) -> DataFrame:
    """mapInArrow with a function made once for each task: make() loads what the task needs. rows: it gets slices of so many rows at most, not whole batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            for at in range(0, b.num_rows, rows or b.num_rows or 1):
                yield f(b.slice(at, rows))

    return df.mapInArrow(run, schema)


def filter_arrow(docs: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """map_arrow with a function that only drops rows; columns keep their names, dots and all."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    return map_arrow(plain, make, plain.schema).toDF(*names)


def as_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
