"""The folder that driver and executors share: intermediate tables that end a lineage, and small files that appear whole."""

from __future__ import annotations

import atexit
import logging
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a session without it gets a temporary one if it runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        ctx = spark.sparkContext
        known = ctx._jsc.sc().getCheckpointDir()
        if known.isEmpty():
            if not re.fullmatch(r"local(\[[^\]]*\])?", ctx.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            ctx.setCheckpointDir(tempfile.mkdtemp(prefix="careerlake-"))
            known = ctx._jsc.sc().getCheckpointDir()
        found = known.get()
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when Python ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_late, spark, path)
    return path


def _remove_late(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone when Python ends; the folder is temporary anyway
        return


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again, so that its lineage ends there."""
    path, schema = scratch(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What is in a folder, in order; nothing if there is no such folder."""
    at, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    at, fs = _fs(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def _rename(spark: SparkSession, source: str, target: str, replace: bool) -> None:
    """By the file system's own rename, which is atomic where the store's is; without replace it fails if the target is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if replace else kind.NONE
    at = hadoop.Path(target)
    hadoop.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(hadoop.Path(source), at, how)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file that appears whole; False, and nothing changed, if there is one already."""
    at, fs = _fs(spark, path)
    fs.mkdirs(at.getParent())
    made = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp"
    write_text(spark, made, text)
    try:
        _rename(spark, made, path, replace=False)
    except Py4JJavaError as e:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(made), False)
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """The file with this text instead of what it held; who reads it sees the old or the new, never a part."""
    at, fs = _fs(spark, path)
    fs.mkdirs(at.getParent())
    made = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp"
    write_text(spark, made, text)
    _rename(spark, made, path, replace=True)


def publish(rows: DataFrame, path: str, kind: str = "json", must: bool = True, **options) -> bool:
    """rows as one file at path, in their order, put there by a rename once it is whole; the old one stays until then.

    A task writes the file, so rows never pass through the driver. With must=False a failure is logged and passed, and False returned.
    """
    spark = rows.sparkSession
    made = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp"
    try:
        rows.coalesce(1).write.format(kind).options(**options).save(made)
        parts = [n for n in names(spark, made) if n.startswith("part-")]
        if parts:
            _rename(spark, f"{made}/{parts[0]}", path, replace=True)
        else:  # no rows, and a format that writes no file for none
            replace_text(spark, path, "")
    except Exception as e:
        if must:
            raise
        log.error("not published, %s stays as it was: %s", path, str(e).splitlines()[0])
        return False
    finally:
        _remove_late(spark, made)
    return True
