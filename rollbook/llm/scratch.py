"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset in a session on one machine (tests), a new one is set."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors can reach")
        folder = "file://" + tempfile.mkdtemp(prefix="rollbook-")
        spark.conf.set(SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other step uses."""
    return f"{shared_folder(spark)}/rollbook-llm/{name}-{uuid.uuid4().hex}"


#: Folders of the tables that the innermost `settled` step has written so far.
_written: list[list[str]] = []
#: Where a kept table lies.
_folder: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def _delete(spark: SparkSession, folders: Iterable[str]) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a step as Parquet and read it back.

    It is computed once, whoever reads it; a lost executor costs its tasks and not the table. Folders stay
    until they are dropped, the step around them is settled, or the owner of the shared folder clears it, as the returned
    rows are read lazily.
    """
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    for folders in _written[-1:]:
        folders.append(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    _folder[out] = folder
    return out


def drop(*kept: DataFrame) -> None:
    """Delete tables that `keep` returned and nothing reads any more; other tables stay."""
    for one in kept:
        folder = _folder.pop(one, None)
        if folder:
            _delete(one.sparkSession, [folder])


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` returns, written; the tables that were kept on the way are deleted."""
    _written.append([])
    try:
        out = keep(make(), name)
    finally:
        folders = _written.pop()
    for one in _written[-1:]:
        one.append(folders[-1])
    _delete(spark, folders[:-1])
    return out
