"""Steps that several plans use, kept in the cluster's shared folder.

Executors may be lost at any time, so a shared step is a checkpoint or a written table, never
executor-local storage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints.

    Only a local session without one gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None and context.getCheckpointDir() is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="rollbook-")
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written columns are pruned and filtered by each user of the step, and lineage is cut.
    """
    return _write(df, new_path(df.sparkSession, name))


@contextmanager
def kept(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`keep`, for a block; the written table is removed at its end."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    try:
        yield _write(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
