"""Report files."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from rollbook.functions.labels import rename_columns

MAX_ROWS = 1_000_000
#: Rows of a CSV file at most: cells may hold line breaks, so a file can't be split and one task reads it whole.
CSV_ROWS = 25_000
DATE_FORMAT = "yyyy-MM-dd"
PADDING, WIDTH_CAP = 2, 50
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}


MANIFEST = "_manifest"  # readers of part files pass over names that begin with an underscore


class Folders:
    """The few things that publishing asks of a file system, whichever one Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        if not self._files.rename(self._path(old), self._path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def _former(path: str) -> str:
    return f"{path.rstrip('/')}.former"


def published(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the last good report of ``path``, if there is one.

    A run that broke off between its two renames has left it under the former name.
    """
    folders = Folders(spark, path)
    for one in (path, _former(path)):
        if folders.exists(one):
            return one
    return None


def publish(spark: SparkSession, path: str, write: Callable[[str], Mapping[str, object]]) -> None:
    """Let ``write`` fill a new folder beside ``path``, then put it in the place of ``path``.

    ``write`` returns what the folder's manifest is to say; the manifest is written last. If anything fails before, the
    report that was there stays, and the new folder is removed. Folders are only renamed, so
    nobody reads half a report.
    """
    folders = Folders(spark, path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        said = json.dumps(dict(write(staging)), sort_keys=True)
        spark.createDataFrame([(said,)], "manifest string").coalesce(1).write.text(
            f"{staging}/{MANIFEST}")
    except BaseException:
        folders.delete(staging)
        raise
    former = _former(path)
    if folders.exists(path):
        folders.delete(former)
        folders.rename(path, former)
    folders.rename(staging, path)
    folders.delete(former)


def manifest(spark: SparkSession, path: str) -> dict[str, object] | None:
    """What the manifest of the last good report says; None without a report."""
    folder = published(spark, path)
    if folder is None or not Folders(spark, path).exists(f"{folder}/{MANIFEST}"):
        return None
    return json.loads(spark.read.text(f"{folder}/{MANIFEST}").first()[0])


def export_report(df: DataFrame, path: str, fmt: str = "csv", max_rows: int = MAX_ROWS,
                  names: Mapping[str, str] | None = None,
                  about: Callable[[], Mapping[str, object]] = dict) -> None:
    """Write a report to a directory of part files of at most ``max_rows`` rows (in CSV at most CSV_ROWS), replacing it.

    Tasks write in parallel and nothing passes through the driver. The report that is there is replaced
    when the new one is complete (:func:`publish`); ``about`` is asked then what the manifest is to say. CSV files carry a header row
    and dates as text; Parquet keeps times. ``names`` are the display names. CSV cells keep blanks at
    their edges, quotes (doubled) and line breaks; NULL is an empty cell and empty text a quoted one.
    :func:`read_export` reads them back.
    """
    if fmt == "csv":
        times = [f.name for f in df.schema.fields
                 if isinstance(f.dataType, TimestampType | TimestampNTZType)]
        df = df.withColumns({c: F.date_format(F.col(c), DATE_FORMAT) for c in times})
    if fmt == "csv":
        max_rows = min(max_rows, CSV_ROWS) if max_rows > 0 else CSV_ROWS
    writer = rename_columns(df, names).write.option("maxRecordsPerFile", max_rows)
    writer = (writer.options(**CSV, emptyValue='""') if fmt == "csv" else writer).format(fmt)

    def write(folder: str) -> Mapping[str, object]:
        writer.save(folder)
        return about()

    publish(df.sparkSession, path, write)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The cells of a report exported as CSV, whole; ``schema`` gives names and types in order.

    Another mark for NULL than empty text keeps the two apart: only an empty cell without quotes is NULL.
    """
    path = published(spark, path) or path
    options = {**CSV, "multiLine": True, "enforceSchema": True, "nullValue": "\u0001", "emptyValue": ""}
    return spark.read.schema(schema).options(**options).csv(path)


def column_width_profile(df: DataFrame) -> DataFrame:
    """Display width per column: longest text or header, plus padding, at most 50.

    One pass over all rows; NULL counts as empty, so an empty report gives the header widths.
    """
    def width(name: str):
        longest = F.coalesce(F.max(F.length(F.col(name).cast("string"))), F.lit(0))
        return F.least(F.greatest(longest, F.lit(len(name))) + PADDING, F.lit(WIDTH_CAP))

    entries = [F.struct(F.lit(c).alias("column"), width(c).cast("bigint").alias("width"))
               for c in df.columns]
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))
