"""Places of rows in a total order, without a task that sees all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.llm.scratch import keep


def ranked(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """The rows of `df` with `rank` (from 0, within the group) and `n` (rows of the group).

    `order` has to begin with columns that keep a group together. Rows are dealt out by ranges of the order
    and sorted there; a rank is the place within the range and the group's rows in the ranges before, of
    which there is one count for each range and group. Rows that are equal in the whole order may be split.
    `group` mustn't be null.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    placed = spread.repartitionByRange(ranges, *order, "_spread").sortWithinPartitions(*order, "_spread").drop("_spread")
    placed = keep(placed.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), name)
    counts = placed.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = F.sum("_rows").over(W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.withColumns({"_before": F.coalesce(before, F.lit(0)), "n": F.sum("_rows").over(W.partitionBy(group))})
    both = placed.join(counts.drop("_rows"), ["_range", group])
    return both.withColumn("rank", F.expr("_at - _first + _before")).drop("_range", "_at", "_first", "_before")


def running(df: DataFrame, order: Sequence[Column], weight: str, name: str) -> DataFrame:
    """The rows of `df` with `before`, the sum of `weight` over all rows ahead of them in the order, which has to be total."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema)}, _range int, _upto bigint"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            sums = np.cumsum(batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False)) + upto
            upto = int(sums[-1]) if len(sums) else upto
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(sums)], [*batch.schema.names, "_range", "_upto"])

    placed = keep(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(add, schema), name)
    # one row for each range
    ahead = placed.groupBy("_range").agg(F.max("_upto").alias("_all"))
    ahead = ahead.select("_range", F.coalesce(F.sum("_all").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    return placed.join(ahead, "_range").withColumn("before", F.expr(f"_ahead + _upto - {weight}")).drop("_range", "_upto", "_ahead")
