"""Places of rows within a key, without gathering a key in one task.

Rows are range-partitioned on (key, order) and sorted; a key of any size spreads
over as many tasks as its rows need.  A row's place is its number in its task
plus the rows of its key in the tasks before, from a table of one row for each
(task, key)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.common import Scratch

#: A table of one row for each task and key is broadcast up to this many rows;
#: beyond, the join shuffles both sides.
BROADCAST_ROWS = 100_000


def ranked(rows: DataFrame, key: str, order: list, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``pos`` (gapless from 0 within the non-null ``key``, in
    ``order``; equal rows in any order) and ``size`` (rows of the key)."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [key, *order, "_tie"]
    placed = scratch.write(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
                           .withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftright("_at", 33)                      # the task that wrote the row
    counts = placed.groupBy(key, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(key)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.write(counts.select(
        key, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size")), f"{name}-starts")
    small = starts.count() <= BROADCAST_ROWS
    return (placed.withColumn("_part", part).join(F.broadcast(starts) if small else starts, [key, "_part"])
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift"))
