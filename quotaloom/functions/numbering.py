"""Numbers 1, 2, 3 … over a whole table in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

#: ``monotonically_increasing_id`` holds the partition above this bit and the place in it below.
PLACE_BITS = 33


def number_rows(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with a column ``name``: a row's place, from 1, in the order of the columns ``order``, nulls first.

    Rows are range-partitioned and sorted per partition; the counts of the partitions before a row's own (one row a
    partition) are added to its place inside. The sorted rows are checkpointed, so that places and counts come from the same
    partitions when a task runs again. ``order`` should be unique: rows that tie are numbered in any order, still
    each number once, but a second run may give them the other way round. An empty table gives no rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(c).asc_nulls_first() for c in order]
    placed = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("_place", F.monotonically_increasing_id()).checkpoint())
    part = F.shiftright("_place", PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_place") - F.shiftleft(part, PLACE_BITS)
    # one row a partition: bounded by the number of shuffle partitions, not by the data
    numbered = placed.join(F.broadcast(starts), part == F.col("_part"))
    return numbered.withColumn(name, F.col("_start") + inside + 1).drop("_place", "_part", "_start")
