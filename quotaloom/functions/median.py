"""Exact median per group without gathering a group in one task.

``percentile``/``median`` buffer every distinct value of a group in one task. Here equal
values collapse to (group, value, count) first, map-side, so a value that most rows share costs
one row. Then

1. values are counted by coarse bucket, a monotone function of the value (its logarithm in
   steps of 1/256, signed): the few buckets of a group are cumulated in order, which tells the
   bucket and the rank within it of the one or two middle values;
2. only the values of those buckets are cumulated one by one.

The median is the mean of the two middle values (pandas' definition for an even count).
Everything is a lazy plan: no sort of the rows, no checkpoint, no job while it is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Steps of a bucket per doubling of the value, and an offset above any logarithm of a double in such steps.
_STEPS, _OFFSET = 256, 300_000


def _bucket(v: Column) -> Column:
    size = F.floor(F.log2(F.abs(v)) * F.lit(float(_STEPS))) + F.lit(_OFFSET)
    return F.when(v == 0, F.lit(0).cast("bigint")).otherwise(F.signum(v).cast("bigint") * size)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, alias: str = "median",
                 partitions: int | None = None) -> DataFrame:
    """Per non-null ``keys``: the median of the non-null, finite values. ``partitions``: of the value
    counts, where the session's number does not suit."""
    keys = list(keys)
    v = df.select(*keys, F.col(value).cast("double").alias("_v")).na.drop().filter(F.abs(F.col("_v")) < float("inf"))
    counts = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", _bucket(F.col("_v")))
    if partitions:
        counts = counts.repartition(partitions, *keys, "_b")
    whole = Window.partitionBy(*keys)
    up_to = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"))
    buckets = buckets.withColumns({"_n": F.sum("_c").over(whole), "_to": F.sum("_c").over(up_to)})
    ranks = F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1))
    wanted = buckets.select(*keys, "_b", (F.col("_to") - F.col("_c")).alias("_before"), "_to", F.explode(ranks).alias("_k"))
    wanted = wanted.filter((F.col("_k") > F.col("_before")) & (F.col("_k") <= F.col("_to")))
    wanted = wanted.groupBy(*keys, "_b").agg(F.collect_list(F.col("_k") - F.col("_before")).alias("_ks"))  # one or two
    near = counts.join(wanted, [*keys, "_b"])
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("_at", F.sum("_c").over(inside))
    hit = F.exists("_ks", lambda k: (k <= F.col("_at")) & (k > F.col("_at") - F.col("_c")))
    return near.filter(hit).groupBy(*keys).agg(F.avg("_v").alias(alias))
