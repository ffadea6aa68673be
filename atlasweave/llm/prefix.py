"""Running sums and gapless numbers over more rows than one task can hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(rows: DataFrame, group: list[str], bucket: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group up to this one.

    ``group`` columns and ``bucket`` (long, at least 0) hold no nulls.  Rows are in
    order of ``bucket``, whose order agrees with ``order``, then of ``order``.  Only
    a bucket's rows meet in one task; buckets are added up from their sums, and
    those in runs of 128, so no window grows with the rows themselves.
    """
    rows = rows.withColumn("_v", value)
    sums = rows.groupBy(*group, bucket).agg(F.sum("_v").alias("_s")).withColumn("_c", F.shiftright(bucket, 7))
    tops = sums.groupBy(*group, "_c").agg(F.sum("_s").alias("_t"))
    tops = tops.select(*group, "_c", (F.sum("_t").over(Window.partitionBy(*group).orderBy("_c")) - F.col("_t")).alias("_top"))
    inside = sums.withColumn("_in", F.sum("_s").over(Window.partitionBy(*group, "_c").orderBy(bucket)) - F.col("_s"))
    starts = inside.join(tops, [*group, "_c"]).select(*group, bucket, (F.col("_in") + F.col("_top")).alias("_start"))
    own = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_own", F.sum("_v").over(own)).join(starts, [*group, bucket])
    return summed.withColumn(out, F.col("_own") + F.col("_start")).drop("_v", "_own", "_start")
