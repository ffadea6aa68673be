"""First and last of repeated rows, and reports of repetition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _one(rows: DataFrame, keys: list[str], pick) -> DataFrame:
    """One row per key by an aggregate, whose partial sums keep a hot key off a single task."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(pick.alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col("_r").getField(c).alias(c) for c in rows.columns]) if rest else best.select(*keys)


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return _one(rows, keys, F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), order))


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return _one(rows, keys, F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), order))


def duplicates(rows: DataFrame, keys: list[str], order: str, *carried: str) -> DataFrame:
    """Repeated keys with how often they occur and their rows in order."""
    entry = F.sort_array(F.collect_list(F.struct(order, *carried)))
    return rows.groupBy(*keys).agg(F.count("*").alias("occurrences"), entry.alias("entries")).where("occurrences > 1")


def extra_occurrences(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each occurrence of a key after its first, with the first one's order."""
    first = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("first_order", F.min(order).over(Window.partitionBy(*keys))).withColumn("_n", F.row_number().over(first)).where("_n > 1").drop("_n")
