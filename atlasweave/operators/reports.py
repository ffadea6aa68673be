"""Counts and totals of a run, as rows and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import casefold_order


def totals(rows: DataFrame, group: str, amount: str = "population") -> DataFrame:
    """Rows and sum by group, and of all under the group null."""
    return rows.rollup(group).agg(F.count("*").alias("n"), F.coalesce(F.sum(amount), F.lit(0)).cast("long").alias("total"))


def type_counts(rows: DataFrame, kind: str, none: str = "(No type assigned)") -> DataFrame:
    """Rows by type, those without one under ``none``."""
    return rows.groupBy(F.coalesce(F.nullif(F.col(kind), F.lit("")), F.lit(none)).alias("type")).agg(F.count("*").alias("n"))


def road_totals(roads: DataFrame) -> DataFrame:
    """Roads by type and the points that they are drawn with."""
    return roads.groupBy("road_type").agg(F.count("*").alias("roads"), F.sum(F.size("points")).cast("long").alias("points"))


def top_components(rows: DataFrame, path: str, separator: str = "/") -> DataFrame:
    return rows.groupBy(F.get(F.split(path, separator), F.lit(0)).alias("component")).agg(F.count("*").alias("n"))


def processing_report(settlements: DataFrame, points: DataFrame, regions: DataFrame, water: DataFrame, unmatched: DataFrame, roads: DataFrame | None = None) -> DataFrame:
    """``section``, ``key``, ``metric``, ``value`` of all that a run has counted."""

    def rows(df: DataFrame, section: str, key: str, metric: str, value: str) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.coalesce(F.col(key).cast("string"), F.lit("all")).alias("key"), F.lit(metric).alias("metric"), F.col(value).cast("long").alias("value"))

    by_faction = totals(settlements, "faction")
    by_province = totals(settlements.where("province is not null"), "province").where("province is not null")
    issues = settlements.groupBy("faction").agg(F.sum(F.when(F.size("tag_issues") > 0, 1).otherwise(0)).alias("n"))
    missing = settlements.where("population_status <> 'given'").groupBy("province").agg(F.count("*").alias("n"))
    out = rows(by_faction, "factions", "faction", "settlements", "n").unionByName(rows(by_faction, "factions", "faction", "population", "total"))
    for df, section, key, metric, value in (
        (by_province, "provinces", "province", "settlements", "n"),
        (by_province, "provinces", "province", "population", "total"),
        (type_counts(points, "poi_type"), "points", "type", "count", "n"),
        (type_counts(regions, "province_type"), "regions", "type", "count", "n"),
        (type_counts(water, "waterbody_type"), "water", "type", "count", "n"),
        (issues, "invalid_tags", "faction", "count", "n"),
        (missing, "missing_population", "province", "count", "n"),
        (unmatched.groupBy("status").agg(F.count("*").alias("n")), "reconciliation", "status", "count", "n"),
    ):
        out = out.unionByName(rows(df, section, key, metric, value))
    if roads is not None:
        by_type = road_totals(roads)
        out = out.unionByName(rows(by_type, "roads", "road_type", "count", "roads")).unionByName(rows(by_type, "roads", "road_type", "points", "points"))
    return out


def as_text(report: DataFrame) -> DataFrame:
    """Lines of a report in order of section and key."""
    return report.orderBy("section", *casefold_order(F.col("key")), "metric").select(F.format_string("%-20s %-24s %-14s %,12d", "section", "key", "metric", "value").alias("line"))


def first_and_more(rows: DataFrame, line: str, order: str, most: int = 10) -> DataFrame:
    """The first lines, and how many more there are if any."""
    top = rows.orderBy(order).limit(most).select(F.col(order).cast("string").alias("at"), F.col(line).alias("line"))
    more = rows.agg((F.count("*") - most).alias("n")).where("n > 0").select(F.lit("~").alias("at"), F.format_string("... and %d more", "n").alias("line"))
    return top.unionByName(more)


def reject_log(settlements: DataFrame) -> DataFrame:
    """Lines about elements that were left out, with why and where; no rows if none was."""
    bad = settlements.where("reason is not null")
    return bad.orderBy("doc", "doc_order").select(F.format_string("%s at %s: <%s> %s", "reason", F.array_join("path", "/"), "tag", F.to_json("attrs")).alias("line"))


def duplicate_log(duplicates: DataFrame, name: str = "name") -> DataFrame:
    """Lines about repeated names with all their occurrences, after one with the totals."""
    total = duplicates.agg(F.count("*").alias("groups"), F.coalesce(F.sum("occurrences"), F.lit(0)).alias("rows")).where("groups > 0")
    head = total.select(F.lit("").alias("at"), F.format_string("%d names, %d entries", "groups", "rows").alias("line"))
    return head.unionByName(duplicates.select(F.col(name).alias("at"), F.format_string("%s: %d times %s", F.col(name), F.col("occurrences"), F.to_json("entries")).alias("line"))).orderBy("at")


def reconciliation_lines(status: DataFrame, key: str) -> DataFrame:
    """Summary of a two-sided comparison, then each one-sided key in case-folded order."""
    summary = status.groupBy("status").agg(F.count("*").alias("n")).select(F.lit(0).alias("part"), F.col("status").alias("at"), F.format_string("%s: %d", "status", "n").alias("line"))
    single = status.where("status <> 'both'").select(F.lit(1).alias("part"), F.col(key).alias("at"), F.format_string("  %s (%s)", F.col(key), F.col("status")).alias("line"))
    return summary.unionByName(single).orderBy("part", *casefold_order(F.col("at")))
