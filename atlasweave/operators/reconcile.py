"""Enriching map rows from gazetteers, and what either side lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tags, values
from ..functions.names import comparison_variants, fill_empty, lookup_variants


def _wiki(prefix: str = "wiki_") -> Column:
    return F.struct(*[values.empty_to_null(F.col(prefix + k)).alias(k) for k in ("title", "url", "description", "image")])


def enrich_settlements(settlements: DataFrame, gazetteer: DataFrame, default_population: Column | None = None) -> DataFrame:
    """Map settlements with population, size, tags, notes and wiki from a gazetteer keyed by ``faction`` and ``name``.

    ``population_status`` says whether the population was given, is missing from the
    row, can't be read, or the row is not in the gazetteer; the last three take
    ``default_population`` (one drawn by name, unless given).
    """
    default = values.drawn_population(F.col("name")) if default_population is None else default_population
    joined = settlements.join(gazetteer.withColumn("_in", F.lit(True)), ["faction", "name"], "left")
    given = values.safe_int(F.col("Population"))
    status = F.when(F.col("_in").isNull(), "not_in_gazetteer").when(values.blank(F.col("Population")), "missing").when(given.isNull(), "unparseable").otherwise("given")
    people = F.coalesce(given, default).cast("int")
    out = joined.withColumn("population_status", status).withColumn("population", people).withColumn("size_category", values.size_category(people))
    out = out.withColumn("tags", tags.parse_tags(F.col("Tags"), F.col("Trade"))).withColumn("notes", tags.parse_notes(F.col("Notes")))
    return out.withColumn("tag_issues", tags.tag_issues(F.col("tags"))).withColumn("wiki", _wiki()).drop("_in")


def enrich_typed(settlements: DataFrame, gazetteer: DataFrame, type_col: str = "hold_type") -> DataFrame:
    """As ``enrich_settlements`` for rows with a type and no population; a miss leaves the type ''."""
    joined = settlements.join(gazetteer.withColumn("_in", F.lit(True)), ["faction", "name"], "left")
    out = joined.withColumn(type_col, F.coalesce(F.trim("Type"), F.lit(""))).withColumn("in_gazetteer", F.coalesce("_in", F.lit(False)))
    out = out.withColumn("tags", tags.parse_tags(F.col("Tags"), F.col("Trade"))).withColumn("notes", tags.parse_notes(F.col("Notes")))
    return out.withColumn("tag_issues", tags.tag_issues(F.col("tags"))).withColumn("wiki", _wiki()).drop("_in", "Type")


def enrich_regions(labels: DataFrame, provinces: DataFrame) -> DataFrame:
    """Region labels with title, superior, population and info; the label's own type wins."""
    p = provinces.withColumnRenamed("province_type", "_type").withColumn("_people", F.coalesce(values.population(F.col("population")), F.lit(0)).cast("int")).drop("population")
    joined = labels.join(p, "name", "left")
    info = F.struct(*[values.trimmed_or_null(F.col(f"info_{a}")).alias(a) for a in ("wiki_url", "image", "description")])
    return joined.select(*labels.columns, F.coalesce("formal_title", F.lit("")).alias("formal_title"), F.coalesce("part_of", F.lit("")).alias("part_of"), F.coalesce("_people", F.lit(0)).alias("population"), info.alias("info"))


def missing_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def status_of_both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of either side with ``status``: both, left_only or right_only; one shuffle, no outer join."""
    marked = left.select(*keys, F.lit(1).alias("side")).unionByName(right.select(*keys, F.lit(2).alias("side")))
    both = marked.groupBy(*keys).agg(F.min("side").alias("a"), F.max("side").alias("b"))
    return both.select(*keys, F.when(F.col("a") != F.col("b"), "both").when(F.col("a") == 1, "left_only").otherwise("right_only").alias("status"))


def drift(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of both sides whose values differ."""
    r = right.select(key, F.col(value).alias("other"))
    return left.join(r, key).where(F.col(value) != F.col("other"))


def match_variants(probe: DataFrame, build: DataFrame, probe_name: str, build_name: str, probe_id: str, build_ord: str) -> DataFrame:
    """For each probe row the first build row that shares its earliest variant.

    Both sides are exploded into spelling variants and joined by equality; variant
    order on the probe side decides, then row order on the build side.
    """
    p = probe.select(probe_id, F.posexplode(comparison_variants(F.col(probe_name))).alias("rank", "variant"))
    b = build.select(F.explode(comparison_variants(F.col(build_name))).alias("variant"), build_ord)
    b = b.groupBy("variant").agg(F.min(build_ord).alias(build_ord))
    met = p.join(b, "variant")
    return met.groupBy(probe_id).agg(F.min(F.struct("rank", build_ord)).alias("_b")).select(probe_id, F.col(f"_b.{build_ord}").alias(build_ord))


def merge(target: DataFrame, secondary: DataFrame, fills: dict[str, str], name: str = "Settlement", order: str = "_ord", new_tags: str = '"source:MadAlfred"') -> DataFrame:
    """``target`` with its empty columns filled from matching rows of ``secondary``, and the others appended.

    ``fills`` maps target columns to secondary ones.  Of several matches the first
    that isn't blank fills a column; appended rows carry ``new_tags``; repeated names
    among them stay.
    """
    pairs = match_variants(secondary.withColumnRenamed(order, "_p"), target, name, name, "_p", order)
    s = secondary.select(F.col(order).alias("_p"), F.col(name).alias(f"_{name}"), *[F.col(v).alias(f"_{k}") for k, v in fills.items()])
    matched = pairs.join(s, "_p").groupBy(order).agg(*[F.min_by(f"_{k}", F.when(~values.blank(F.col(f"_{k}")), F.col("_p"))).alias(f"_{k}") for k in fills])
    filled = target.join(matched, order, "left").select(*[fill_empty(F.col(c), F.col(f"_{c}")).alias(c) if c in fills else F.col(c) for c in target.columns])
    new = s.join(pairs.select("_p"), "_p", "left_anti")
    given = {name: F.col(f"_{name}"), "Tags": F.lit(new_tags), order: F.col("_p") + F.lit(1 << 40), **{k: F.coalesce(f"_{k}", F.lit("")) for k in fills}}
    return filled.unionByName(new.select(*[given.get(c, F.lit("")).alias(c) for c in target.columns]))


def overwrite(original: DataFrame, update: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``original`` with ``columns`` taken from ``update`` wherever that has the key, also where it is empty."""
    u = update.select(key, *[F.col(c).alias(f"_{c}") for c in columns]).withColumn("_in", F.lit(True))
    joined = original.join(u, key, "left")
    return joined.select(*[F.when(F.col("_in"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in original.columns])


def needs_description(url: Column, description: Column) -> Column:
    return ~values.blank(url) & values.blank(description)


def wiki_lookup(settlements: DataFrame, pages: DataFrame, name: str = "Settlement", title: str = "title") -> DataFrame:
    """The first name variant that a page has as title; one row per settlement, blanks where none."""
    keyed = settlements.withColumn("_s", F.monotonically_increasing_id())
    variants = keyed.select("_s", F.posexplode(lookup_variants(F.col(name))).alias("rank", "variant"))
    found = variants.join(pages.withColumn("variant", F.col(title)), "variant").groupBy("_s").agg(F.min_by(F.struct(*pages.columns), "rank").alias("page"))
    return keyed.join(found, "_s", "left").withColumn("status", F.when(F.col("page").isNull(), "missing").otherwise("found")).drop("_s")
