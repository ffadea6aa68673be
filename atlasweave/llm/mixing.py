"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import running_sum
from .scratch import Scratch

SPACE = r"[\x20\x09-\x0D]"
MOST = 3  # times that a document, and so a source, may be repeated
ROWS = 2000  # rows of a bucket on average


def _ranged(rows: DataFrame, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` range-sorted and written with ``range``, the number of their range."""
    return scratch.write(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id().cast("long")), name)


def source_targets(sizes: DataFrame, scratch: Scratch, most: int = MOST, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source``, ``sid``, ``source_size``, ``target`` from a row (``source``, ``source_size``) per source.

    Sources by code point, null last, take the weights in turn and share the sum
    of all sizes; no target is above ``most`` times its source's size, and what
    that leaves is shared again by weight.  In order of size by weight the sources
    that stop come first, so each source's level follows from the sums before it.
    Both orders are range-sorted, so that sources may be as many as hosts.
    """
    by_name = [F.col("source").asc_nulls_last()]
    named = running_sum(_ranged(sizes, by_name, scratch, "by_name"), [], "range", by_name, F.lit(1).cast("long"), "place").drop("range")
    ws = F.array(*[F.lit(float(w)) for w in weights])
    rows = named.withColumn("weight", F.get(ws, (F.col("place") - 1) % len(weights))).withColumn("limit", F.col("source_size") * F.lit(float(most))).withColumn("ratio", F.col("limit") / F.col("weight"))
    by_level = [F.col("ratio"), F.col("place")]
    rows = _ranged(rows, by_level, scratch, "by_level")
    total = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    rows = running_sum(running_sum(rows, [], "range", by_level, F.col("limit"), "limits"), [], "range", by_level, F.col("weight"), "shared")
    rest = F.lit(total.size or 0) - (F.col("limits") - F.col("limit"))
    rows = scratch.write(rows.withColumn("share", rest / (F.lit(total.weight or 0.0) - (F.col("shared") - F.col("weight")))), "shares")
    # once a source stays below its limit, its level holds for all that follow
    first = rows.where("share <= ratio").agg(F.min(F.struct("ratio", "place", "share")).alias("at")).first()["at"]
    target = F.col("limit")
    if first:
        stops = (F.col("ratio") < first.ratio) | ((F.col("ratio") == first.ratio) & (F.col("place") < first.place))
        target = F.when(stops, target).otherwise(F.lit(first.share) * F.col("weight"))
    return rows.select("source", F.col("place").alias("sid"), "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST, weights: tuple[int, ...] = (1, 2, 3), seed: str = "mix") -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of every row.

    Every source's documents are shuffled anew for each time they may be used;
    an entry's virtual finish time is the source's running count of words divided
    by the source's target.  All entries, in order of finish time over all sources,
    are taken until the budget (the sum of all sizes) is reached, so each source
    runs at the rate of its target.  An entry is taken where its middle lies within the
    budget, hence the last one of a source may pass its target by half its size.

    Null text has size 0 and is taken 0 times; a null source is a source of its
    own, the last.  Places are drawn by id and text, so rows without an id, or with
    equal ones, are spread by their texts.  Equal rows are entries of their own, in any
    order among themselves, which changes no value of the result as a whole.  Extra columns
    are ignored; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", 0).otherwise(F.regexp_count(trimmed, F.lit(SPACE + "+")) + 1).cast("long")
    sized = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), F.md5(text.cast("binary")).alias("of"))
    sized = scratch.write(sized, "sized")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    per_source = scratch.write(per_source, "sources")
    targets = source_targets(per_source.select("source", "source_size"), scratch, most, weights)
    times = F.when(F.col("source_size") > 0, F.least(F.ceil(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("int")
    counts = per_source.select(F.col("source").alias("s"), F.ceil(F.col("n") / ROWS).alias("buckets"))
    plan = targets.join(counts, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("s"), "sid", "source_size", "target", times.alias("times"), "buckets")
    plan = scratch.write(plan, "plan")
    planned = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # each pass over a source is shuffled by a hash of its own; its buckets are ranges of that hash
    entries = planned.where("size > 0 and times > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("pass"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("of")).cast("binary"))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    entries = entries.withColumn("key", key).withColumn("bucket", F.col("pass") * F.col("buckets") + F.floor(place * F.col("buckets") / F.lit(2**32)))
    entries = entries.select("uid", "sid", "doc_id", "size", "pass", "key", "bucket", "target")
    tie = [F.col("key"), F.col("doc_id"), F.col("size"), F.col("uid")]
    queued = running_sum(entries, ["sid"], "bucket", tie, F.col("size"), "done")
    queued = queued.withColumn("finish", (F.col("done") - F.col("size") / 2) / F.col("target"))
    queued = scratch.write(queued.select("uid", "sid", "doc_id", "size", "pass", "key", "finish"), "queued")
    # the queue of all sources, range-sorted: each partition is a bucket, so that even crowded times spread
    turn = [F.col("finish"), F.col("sid"), F.col("pass"), *tie]
    ranged = _ranged(queued, turn, scratch, "ranged")
    scratch.drop(queued)
    budget = plan.agg(F.sum("target").alias("budget")).first().budget
    total = running_sum(ranged, [], "range", turn, F.col("size"), "total")
    taken = total.where(F.col("total") - F.col("size") / 2 <= F.lit(budget or 0.0)).groupBy("uid").agg(F.sum("size").alias("taken"))
    return planned.join(taken, "uid", "left").select("uid", F.col("doc_id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def op5_weighted_fair_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = """
WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS o, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
r AS (SELECT *, [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][1 + (sid - 1) % 3] AS weight, source_size * 3.0::DOUBLE AS lim FROM p),
q AS (SELECT *, lim / weight AS ratio FROM r),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(lim) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS share
      FROM q WINDOW b AS (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT arg_min(ratio, (ratio, sid)) AS r0, arg_min(sid, (ratio, sid)) AS s0, arg_min(share, (ratio, sid)) AS level FROM l WHERE share <= ratio),
t AS (SELECT source, sid, source_size, CASE WHEN r0 IS NULL OR (ratio, sid) < (r0, s0) THEN lim ELSE level * weight END AS target FROM l, v),
e AS (SELECT doc_id, sid, size, target, k, md5('mix:' || k || ':' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || o) AS key
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS k)
      WHERE size > 0 AND k < least(ceil(target / source_size), 3)),
f AS (SELECT *, (sum(size) OVER (PARTITION BY sid ORDER BY k, key, doc_id) - size / 2.0::DOUBLE) / target AS finish FROM e),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, sid, k, key, doc_id) - size / 2.0::DOUBLE AS total FROM f),
x AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM g WHERE total <= (SELECT sum(target) FROM t) GROUP BY doc_id)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(x.taken, 0) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN x ON x.doc_id = d.doc_id"""
