"""Five stages from raw documents to shards, each written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.decontaminate import with_leaks
from atlasweave.llm.mixing import mix_sources
from atlasweave.llm.neardup import NearDup, near_duplicates
from atlasweave.llm.rules import with_rules
from atlasweave.llm.scratch import Scratch, free_name
from atlasweave.llm.sharding import balanced_shards


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects, as they were.

    Null, empty and short texts have fewer than 50 words and go.  Repeated rows stay
    or go together; an empty table gives an empty one.
    """
    out = free_name("rules", docs.columns)
    return with_rules(docs, out=out).where(f"{out}.kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of five-word shingles at a similarity of 0.8.

    The one with the smallest id stays, of repeated ids any one; rows without an id
    stay only where none of their group has one, and then one of them.  Texts without
    words are nobody's copies and all stay.
    """
    return near_duplicates(docs, params=NearDup(percent=80), carry=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item; those without text hold none.

    Repeated rows stay or go together; without test items every document stays.
    """
    out = free_name("leak", docs.columns)
    judged = with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=out)
    return judged.where(f"not {out}.contaminated").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; one without words, or null, stays as it is.

    Repeated rows are taken each by itself; a null source is one of its own.
    """
    row, times, copy = (free_name(n, docs.columns) for n in ("row", "times", "copy"))
    rows = Scratch(spark, "mix-in").write(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # numbers that stay; ids may repeat
    mixed = mix_sources(rows.select(F.col(row).alias("doc_id"), "text", "source"))
    n = F.when(F.col("size") == 0, 1).otherwise((F.col("taken") / F.col("size")).cast("int"))
    taken = mixed.select(F.col("doc_id").alias(row), n.alias(times)).where(F.col(times) > 0)
    return rows.join(taken, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids with their shard and slot, equal texts together where a shard has room.

    Null texts count as empty; every row gets a place of its own, also repeated ones
    and those without an id.
    """
    return balanced_shards(docs).drop("uid")


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]
ORACLE_SQL = None  # alignment and label propagation have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        out = scratch.write(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        docs = before = out
    return docs
