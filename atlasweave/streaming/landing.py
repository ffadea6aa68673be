"""Gazetteer files that arrive over time, as a stream of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.gazetteers import schema


def landing_stream(spark: SparkSession, folder: str, flavour: str, per_batch: int = 100) -> DataFrame:
    """Rows of CSV files as they land, with ``series`` and ``taken`` from the name of the file, or of the folder that its parts are in."""
    form = r"([^/]*)_(\d{8}_\d{6})\.csv(?:/[^/]*)?$"
    rows = spark.readStream.schema(schema(flavour)).option("header", True).option("multiLine", True).option("escape", '"').option("maxFilesPerTrigger", per_batch).csv(folder)
    name = F.col("_metadata.file_path")
    return rows.withColumn("series", F.regexp_extract(name, form, 1)).withColumn("taken", F.try_to_timestamp(F.regexp_extract(name, form, 2), F.lit("yyyyMMdd_HHmmss")))


def counts_by_window(rows: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Rows of each series by day of the snapshot; files later than ``late`` are left out."""
    return rows.withWatermark("taken", late).groupBy(F.window("taken", width), "series").agg(F.count("*").alias("n"))
