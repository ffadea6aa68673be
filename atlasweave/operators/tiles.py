"""Tile pyramids: blocks to render, the tiles they are split into, and tile lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import BLOCK_TILES, MAX_ZOOM, MIN_ZOOM, TILE_PIXELS, frame_resolution, tile_path


def check_zooms(low: int, high: int) -> None:
    if not MIN_ZOOM <= low <= high <= MAX_ZOOM:
        raise ValueError(f"zoom levels must satisfy {MIN_ZOOM} <= {low} <= {high} <= {MAX_ZOOM}")


def blocks(spark: SparkSession, low: int = MIN_ZOOM, high: int = MAX_ZOOM, most: int = BLOCK_TILES) -> DataFrame:
    """``z``, ``col``, ``row`` (southernmost), ``cols`` and ``rows`` of every block; the last of a row may be smaller."""
    check_zooms(low, high)
    n = F.pow(F.lit(2), F.col("z")).cast("int")
    zooms = spark.range(low, high + 1).select(F.col("id").cast("int").alias("z")).withColumn("n", n).withColumn("edge", F.least(F.col("n"), F.lit(most)))
    starts = F.sequence(F.lit(0), F.col("n") - 1, F.col("edge"))
    cells = zooms.withColumn("col", F.explode(starts)).withColumn("row", F.explode(starts))
    return cells.select("z", "col", "row", F.least(F.col("edge"), F.col("n") - F.col("col")).alias("cols"), F.least(F.col("edge"), F.col("n") - F.col("row")).alias("rows"))


def with_area(block_rows: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Adds the blocks' areas in the frame's pixels: row 0 is south, y grows downwards."""
    n = F.pow(F.lit(2.0), F.col("z"))
    w, h = F.lit(x1 - x0) / n, F.lit(y1 - y0) / n
    return block_rows.select(
        "*",
        (F.lit(x0) + F.col("col") * w).alias("x0"),
        (F.lit(y0) + (n - (F.col("row") + F.col("rows"))) * h).alias("y0"),
        (F.lit(x0) + (F.col("col") + F.col("cols")) * w).alias("x1"),
        (F.lit(y0) + (n - F.col("row")) * h).alias("y1"),
    )


def manifest(block_rows: DataFrame) -> DataFrame:
    """Every tile with its place in its block's picture and its path."""
    cells = block_rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("cols") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    tiles = cells.select("z", (F.col("col") + F.col("i")).alias("x"), (F.col("row") + F.col("rows") - 1 - F.col("j")).alias("y"), (F.col("i") * TILE_PIXELS).alias("left"), (F.col("j") * TILE_PIXELS).alias("top"))
    return tiles.withColumn("path", tile_path(F.col("z"), F.col("x"), F.col("y")))


def tile_of(value: Column, low: float, span: float, zoom: Column) -> Column:
    """Number of the tile along one axis; null outside of the frame."""
    n = F.pow(F.lit(2.0), zoom)
    at = F.floor((value - low) / span * n).cast("int")
    return F.when(value.between(low, low + span), F.least(at, (n - 1).cast("int")))


def viewer_config(spark: SparkSession, low: int = MIN_ZOOM, high: int = MAX_ZOOM) -> DataFrame:
    """Resolution of every zoom level, as number and as text."""
    check_zooms(low, high)
    zooms = spark.range(low, high + 1).select(F.col("id").cast("int").alias("z"))
    return zooms.withColumn("resolution", frame_resolution(F.col("z"))).withColumn("text", F.format_string("%.10f", "resolution"))


def to_pixels(x: Column, view_origin: Column, scale: Column) -> Column:
    """A frame's coordinate in pixels of the document."""
    return (x - view_origin) * scale
