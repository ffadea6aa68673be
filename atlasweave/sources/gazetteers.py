"""CSV gazetteers, their header checks and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import safe_int, trimmed_or_null
from ..operators.dedupe import last_wins

_TAIL = "Estate Trade Tags Notes Coordinates Province_2515 Province_2512 Province_2276 Ruler_2515 Ruler_2512 Ruler_2276 wiki_url wiki_title wiki_description wiki_image".split()
HEADERS = {
    "population": ["Settlement", "Population", *_TAIL],
    "type": ["Settlement", "Type", *_TAIL],
    "provinces": "name formal_title info_description info_image info_wiki_url part_of population province_type".split(),
    "wiki": "settlement url title description image".split(),
}


def schema(flavour: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in HEADERS[flavour]])


def read_csv(spark: SparkSession, path: str, flavour: str) -> DataFrame:
    """All-string rows with ``_file`` and ``_ord`` (order within the file), header checked by name and order."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False)
    rows = reader.schema(schema(flavour)).csv(path)
    return rows.withColumn("_file", F.col("_metadata.file_name")).withColumn("_ord", F.monotonically_increasing_id())


def by_name(rows: DataFrame, name: str = "Settlement", province: str | None = None, province_col: str = "Province_2515") -> DataFrame:
    """Rows keyed by trimmed name, of repeated names the last; optionally of one province only."""
    keyed = rows.withColumn("name", F.trim(F.col(name)))
    if province:
        keyed = keyed.where(F.trim(F.col(province_col)) == province)
    return last_wins(keyed, ["name"], "_ord")


def header_errors(columns: list[str], flavour: str, n_rows: int) -> list[str]:
    """Why a file isn't one of its flavour; empty if it is."""
    want, out = HEADERS[flavour], []
    if columns != want:
        missing, extra = [c for c in want if c not in columns], [c for c in columns if c not in want]
        out.append(f"header differs: missing {missing}, unexpected {extra}" if missing or extra else "header in another order")
    if n_rows < 1:
        out.append("no data rows")
    return out


def read_snapshots(spark: SparkSession, path: str, flavour: str) -> DataFrame:
    """Rows of files ``<series>_<yyyyMMdd_HHmmss>.csv`` with ``series`` and ``taken``."""
    form = r"^(.*)_(\d{8}_\d{6})\.csv$"
    rows = read_csv(spark, path, flavour)
    return rows.withColumn("series", F.regexp_extract("_file", form, 1)).withColumn("taken", F.try_to_timestamp(F.regexp_extract("_file", form, 2), F.lit("yyyyMMdd_HHmmss")))


def snapshot_name(stem: str) -> Column:
    """File name of a snapshot taken now."""
    return F.concat(F.lit(stem + "_"), F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss"), F.lit(".csv"))


def unpivot_epochs(rows: DataFrame, epochs: tuple[int, ...] = (2515, 2512, 2276)) -> DataFrame:
    """One row per settlement and year with its province and ruler."""
    years = F.array(*[F.struct(F.lit(y).alias("year"), trimmed_or_null(F.col(f"Province_{y}")).alias("province"), trimmed_or_null(F.col(f"Ruler_{y}")).alias("ruler")) for y in epochs])
    return rows.select("Settlement", F.explode(years).alias("e")).select("Settlement", "e.*")


def positional_population(rows: DataFrame, name: int = 0, people: int = 1) -> DataFrame:
    """Names and whole-number populations of header-less rows (``cells`` array); short and other rows go."""
    value = safe_int(F.get("cells", F.lit(people)))
    return rows.where(F.size("cells") >= 2).select(F.trim(F.get("cells", F.lit(name))).alias("name"), value.alias("population")).where("population is not null")


def first_existing(paths: list[str]) -> str:
    """The first of several places that exists."""
    from pathlib import Path

    found = next((p for p in paths if Path(p).exists()), None)
    if found is None:
        raise FileNotFoundError(f"none of {paths}")
    return found
