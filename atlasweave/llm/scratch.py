"""Tables that cut lineage, written below the folder of ``spark.checkpoint.dir``.

A written Parquet table survives the loss of any executor, is read column by
column, and unlike ``checkpoint()`` is computed once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where none is set (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="atlasweave-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as no column has it, letters of either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


class Scratch:
    """Intermediate tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; the result carries its path for ``drop``."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing lazy reads any more."""
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            fs.delete(path, True)
