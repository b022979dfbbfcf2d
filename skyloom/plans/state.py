"""Versioned snapshots of the catalogue's tables, and cutting of lineage between steps."""

from __future__ import annotations

import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from skyloom.plans.schemas import DDL, schema


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local one only where none is set."""
    context = spark.sparkContext
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not context._jsc.sc().getCheckpointDir().isDefined():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skyloom-state-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_all(*dfs: DataFrame) -> list[DataFrame]:
    """`cut` of tables that do not depend on each other, their jobs side by side."""
    if len(dfs) == 1:
        return [cut(dfs[0])]
    with ThreadPoolExecutor(max(1, len(dfs))) as pool:
        return list(pool.map(cut, dfs))


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schema(name))


class Snapshots:
    """One Parquet folder for each table and version under a root that all executors share.

    A version is written whole and then published by writing its marker last, so readers see a step entirely or not at all.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _marks(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [int(f.getPath().getName()) for f in fs.listStatus(path)] if fs.exists(path) else []

    def version(self) -> int:
        return max(self._marks(), default=0)

    def write(self, tables: dict[str, DataFrame]) -> int:
        v = self.version() + 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.root}/v{v}/{name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions/{v}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
        return v

    def read(self, name: str, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if not v:
            return empty(self.spark, name)
        reader = self.spark.read.schema(schema(name)) if name in DDL else self.spark.read
        return reader.parquet(f"{self.root}/v{v}/{name}")
