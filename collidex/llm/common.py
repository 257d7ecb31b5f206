"""Helpers shared by the corpus operators: shared intermediate tables and id lists."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.session import scratch_path

#: Largest number of 8-byte ids that is broadcast (about 32 MB with overhead); larger lists are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def _path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str, *parts: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder, by the columns ``parts``, and read it back.

    Cuts the lineage: a lost executor costs a re-read of the table, not a recomputation.
    """
    path = _path(df.sparkSession, name)
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Parts:
    """A table written part by part, of one schema, under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path, self.schema, self.n = spark, _path(spark, name), None, 0

    def add(self, df: DataFrame) -> DataFrame:
        """Write one part now and read it back."""
        path = f"{self.path}/_part={self.n}"
        df.write.parquet(path)
        self.schema, self.n = df.schema, self.n + 1
        return self.spark.read.schema(df.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).drop("_part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bounded(ids: DataFrame) -> DataFrame:
    ids = saved(ids.distinct(), "ids")
    return F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the one-column table ``ids``; its size is counted before it is broadcast."""
    return df.join(_bounded(ids), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids`` (rows with a null key stay)."""
    return df.join(_bounded(ids), key, "left_anti")
