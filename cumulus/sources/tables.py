"""Parquet table access for a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy accessor: ``Tables(spark, dir).orders`` -> DataFrame (scan only, no action).

    Scans are plain ``spark.read.parquet`` so Catalyst prunes columns and
    pushes filters into every one of them.
    """

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return os.path.join(self.data_dir, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def register_views(self) -> None:
        """Expose every table as a temp view for ``spark.sql``."""
        for name in TABLE_NAMES:
            if os.path.exists(self.path(name)):
                getattr(self, name).createOrReplaceTempView(name)
