"""Layers: named groups of tables, kept as parquet folders or as a catalog database."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Layer(Protocol):
    """A place for tables: replace, append to and read them by name."""

    def replace(self, table: str, df: DataFrame) -> None: ...

    def append(self, table: str, df: DataFrame) -> None: ...

    def read(self, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class FolderLayer:
    """One parquet folder per table below ``root``."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def replace(self, table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(table))

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)


@dataclass(frozen=True)
class DatabaseLayer:
    """One catalog database; ``create`` and ``drop`` touch this database only."""

    spark: SparkSession
    name: str

    def create(self) -> DatabaseLayer:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.name}`")
        return self

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.name}` CASCADE")

    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(self.name)

    def replace(self, table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").format("parquet").saveAsTable(f"`{self.name}`.`{table}`")

    def replace_bucketed(self, table: str, df: DataFrame, column: str, buckets: int) -> None:
        """Store a table by hash of a join key. Tables bucketed alike by the same key
        (orders and order items by order) then join without a shuffle, every time.

        Rows are put in their bucket's task first, so each bucket is one file."""
        placed = df.repartition(buckets, column)
        placed.write.mode("overwrite").format("parquet").bucketBy(buckets, column).sortBy(column).saveAsTable(
            f"`{self.name}`.`{table}`"
        )

    def append(self, table: str, df: DataFrame) -> None:
        df.write.mode("append").format("parquet").saveAsTable(f"`{self.name}`.`{table}`")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.name}`.`{table}`")


def drop_derived(layers: list[DatabaseLayer]) -> None:
    """Drop derived layers with all their tables, before the raw layer is reloaded."""
    for layer in layers:
        layer.drop()
