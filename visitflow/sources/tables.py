"""Parquet table access for one data directory."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of ``data_dir`` as a DataFrame (lazy; columns pruned by Catalyst), listed anew at each call."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazily opened input tables of one data directory."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.data_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")
