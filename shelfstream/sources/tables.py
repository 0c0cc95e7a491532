"""Datasets by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_dataset(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_dataset_stream(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)
