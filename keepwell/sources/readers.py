"""Scans: typed CSV, Parquet as frame or SQL view, JSON scenario config."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from keepwell.sources import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header is checked against the schema; a malformed row fails the job instead of becoming nulls."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """``columns`` reaches the Parquet reader, so only those are decoded."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A raw table by its name's ending: CSV text, else Parquet, which large histories are better kept in."""
    return read_csv(spark, path, schema) if path.endswith(".csv") else spark.read.schema(schema).parquet(path)


def parquet_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def read_scenario(spark: SparkSession, path: str) -> DataFrame:
    """The JSON scenario config as a one-row frame."""
    return spark.read.schema(schemas.SCENARIO).option("multiLine", True).json(path)
