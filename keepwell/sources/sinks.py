"""Sinks: Parquet, versioned tables, small CSV and JSON results, table report."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_POINTERS = "_published"
_VERSION = re.compile(r"v\d{12}-[0-9a-f]{32}")


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Overwrite ``path`` (parent folders are made) and return the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file with header, for report tables of a few rows only."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per partition, for tables of any size."""
    df.write.mode("overwrite").option("header", True).csv(path)


def record_json(record: Column) -> Column:
    """A struct as one JSON document."""
    return F.to_json(record)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def _folder(spark: SparkSession, path: str):
    """The file system of ``path`` and a function that makes its path objects."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _names(fs, folder) -> list[str]:
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def published(spark: SparkSession, path: str) -> DataFrame:
    """The table that was published last under ``path``; a plain Parquet table where none was."""
    fs, make = _folder(spark, path)
    pointers = _names(fs, make(f"{path}/{_POINTERS}"))
    return spark.read.parquet(f"{path}/{pointers[-1]}" if pointers else path)


def publish(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame, dict], None] | None = None,
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Write ``df`` as the next version of the table under ``path``, check it, and only then let readers see it.

    Each version is a folder of its own, and an empty file of its name in ``_published`` points to it. Making
    that file is the last step and a single one on any store, so whoever stops before leaves the version before
    in place; nothing is renamed or overwritten. ``df`` may read the version before.

    ``measures`` are aggregates that Spark observes in the rows as they are written, so that they cost no pass;
    ``check`` gets the written table and their values, and refuses the version by raising. The two newest
    versions stay, so that a reader that has resolved the one before can finish. One writer a table at a time.
    """
    spark = df.sparkSession
    fs, make = _folder(spark, path)
    before = _names(fs, make(f"{path}/{_POINTERS}"))
    name = f"v{int(before[-1][1:13]) + 1 if before else 1:012d}-{uuid.uuid4().hex}"
    # The version's own schema: the columns' comments and metadata as they were.
    schema, version, seen = df.schema, f"{path}/{name}", Observation()
    if measures:
        df = df.observe(seen, *[column.alias(key) for key, column in measures.items()])
    df.write.parquet(version)
    written = spark.read.schema(schema).parquet(version)
    try:
        if check:
            check(written, seen.get if measures else {})
    except Exception:
        fs.delete(make(version), True)
        raise
    fs.create(make(f"{path}/{_POINTERS}/{name}"), False).close()
    oldest = before[-1] if before else name
    for old in before[:-1]:
        fs.delete(make(f"{path}/{_POINTERS}/{old}"), False)
    # With what writers that were stopped have left.
    for old in [n for n in _names(fs, make(path)) if _VERSION.fullmatch(n) and n < oldest]:
        fs.delete(make(f"{path}/{old}"), True)
    return written


def rewrite_parquet(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Publish ``change(table)`` as the next version of the table under ``path``."""
    return publish(change(published(spark, path)), path)


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row count."""
    columns = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("column_type"),
            )
            for position, field in enumerate(df.schema.fields, start=1)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(columns), "row_count")
