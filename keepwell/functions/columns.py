"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_date(col: str | Column) -> Column:
    """``yyyymmdd`` integer to DATE; anything that is not an eight-digit calendar day becomes null.

    Taken apart by arithmetic: formatting and parsing text would cost several times as much on
    every transaction.
    """
    col = F.col(col) if isinstance(col, str) else col
    zero = F.lit(0)
    day = F.try_make_timestamp_ntz(
        F.floor(col / 10000).cast("int"), F.floor(col / 100).cast("int") % 100, col % 100, zero, zero, zero
    )
    return F.when(col.between(10000101, 99991231), day.cast("date"))


def as_text_or(col: str, default: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(default))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null, not an error, unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def bands(col: str, steps: Sequence[tuple[int, str]], beyond: str, missing: Column, missing_label: str) -> Column:
    """First matching upper bound wins; ``missing`` is tested before all of them."""
    banded = F.when(missing, F.lit(missing_label))
    for upper, label in steps:
        banded = banded.when(F.col(col) <= upper, F.lit(label))
    return banded.otherwise(F.lit(beyond))


def relabel(col: str | Column, names: dict[str, str]) -> Column:
    """Map known codes to friendly names and pass the others through."""
    col = F.col(col) if isinstance(col, str) else col
    lookup = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, col), col)


def target_count(total: Column, percent: Column) -> Column:
    """Customers in the top ``percent`` of ``total``, rounded up."""
    return F.ceil(total * percent / F.lit(100.0)).cast("bigint")


def required(df: DataFrame, name: str) -> Column:
    """The column ``name``; a job that meets a null in it fails."""
    missing = F.raise_error(F.lit(f"{name} is null."))
    return F.coalesce(F.col(name), missing.cast(df.schema[name].dataType)).alias(name)
