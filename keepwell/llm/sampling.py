"""Held-out rows and bounded, repeatable samples for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.mixing import hash60


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return (F.crc32(doc_id.cast("string")) % 5).cast("int")


def thinned(rows: DataFrame, doc_id: str, most: int, salt: str) -> DataFrame:
    """All rows, or about ``most`` of them if there are more: those whose hash lies below a share.

    The number of rows stays within a few standard deviations, sqrt(most) each, of ``most`` at any
    size of the input; rows are chosen by id alone, so reruns agree.
    """
    n = rows.count()
    if n <= most:
        return rows
    return rows.filter(hash60(F.lit(salt), F.col(doc_id)) < int(most / n * (1 << 60)))
