import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from keepwell.functions.columns import compact_date, ratio, relabel, target_count
from keepwell.functions.hashing import hash_bucket


@pytest.mark.parametrize(
    "raw", [0, 20170229, 99999999, 2017131, 2010101, 201701311, 20171301, 20170100, -20170131, None]
)
def test_not_a_calendar_day_is_null(spark, raw):
    row = spark.createDataFrame([(raw,)], "d int").select(compact_date("d").alias("d")).first()
    assert row["d"] is None


def test_valid_compact_dates(spark):
    days = [dt.date(1999, 12, 31), dt.date(2016, 2, 29), dt.date(2017, 1, 1)]
    rows = spark.createDataFrame([(int(d.strftime("%Y%m%d")),) for d in days], "d int")
    assert [r["d"] for r in rows.select(compact_date("d").alias("d")).collect()] == days


def test_every_day_of_a_leap_year_equals_text_parsing(spark):
    days = spark.range(20160000, 20161400).select(F.col("id").cast("int").alias("d"))
    parsed = days.select(compact_date("d").alias("a"), F.try_to_date(F.col("d").cast("string"), "yyyyMMdd").alias("b"))
    assert parsed.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    assert parsed.filter("a IS NOT NULL").count() == 366


def test_ratio_is_null_without_a_positive_denominator(spark):
    rows = spark.createDataFrame([(1, 2), (1, 0), (1, -1), (1, None)], "a int, b int")
    assert [r["x"] for r in rows.select(ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [0.5, None, None, None]


def test_relabel_passes_unknown_codes_through(spark):
    rows = spark.createDataFrame([("0",), ("x",), (None,)], "c string")
    assert [r["x"] for r in rows.select(relabel("c", {"0": "off"}).alias("x")).collect()] == ["off", "x", None]


def test_target_count_rounds_up_like_the_float_formula(spark):
    rows = spark.range(1, 3000).select("id", F.explode(F.array(*map(F.lit, [1.0, 2.0, 5.0, 10.0, 15.0, 30.0]))).alias("p"))
    for row in rows.withColumn("k", target_count(F.col("id"), F.col("p"))).collect():
        assert row["k"] == math.ceil(row["id"] * row["p"] / 100)


def test_hash_bucket_spreads_evenly(spark):
    share = spark.range(20_000).select((hash_bucket("s|", "id") < 2000).cast("int").alias("t")).agg(F.avg("t")).first()[0]
    assert 0.19 < share < 0.21
