import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepwell.operators import encoding
from keepwell.operators.model_input import CATEGORIES


def statistics(frame, features):
    counted = encoding.value_counts(frame, features)
    medians = encoding.numeric_medians(counted)
    moments = encoding.numeric_moments(counted, medians)
    return {r["feature"]: r for r in medians.join(moments, "feature").collect()}


def test_medians_are_exact_and_average_the_middle_two(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 50, 501).astype(float)
    b = [None if i % 3 == 0 else float(i % 7) for i in range(501)]
    rows = list(zip(a.tolist(), b, [None] * 501))
    found = statistics(spark.createDataFrame(rows, "a double, b double, c double").repartition(5), ["a", "b", "c"])
    assert found["a"]["median"] == np.median(a)
    assert found["b"]["median"] == np.median([x for x in b if x is not None])
    assert (found["a"]["missing"], found["b"]["missing"], found["c"]["missing"]) == (0, 167, 501)
    assert {r["rows"] for r in found.values()} == {501}
    assert found["c"]["median"] is None
    assert found["a"]["mean"] == pytest.approx(a.mean())
    assert found["a"]["deviation"] == pytest.approx(a.std())
    filled = np.array([found["b"]["median"] if x is None else x for x in b])
    assert found["b"]["deviation"] == pytest.approx(filled.std())
    even = spark.createDataFrame([(x,) for x in (4.0, 1.0, 3.0, 2.0)], "a double")
    assert statistics(even, ["a"])["a"]["median"] == 2.5


def test_impute_and_scale(spark):
    train = spark.createDataFrame([(1.0, 5.0, None, 1), (3.0, 5.0, None, 2), (None, 5.0, None, 3)], "a double, b double, c double, k int")
    learned = encoding.learn_numeric(train, ["a", "b", "c"], scale=True)
    assert learned.medians == {"a": 2.0, "b": 5.0}
    assert learned.indicators == ["a"]
    fresh = spark.createDataFrame([(None, 6.0, 9.0, 4)], train.schema)
    imputed = learned.impute(fresh)
    assert "c" not in imputed.columns
    row = learned.scale(imputed).first()
    assert row["a"] == 0.0  # the mean
    assert row["b"] == 1.0  # a constant is only centred
    assert row["missingindicator_a"] == pytest.approx((1 - 1 / 3) / np.std([0, 0, 1]))


def categories(spark, values):
    return spark.createDataFrame([(i, *[v] * 5) for i, v in enumerate(values)], ["msno", *CATEGORIES])


def test_unseen_levels(spark):
    train = categories(spark, ["10", "9", "unknown", "9"])
    fresh = categories(spark, ["9", "new", "10"])
    levels = encoding.ordinal_levels(train)
    assert {(r["level"], r["code"]) for r in levels.collect()} == {("10", 0), ("9", 1), ("unknown", 2)}
    codes = encoding.ordinal_encode(fresh, levels).orderBy("msno").select("city_category_code").collect()
    assert [r[0] for r in codes] == [1, -1, 0]
    hot = encoding.learn_one_hot(train).transform(encoding.with_known_categories(fresh)).orderBy("msno")
    vectors = [r[0] for r in hot.select(vector_to_array("city_category_onehot")).collect()]
    assert vectors == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0], [1.0, 0.0, 0.0]]


def test_null_category_is_unknown(spark):
    train = categories(spark, ["1", "2"]).withColumn("city_category", F.lit(None).cast("string"))
    assert ("city_category", "unknown") in {
        (r["category"], r["level"]) for r in encoding.ordinal_levels(train).collect()
    }
