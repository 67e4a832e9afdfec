import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.llm import toxicity


def dense_fit(positive, unlabelled, prior, steps):
    """Non-negative risk by dense matrices, one row a text, each formula as it is published."""
    k = positive.shape[1]
    p, u = (np.column_stack([x, np.ones(len(x))]) for x in (positive, unlabelled))
    theta, m, v = np.zeros((3, k + 1))
    theta[k] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-x @ theta)) for x in (p, u))
        left = prior * p.T @ (sp - 1) / len(p)
        clean = u.T @ su / len(u) - prior * p.T @ sp / len(p)
        risk = np.mean(np.log1p(np.exp(u @ theta))) - prior * np.mean(np.log1p(np.exp(p @ theta)))
        slope = left + clean if risk >= 0 else -clean
        slope[:k] += 1e-4 * theta[:k]
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        theta = theta - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta


@pytest.fixture(scope="module")
def matrices():
    rng = np.random.default_rng(4)
    positive = rng.random((40, 6)) < [0.8, 0.6, 0.5, 0.3, 0.1, 0.1]
    unlabelled = np.vstack([rng.random((380, 6)) < [0.02, 0.02, 0.05, 0.1, 0.1, 0.1], positive[:20]])
    return positive.astype(float), unlabelled.astype(float)


def lists(matrix):
    return [[int(c) for c in np.flatnonzero(row)] for row in matrix]


def patterns(spark, matrix):
    rows = spark.createDataFrame([(x,) for x in lists(matrix)], "hits array<int>")
    return rows.groupBy("hits").agg(F.count(F.lit(1)).alias("texts"))


def test_one_block_is_the_dense_fit(spark, matrices):
    positive, unlabelled = matrices
    blocks = toxicity._blocks(patterns(spark, unlabelled), len(unlabelled), 1000)
    weights, bias = toxicity.fit_blocks(blocks, toxicity.Hits(lists(positive), 6), 0.1)
    assert np.allclose(np.append(weights, bias), dense_fit(positive, unlabelled, 0.1, toxicity.STEPS), atol=1e-6)


def test_blocks_hold_every_text_once_and_average_to_the_same_verdicts(spark, matrices):
    positive, unlabelled = matrices[0], np.tile(matrices[1], (20, 1))
    blocks = toxicity._blocks(patterns(spark, unlabelled), len(unlabelled), 2000).cache()
    spread = blocks.select("block", F.explode("rows").alias("x")).select("block", "x.hits", "x.texts")
    assert spread.groupBy("hits").agg(F.sum("texts").alias("texts")).orderBy("hits").collect() == (
        patterns(spark, unlabelled).select("hits", F.col("texts").cast("double")).orderBy("hits").collect()
    )
    # The hot pattern, no hit at all, is in each of the blocks.
    assert blocks.count() == 4 and spread.filter("size(hits) = 0").count() == 4
    fits = [np.append(*toxicity.fit_blocks(blocks, toxicity.Hits(lists(positive), 6), 0.1)) for _ in range(2)]
    assert (fits[0] == fits[1]).all()
    whole = dense_fit(positive, unlabelled, 0.1, toxicity.STEPS)
    verdicts = [np.column_stack([unlabelled, np.ones(len(unlabelled))]) @ theta >= 0 for theta in (fits[0], whole)]
    assert (verdicts[0] == verdicts[1]).mean() > 0.97


def test_repeated_rows_nulls_long_texts_and_clashes(spark):
    rows = [(i, f"plain words number {i % 7}", None) for i in range(60)]
    rows += [(100 + i, "vile slur here " * (20000 if i == 0 else 1), "x") for i in range(20)]
    rows += [(None, "vile slur here", "x"), (200, None, None), (201, "", None), *rows[60:63]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, positive string")
    labels = spark.createDataFrame(
        [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(20)] + [(300, None), (None, 1)], "doc_id long, toxic int"
    )
    out = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == (r.doc_id is None or 100 <= r.doc_id < 200) for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    by_id = {}
    for r in out:
        assert by_id.setdefault(r.doc_id, r.score) == r.score


def test_empty_tables_and_nothing_to_tell_apart(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    elsewhere = labels.selectExpr("doc_id + 50 AS doc_id", "toxic")
    for table, known in (
        (docs.limit(0), labels.limit(0)), (docs, labels.limit(0)), (docs.limit(0), labels), (docs, labels), (docs, elsewhere)
    ):
        assert toxicity.score(table, toxicity.learn(table, known)).count() == table.count()
