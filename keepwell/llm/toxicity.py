"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other training texts are unlabelled, a share of them
toxic as well. The risk of a linear classifier is estimated with the class prior: unlabelled texts
count as clean, and the prior's share of the positives is taken off again. That difference estimates
a risk and so cannot be below zero; where a step would push it there, the classifier has begun to
overfit the positives, and the step goes the other way.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import shipped, staged
from keepwell.llm.sampling import fold, thinned

#: Confirmed toxic texts to learn from: about so many at most.
POSITIVES = 4000
#: Unlabelled texts of a block that is fitted in one task; Adam steps in all, and between two averages of the blocks.
BLOCK, STEPS, STRIDE = 8192, 300, 20
#: Word features at most, and how many standard errors a word must stand out among the positives.
FEATURES, STANDS_OUT = 4096, 4.0
_WORDS = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5)


def tokens(text: str) -> set[str]:
    """A text's lower-cased words, and the beginnings of longer words, marked by a dash."""
    words = set(_WORDS.findall(text.lower()))
    out = set(words)
    for n in _PREFIXES:
        out.update([w[:n] + "-" for w in words if len(w) > n])
    return out


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        hits = self.vocabulary.keys() & tokens(text)
        z = self.bias + float(sum(self.weights[self.vocabulary[t]] for t in sorted(hits)))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


class Hits:
    """A 0/1 matrix, rows by features, as the list of its ones; a row may stand for a number of texts."""

    def __init__(self, lists: list[list[int]], features: int, counts: np.ndarray | None = None):
        self.n, self.features = len(lists), features
        self.rows = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.columns = np.fromiter((c for x in lists for c in x), np.int64, len(self.rows))
        self.counts = np.ones(self.n) if counts is None else counts
        self.texts = self.counts.sum()

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.n)

    def mean(self, values: np.ndarray) -> float:
        return float(values @ self.counts / self.texts)

    def mean_slope(self, d: np.ndarray) -> np.ndarray:
        """The mean gradient of weights and bias, for slopes ``d`` of the rows' scores."""
        d = d * self.counts
        return np.append(np.bincount(self.columns, d[self.rows], self.features), d.sum()) / self.texts


def start(features: int, prior: float) -> np.ndarray:
    """Weights and bias, and both moments of Adam, before the first step."""
    state = np.zeros((3, features + 1))
    state[0, features] = np.log(prior / (1 - prior))
    return state


def nnpu_steps(
    positive: Hits, unlabelled: Hits, prior: float, state: np.ndarray, first: int, last: int, rate: float = 0.1, l2: float = 1e-4
) -> np.ndarray:
    """The state after the full-batch Adam steps ``first`` to ``last`` on the non-negative risk with logistic loss."""
    k = positive.features
    theta, m, v = state.copy()
    for step in range(first, last + 1):
        zp, zu = positive.times(theta[:k]) + theta[k], unlabelled.times(theta[:k]) + theta[k]
        as_positive = prior * positive.mean_slope(_sigmoid(zp) - 1)
        negative_risk = unlabelled.mean(np.logaddexp(0, zu)) - prior * positive.mean(np.logaddexp(0, zp))
        negative = unlabelled.mean_slope(_sigmoid(zu)) - prior * positive.mean_slope(_sigmoid(zp))
        slope = as_positive + negative if negative_risk >= 0 else -negative
        slope[:k] += l2 * theta[:k]
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return np.stack([theta, m, v])


def _block_steps(positive: Hits, prior: float, state: np.ndarray, first: int, last: int):
    """Per block (hits, texts): its state after the steps, as rows (place, value, texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0).to_pylist():
                counts = np.array([x["texts"] for x in row])
                own = Hits([x["hits"] for x in row], positive.features, counts)
                after = nnpu_steps(positive, own, prior, state, first, last).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(after))), pa.array(after), pa.array(np.full(len(after), own.texts))],
                    names=["place", "value", "texts"],
                )

    return run


def fit_blocks(blocks: DataFrame, positive: Hits, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias from all ``blocks`` (rows: array of (hits, texts)) of unlabelled texts.

    Every block takes ``STRIDE`` steps from the common state, with all positives; then the blocks' states
    are averaged, by their numbers of texts, in exact decimals. One block takes the steps of a fit in memory.
    """
    state = start(positive.features, prior)
    for first in range(1, STEPS + 1, STRIDE):
        last = min(first + STRIDE - 1, STEPS)
        moved = blocks.select("rows").mapInArrow(
            _block_steps(positive, prior, state, first, last), "place long, value double, texts double"
        )
        # A row for each number of the state, which FEATURES bounds.
        sums = moved.groupBy("place").agg(
            F.sum((F.col("value") * F.col("texts")).cast("decimal(38,16)")).cast("double").alias("value"),
            F.sum(F.col("texts").cast("decimal(30,8)")).cast("double").alias("texts"),
        )
        means = sums.toArrow().sort_by("place")
        state = (means["value"].to_numpy() / means["texts"].to_numpy()).reshape(state.shape)
    return state[0, :-1], float(state[0, -1])


def _token_counts(wanted: set[str] | None):
    """(token, texts): in how many texts of a batch each token is, of ``wanted`` ones only if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                counts: Counter[str] = Counter()
                for text in batch.column(0).slice(at, 512).to_pylist():
                    found = tokens(text or "")
                    counts.update(found if wanted is None else found & wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["token", "texts"],
                )

    return run


def _pattern_counts(vocabulary: dict[str, int]):
    """(hits, texts): the features that texts have, and how many texts of a batch have just these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(
                tuple(sorted(vocabulary[t] for t in vocabulary.keys() & tokens(x or ""))) for x in batch.column(0).to_pylist()
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(x) for x in counts], pa.list_(pa.int32())), pa.array(list(counts.values()), pa.int64())],
                names=["hits", "texts"],
            )

    return run


def _patterns(bodies: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    found = bodies.select("text").mapInArrow(_pattern_counts(vocabulary), "hits array<int>, texts long")
    return found.groupBy("hits").agg(F.sum("texts").alias("texts"))


def _blocks(patterns: DataFrame, texts: int, block: int) -> DataFrame:
    """(block, rows): all patterns, in blocks of about ``block`` texts that are alike.

    A pattern of many texts is spread over the blocks, so that no block is made of one hot pattern.
    """
    n = max(1, -(-texts // block))
    copies = F.least("texts", F.lit(n))
    placed = patterns.select(
        "hits", (F.col("texts") / copies).alias("texts"), F.explode(F.sequence(F.lit(0), (copies - 1).cast("int"))).alias("copy")
    )
    one = F.struct("hits", "texts")
    key = F.pmod(F.xxhash64("hits") + F.col("copy"), F.lit(n)).alias("block")
    return placed.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("rows"))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    positives: int = POSITIVES,
    block: int = BLOCK,
) -> Model:
    """Fit on rows outside fold 0; only ``label`` of those rows and the texts are looked at.

    All texts outside fold 0 are unlabelled ones, whole and each as often as it is there; of the confirmed toxic
    ones about ``positives`` are taken. The features are the words that stand out among these against all
    texts, ``FEATURES`` at most, which is the size of the model. The class prior is the toxic share of the
    labelled training rows. Without a toxic one among them the classifier has no features and scores every text
    a little above 0.
    """
    known = labels.filter(fold(F.col(doc_id)) != 0).select(F.col(doc_id).alias("doc"), F.col(label).alias("label"))
    counts = known.filter("label IS NOT NULL").agg(F.count("*"), F.count_if(F.col("label") == 1)).first()
    if not counts[1]:
        return Model({}, np.zeros(0), -5.0)
    prior = min(max(counts[1] / counts[0], 0.01), 0.5)
    # At most about POSITIVES ids.
    chosen = thinned(known.filter("label = 1").select("doc").distinct(), "doc", positives, "toxic")
    bodies = docs.filter(fold(F.col(doc_id)) != 0).select(F.col(doc_id).alias("doc"), F.coalesce(text, F.lit("")).alias("text"))
    toxic = staged(bodies.join(F.broadcast(chosen), "doc").select("text"), "toxic-sample")
    n_toxic, n_texts = toxic.count(), bodies.count()
    if not n_toxic:
        return Model({}, np.zeros(0), -5.0)
    counted = "token string, texts long"
    often = toxic.mapInArrow(_token_counts(None), counted).groupBy("token").agg(F.sum("texts").alias("p")).filter("p >= 2")
    often = staged(often, "toxic-words")
    # Words of at least two of a bounded number of texts.
    wanted = {r["token"] for r in often.select("token").collect()}
    share = F.col("p") / n_toxic
    pooled = (F.col("p") + F.col("u") + 1) / (n_toxic + n_texts + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / n_toxic + 1 / n_texts))
    stand = (
        bodies.select("text")
        .mapInArrow(_token_counts(wanted), counted)
        .groupBy("token")
        .agg(F.sum("texts").alias("u"))
        .join(often, "token")
        .withColumn("z", (share - F.col("u") / n_texts) / error)
        .filter(F.col("z") >= STANDS_OUT)
        .orderBy(F.desc("z"), "token")
        .limit(FEATURES)
    )
    vocabulary = {r["token"]: i for i, r in enumerate(stand.select("token").collect())}
    rows = sorted((r["hits"], r["texts"]) for r in _patterns(toxic, vocabulary).collect())
    positive = Hits([r[0] for r in rows], len(vocabulary), np.array([r[1] for r in rows], float))
    blocks = staged(_blocks(staged(_patterns(bodies, vocabulary), "patterns"), n_texts, block), "blocks")
    return Model(vocabulary, *fit_blocks(blocks, positive, prior))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc", "score"])

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    score is in (0, 1) and depends on the whole text alone; null and empty texts have the score of no
    words. Repeated rows give repeated results, an empty table none; a null id is not held out. Other
    columns are not read.
    """
    scored = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).mapInArrow(
        _scored(model), "doc long, score double"
    )
    return scored.select(
        F.col("doc").alias(doc_id),
        F.coalesce(fold(F.col("doc")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


shipped(__name__)
