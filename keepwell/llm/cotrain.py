"""Quality classifier by co-training: text content and page metadata teach each other.

Two logistic classifiers see different views of a document. In every round each of them labels the
unlabelled texts that it is surest of, and the other one learns from those. At the end each view is
calibrated on labelled rows that neither has learned from, and a third small classifier weighs the
calibrated views.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepwell.llm import kernels
from keepwell.llm.common import fresh, released, shipped
from keepwell.llm.sampling import fold, thinned

#: Labelled texts to learn from, and unlabelled ones to exchange labels on: about so many at most.
LABELLED, UNLABELLED = 20000, 10000
ROUNDS = 4
#: A pseudo-label needs at least this probability; in a round, at most this share of the pool gets one.
CONFIDENT, SHARE = 0.95, 0.2
THRESHOLD = 0.5
_LANGS, _SOURCES = 8, 32

_CLASS = np.zeros(256, np.int64)  # 0: other characters of ASCII
for _k, _bytes in enumerate(
    (range(97, 123), range(65, 91), range(48, 58), range(128, 256), b" \t\n\x0b\x0c\r", b".,;:!?'\"()-", b"#*$%&|<>"), 1
):
    _CLASS[list(_bytes)] = _k
_CLASSES = 8


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The content view: what a text is written with."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(owner * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
    size = np.maximum(np.diff(offsets), 1)[:, None]
    starts, ends, at = kernels.word_bounds(data, offsets)
    letters = kernels.RollingHash(31)
    hashes = letters.runs(letters.prefix(letters.byte_values[data]), starts, ends)
    words = np.diff(at)
    chars = np.bincount(np.repeat(np.arange(n), words), ends - starts, n)
    distinct, repeated = np.zeros(n), np.zeros(n)
    pair = kernels.RollingHash(32)
    sums = pair.prefix(hashes)
    for i in range(n):
        lo, hi = at[i], at[i + 1]
        if hi - lo:
            distinct[i] = len(np.unique(hashes[lo:hi])) / (hi - lo)
        if hi - lo >= 5:
            first = np.arange(lo, hi - 4)
            repeated[i] = 1 - len(np.unique(pair.runs(sums, first, first + 5))) / len(first)
    shares = counts / size
    mean = chars / np.maximum(words, 1)
    return np.column_stack([shares, np.sqrt(shares), np.log1p(words), np.log1p(mean), distinct, repeated])


def page_features(data: np.ndarray, offsets: np.ndarray, langs: list, sources: list) -> np.ndarray:
    """The metadata view: where a page is from, how long it is and how it is laid out; not its words."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    lines = np.bincount(owner[data == 10], minlength=n) + 1
    size = np.diff(offsets)
    hot = np.zeros((n, _LANGS + _SOURCES))
    for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
        hot[i, zlib.crc32(str(lang or "").encode()) % _LANGS] = 1
        hot[i, _LANGS + zlib.crc32(str(source or "").encode()) % _SOURCES] = 1
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_ends = np.append(line_starts[1:], len(data))
    longest = np.zeros(n)
    if len(line_starts) and len(data):
        where = np.minimum(np.searchsorted(offsets, line_starts, "right") - 1, n - 1)
        np.maximum.at(longest, where, line_ends - line_starts)
    return np.column_stack([hot, np.log1p(size), np.log1p(lines), np.log1p(size / lines), np.log1p(longest)])


def views(batch: pa.RecordBatch, text: int, lang: int, source: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, content view, metadata view) of the slices of a batch."""
    for row, data, offsets in kernels.text_slices(batch.column(text)):
        n = len(offsets) - 1
        meta = [batch.column(c).slice(row, n).to_pylist() for c in (lang, source)]
        yield row, text_features(data, offsets), page_features(data, offsets, *meta)


@dataclass
class Logistic:
    """Logistic regression on standardised columns, fitted by damped Newton steps."""

    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.ones(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 12) -> Logistic:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = 1.0
        z = self._columns(x)
        self.weights = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], l2)
        ridge[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))
            slope = z.T @ (p - y) + ridge * self.weights
            curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curve, slope)
            self.weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        return self

    def _columns(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([z, np.ones(len(x))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._columns(x) @ self.weights, -30, 30)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


@dataclass
class Model:
    """Both views, their calibrations and the weights that join them; ``only`` if there was nothing to learn."""

    text: Logistic | None = None
    page: Logistic | None = None
    calibrations: tuple[Logistic, Logistic] | None = None
    joined: Logistic | None = None
    only: float = 1.0

    def predict(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.joined is None:
            constant = np.full(len(text), self.only)
            return constant, constant, constant
        logits = [c.logit(v.logit(x)[:, None]) for c, v, x in zip(self.calibrations, (self.text, self.page), (text, page), strict=True)]
        score = self.joined.probability(np.column_stack(logits))
        return tuple(1 / (1 + np.exp(-z)) for z in logits) + (score,)


def cotrain(
    labelled: tuple[np.ndarray, np.ndarray],
    y: np.ndarray,
    pool: tuple[np.ndarray, np.ndarray],
    aside: np.ndarray,
    rounds: int = ROUNDS,
) -> Model:
    """Fit both views. ``aside`` marks the labelled rows that are kept for calibration."""
    if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        return Model(only=float(y.mean()) if len(y) else 1.0)
    own = [x[~aside] for x in labelled]
    taught: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, int), np.zeros(0))] * 2
    models = [Logistic(), Logistic()]
    for _ in range(rounds + 1):
        for v in (0, 1):
            rows, pseudo = taught[v]
            models[v].fit(np.vstack([own[v], pool[v][rows]]), np.concatenate([y[~aside], pseudo]))
        if not len(pool[0]):
            break
        for v in (0, 1):
            p = models[v].probability(pool[v])
            sure = np.maximum(p, 1 - p)
            # The surest texts of each class, in the classes' own shares.
            chosen = []
            for good in (0, 1):
                rows = np.flatnonzero(((p >= 0.5) == good) & (sure >= CONFIDENT))
                most = int(np.ceil(SHARE * len(p) * np.mean(y[~aside] == good)))
                chosen.append(rows[np.argsort(-sure[rows], kind="stable")][:most])
            rows = np.concatenate(chosen)
            taught[1 - v] = (rows, (p[rows] >= 0.5).astype(float))
    held = [x[aside] for x in labelled]
    calibrations = tuple(Logistic().fit(m.logit(x)[:, None], y[aside]) for m, x in zip(models, held, strict=True))
    logits = np.column_stack([c.logit(m.logit(x)[:, None]) for c, m, x in zip(calibrations, models, held, strict=True)])
    return Model(models[0], models[1], calibrations, Logistic().fit(logits, y[aside]))


def _view_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, text, page in views(batch, 0, 1, 2):
            part = batch.slice(row, len(text))
            yield pa.RecordBatch.from_arrays(
                [part.column(3), part.column(4), pa.array(list(text)), pa.array(list(page))],
                names=["doc", "label", "text_view", "page_view"],
            )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    labelled: int = LABELLED,
    unlabelled: int = UNLABELLED,
    rounds: int = ROUNDS,
) -> Model:
    """Fit on rows outside fold 0; of the labelled ones, fold 1 is for calibration alone.

    About ``labelled`` and ``unlabelled`` rows at most come to the driver, as some sixty numbers each.
    """
    usable = labels.filter(fold(F.col("doc_id")) != 0).filter(F.col(label).isin(0, 1))
    known = usable.select(F.col("doc_id").alias("doc"), F.col(label).cast("int").alias("label")).dropDuplicates(["doc"])
    body = docs.filter(fold(F.col("doc_id")) != 0).select(
        F.coalesce("text", F.lit("")).alias("text"), F.col("lang").cast("string"), F.col("source").cast("string"),
        F.col("doc_id").alias("doc"),
    )
    chosen = thinned(known, "doc", labelled, "quality")  # at most about LABELLED rows
    sample = body.join(F.broadcast(chosen), "doc").select("text", "lang", "source", "doc", "label")
    pool = thinned(body, "doc", unlabelled, "pool").select("text", "lang", "source", "doc", F.lit(-1).alias("label"))
    rows = (
        sample.unionByName(pool)
        .mapInArrow(_view_rows, "doc long, label int, text_view array<double>, page_view array<double>")
        .toArrow()
        .sort_by([("label", "ascending"), ("doc", "ascending")])
    )
    released(docs.sparkSession)

    def matrix(column: str) -> np.ndarray:
        values = rows.column(column).combine_chunks()
        flat = values.flatten().to_numpy() if len(rows) else np.zeros(0)
        return flat.reshape(len(rows), -1) if len(rows) else flat.reshape(0, 1)

    y, text, page = rows.column("label").to_numpy(), matrix("text_view"), matrix("page_view")
    if not (y >= 0).any():
        return Model()
    aside = np.array([zlib.crc32(str(d).encode()) % 5 == 1 for d in rows.column("doc").to_pylist()], bool)
    mine, other = y >= 0, y < 0
    return cotrain((text[mine], page[mine]), y[mine], (text[other], page[other]), aside[mine], rounds)


def _scored(model: Model, columns: list[str], at: tuple[int, int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, page in views(batch, *at):
                p_text, p_page, score = model.predict(text, page)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(row, len(text)).columns,
                        pa.array(p_text),
                        pa.array(p_page),
                        pa.array(score),
                    ],
                    names=columns,
                )

    return run


def with_quality(docs: DataFrame, model: Model) -> tuple[DataFrame, tuple[str, str, str]]:
    """``docs`` with three more columns and their names: probability by text, by page, and by both.

    Every whole text is scored in one pass without a shuffle; all columns and rows stay. Null and
    empty texts have the views of no characters, null languages and sources count as empty. Where
    there was nothing to learn (no labels, or of one class) every row has the same score, the share
    of good labels, or 1.
    """
    names = tuple(fresh(n, docs.columns) for n in ("p_text", "p_page", "quality_score"))
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    at = tuple(docs.columns.index(c) for c in ("text", "lang", "source"))
    return docs.mapInArrow(_scored(model, schema.names, at), schema), names


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, p_text, p_page, quality_score, predicted.

    predicted is 1 if quality_score >= ``threshold``; held_out marks fold 0, whose labels are not used.
    """
    narrow = docs.select("doc_id", "text", "lang", "source")
    scored, (p_text, p_page, score) = with_quality(narrow, learn(narrow, labels))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col(p_text).alias("p_text"),
        F.col(p_page).alias("p_page"),
        F.col(score).alias("quality_score"),
        (F.col(score) >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    scored, (_, _, score) = with_quality(docs, learn(docs, labels))
    return scored.filter(F.col(score) >= threshold).select(*docs.columns)


shipped(__name__)
