"""Substring dedup by level-wise doubling: repeated half-windows alone are extended to whole windows.

A window is ``words`` consecutive words. The first level looks at runs of half that length, and not
at all of them: of the half-runs inside a window the one with the smallest hash is its anchor, the
leftmost of equal ones. Equal windows have equal anchors at equal places, so nothing is lost, and a
text has about one anchor for every thirteen words. An anchor stands for the stretch of neighbouring
windows that share it. Anchors whose half-run occurs in one document only are dropped at once.

The others are doubled to the windows around them, in two steps. A whole stretch that also occurs in
a smaller document is covered without looking at its windows one by one: inside long repeats that is
nearly everything. Single windows are hashed (128 bits) only where one half-run is found with
different surroundings, at the ends of repeats, and there only for the smallest document of each
surrounding, since its windows stand for those of its copies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm import kernels
from keepwell.llm.common import shipped, staged

WINDOW = 50

_ANCHORS = "h long, c long, doc long, fp long, anchor int, first int, last int"


def _anchors(starts, ends, sums, rolling, words: int):
    """For one text: anchor, first and last window of each stretch, as word positions."""
    n = len(starts)
    half = (words + 1) // 2
    if n < words:
        return None
    at = np.arange(n)
    runs = rolling.runs(sums, at[: n - half + 1], at[: n - half + 1] + half)
    # Leftmost smallest run among the words - half + 1 runs of each window, by doubling.
    reach, span = words - half + 1, 1
    best = np.arange(len(runs))
    while span < reach:
        step = min(span, reach - span)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(runs[right] < runs[left], right, left)
        span += step
    cut = np.flatnonzero(best[1:] != best[:-1]) + 1
    first = np.concatenate(([0], cut))
    last = np.concatenate((cut, [len(best)])) - 1
    return runs, best[first], first, last


def _find_anchors(words: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, rolling = kernels.RollingHash(71), kernels.RollingHash(72)
        around = kernels.RollingHash(73)
        for batch in batches:
            docs, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            for row, data, offsets in kernels.text_slices(batch.column(1)):
                starts, ends, at = kernels.word_bounds(data, offsets)
                hashes = letters.runs(letters.prefix(letters.byte_values[data]), starts, ends)
                out = []
                for i in range(len(offsets) - 1):
                    lo, hi = at[i], at[i + 1]
                    if hi - lo < words:
                        continue
                    sums = rolling.prefix(hashes[lo:hi])
                    runs, anchor, first, last = _anchors(starts[lo:hi], ends[lo:hi], sums, rolling, words)
                    wide = around.prefix(kernels.mixed(hashes[lo:hi]))
                    # The stretch with the anchor's place in it.
                    c = kernels.mixed(around.runs(wide, first, last + words) + (anchor - first).astype(np.uint64))
                    k = len(anchor)
                    out.append(
                        (
                            runs[anchor].view(np.int64),
                            c.view(np.int64),
                            np.full(k, docs[row + i]),
                            np.full(k, prints[row + i]),
                            anchor.astype(np.int32),
                            first.astype(np.int32),
                            last.astype(np.int32),
                        )
                    )
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
                        names=[x.split()[0] for x in _ANCHORS.split(", ")],
                    )

    return find


def _find_windows(words: int):
    """Hashes of the single windows of the stretches that ``spans`` lists (first, last by turns)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, one, two = kernels.RollingHash(81), kernels.RollingHash(82), kernels.RollingHash(83)
        for batch in batches:
            docs, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            spans = batch.column(3)
            for row, data, offsets in kernels.text_slices(batch.column(1)):
                starts, ends, at = kernels.word_bounds(data, offsets)
                hashes = letters.runs(letters.prefix(letters.byte_values[data]), starts, ends)
                for i in range(len(offsets) - 1):
                    bounds = spans[row + i].values.to_numpy()
                    # Stretches never overlap, so no window comes twice.
                    window = np.concatenate(
                        [np.arange(a, b + 1) for a, b in zip(bounds[::2], bounds[1::2], strict=True)]
                    )
                    own = hashes[at[i] : at[i + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(one.runs(one.prefix(own), window, window + words).view(np.int64)),
                            pa.array(two.runs(two.prefix(kernels.mixed(own)), window, window + words).view(np.int64)),
                            pa.array(np.full(len(window), docs[row + i])),
                            pa.array(np.full(len(window), prints[row + i])),
                            pa.array(window.astype(np.int32)),
                        ],
                        names=["w1", "w2", "doc", "fp", "first"],
                    )

    return find


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, text, fp): rows are told apart by their id and a fingerprint of their text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc"), body.alias("text"), F.xxhash64(body).alias("fp"))


def repeated_spans(docs: DataFrame, words: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, fp, first, last): stretches of window starts whose windows also start in a smaller document."""
    texts = _texts(docs, doc_id, text)
    anchors = texts.filter("doc IS NOT NULL").mapInArrow(_find_anchors(words), _ANCHORS)
    # First level: half-runs of two documents or more. One row per half-run leaves a task.
    repeated = (
        anchors.groupBy("h")
        .agg(
            F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("c").alias("c_lo"), F.max("c").alias("c_hi")
        )
        .filter("lo < hi")
        .select("h", (F.col("c_lo") < F.col("c_hi")).alias("varied"))
    )
    alive = staged(anchors.join(repeated, "h"), "anchors")
    # Second level, whole stretches: the smallest document of each.
    holders = alive.groupBy("h", "c").agg(F.min("doc").alias("holder"))
    judged = alive.join(holders, ["h", "c"])
    covered = judged.filter("holder < doc").select("doc", "fp", "first", "last")
    # Second level, single windows, where a half-run has different surroundings.
    open_ = (
        judged.filter("varied AND holder = doc")
        .groupBy("doc", "fp")
        .agg(F.flatten(F.collect_set(F.array("first", "last"))).alias("spans"))
    )
    # One text of a repeated row is enough: its windows are the same.
    asked = texts.join(open_, ["doc", "fp"])
    windows = asked.select("doc", "text", "fp", "spans").mapInArrow(
        _find_windows(words), "w1 long, w2 long, doc long, fp long, first int"
    )
    windows = staged(windows, "windows")
    smallest = windows.groupBy("w1", "w2").agg(F.min("doc").alias("holder"), F.max("doc").alias("top"))
    single = (
        windows.join(smallest.filter("holder < top"), ["w1", "w2"])
        .filter("holder < doc")
        .select("doc", "fp", "first", F.col("first").alias("last"))
    )
    return covered.unionByName(single)


def _remove(words: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, lasts = batch.column(1), batch.column(2)
            for row, data, offsets in kernels.text_slices(batch.column(0)):
                starts, ends, at = kernels.word_bounds(data, offsets)
                raw = data.tobytes()
                kept, n_words, n_removed = [], [], []
                for i in range(len(offsets) - 1):
                    lo, hi = at[i], at[i + 1]
                    keep = np.ones(hi - lo, bool)
                    if firsts[row + i].is_valid:
                        depth = np.zeros(hi - lo + 1, np.int64)
                        np.add.at(depth, firsts[row + i].values.to_numpy(), 1)
                        np.add.at(depth, lasts[row + i].values.to_numpy() + words, -1)
                        keep = np.cumsum(depth[:-1]) == 0
                    s, e = starts[lo:hi][keep].tolist(), ends[lo:hi][keep].tolist()
                    kept.append(b" ".join([raw[a:b] for a, b in zip(s, e, strict=True)]))
                    n_words.append(hi - lo)
                    n_removed.append(hi - lo - len(s))
                rows = batch.slice(row, len(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[3:],
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                    ],
                    names=[*rows.schema.names[3:], "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return remove


def remove_repeats(docs: DataFrame, words: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, kept_sha256.

    Removed is each word that lies in a window of ``words`` words whose word sequence also starts in
    a document with a smaller id; windows are judged on the input. The words that are kept are joined
    by one space. Other columns are not read.

    A null text is an empty one; texts with fewer words than a window lose nothing. Rows with equal
    ids do not remove each other's words; repeated rows give repeated results. A row with a null id
    loses nothing and removes nothing. An empty table gives an empty result.
    """
    spans = (
        repeated_spans(docs, words, doc_id, text)
        .groupBy("doc", "fp")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    joined = _texts(docs, doc_id, text).join(spans, ["doc", "fp"], "left")
    return joined.select(
        "text", F.col("spans.first").alias("firsts"), F.col("spans.last").alias("lasts"), F.col("doc").alias(doc_id)
    ).mapInArrow(
        _remove(words),
        f"`{doc_id}` long, n_words long, n_removed long, kept_text string, kept_sha256 string",
    )


shipped(__name__)
