"""Vector code compression: product codebooks in whole numbers, assigned with Drake-Hamerly adaptive bounds.

Components become whole numbers and a vector is cut into equal parts, each coded by the nearest entry of
its position's codebook. For every part the state keeps its entry with an upper bound of the distance to
it, its ``near`` next closest entries with ordered lower bounds, and one outer bound for all other
entries. When entries move, bounds move with them (triangle inequality). Where the upper bound lies below
the first lower bound nothing needs to be computed; else the entries whose bounds reach it are compared
by exact integer distances, and all entries only where the outer bound reaches it. How many entries are
kept is adapted after each round to how many were needed.

All bounds are whole numbers, rounded down below and up above, so they hold exactly; entries that tie are
never told apart by a bound. A round reads the written state and writes the next one, with the sums of
its tasks beside it; the driver holds the codebooks, whose size is parts x entries x width of a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm.common import deleted, shipped, staged, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Larger components are no 28-bit numbers; their squared distances would leave the range of 64 bits.
LARGEST = 1 << 27
#: Numbers in the arrays of a step, about.
_ROOM = 1 << 21
_FAR = np.int64(1 << 60)


def root(x: np.ndarray) -> np.ndarray:
    """Square roots of whole numbers, rounded down."""
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    r += (r + 1) * (r + 1) <= x
    return r


def root_up(x: np.ndarray) -> np.ndarray:
    r = root(x)
    return r + (r * r < x)


@dataclass
class Bounds:
    """State of one part position for n vectors: entry, upper bound, near entries, their lower bounds and the outer one."""

    code: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    low: np.ndarray  # one column more than near: the outer bound

    def rows(self, which: np.ndarray) -> Bounds:
        return Bounds(self.code[which], self.upper[which], self.near[which], self.low[which])


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to entries of shape (n, m, d) or (m, d)."""
    difference = x[:, None, :] - entries
    return np.einsum("nmd,nmd->nm", difference, difference)


def from_scratch(x: np.ndarray, book: np.ndarray, near: int) -> Bounds:
    """All distances, in the order of distance and then of index."""
    d = squared(x, book)
    order = np.argsort(d, axis=1, kind="stable")
    d = np.take_along_axis(d, order, axis=1)
    k = len(book)
    low = np.full((len(x), near + 1), _FAR)
    low[:, : min(near + 1, k - 1)] = root(d[:, 1 : near + 2])
    others = np.full((len(x), near), k)
    others[:, : min(near, k - 1)] = order[:, 1 : near + 1]
    return Bounds(order[:, 0], root_up(d[:, 0]), others, low)


def fitted_to(old: Bounds, near: int, entries: int) -> Bounds:
    """The same bounds with another number of near entries: the first that goes bounds all outside; one
    that is added stands for any entry (its number is ``entries``) under the outer bound."""
    have = old.near.shape[1]
    if near <= have:
        return Bounds(old.code, old.upper, old.near[:, :near], old.low[:, : near + 1])
    more = near - have
    pad = np.full((len(old.code), more), entries)
    return Bounds(
        old.code, old.upper, np.hstack([old.near, pad]), np.hstack([old.low, np.repeat(old.low[:, -1:], more, axis=1)])
    )


def moved_on(old: Bounds, moved: np.ndarray) -> Bounds:
    """Bounds after the entries went as far as ``moved`` (at the end: the farthest), lower ones in order again."""
    low = old.low.copy()
    low[:, :-1] -= moved[old.near]
    low[:, -1] -= moved[-1]
    low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    return Bounds(old.code, old.upper + moved[old.code], old.near, low)


def assigned(x: np.ndarray, book: np.ndarray, state: Bounds) -> tuple[Bounds, int, int]:
    """The state with every row's nearest entry; near entries that were needed at most, rows compared with all."""
    near = state.near.shape[1]
    unsure = np.flatnonzero(state.low[:, 0] <= state.upper)
    if len(unsure):
        exact = squared(x[unsure], book[state.code[unsure]][:, None, :])[:, 0]
        state.upper[unsure] = root_up(exact)
    needed = (state.low <= state.upper[:, None]).sum(axis=1)
    whole = np.flatnonzero(needed > near)
    some = np.flatnonzero((needed > 0) & (needed <= near))
    most = int(needed[some].max(initial=0))
    if len(some):
        part = state.rows(some)
        tried = np.hstack([part.code[:, None], part.near[:, :most]])
        d = squared(x[some], book[np.minimum(tried, len(book) - 1)])
        # Beyond what a row needs, entries keep their bounds, which lie above; an entry that stands for any is never needed.
        d[np.arange(most + 1)[None, :] > needed[some][:, None]] = np.iinfo(np.int64).max
        order = np.lexsort((tried, d), axis=1)
        tried, d = np.take_along_axis(tried, order, axis=1), np.take_along_axis(d, order, axis=1)
        known = np.arange(1, most + 1)[None, :] <= needed[some][:, None]
        part.code, part.upper = tried[:, 0], root_up(d[:, 0])
        part.near[:, :most] = np.where(known, tried[:, 1:], part.near[:, :most])
        part.low[:, :most] = np.where(known, root(np.where(known, d[:, 1:], 0)), part.low[:, :most])
        state.code[some], state.upper[some], state.near[some], state.low[some] = (
            part.code, part.upper, part.near, np.minimum.accumulate(part.low[:, ::-1], axis=1)[:, ::-1],
        )
    if len(whole):
        again = from_scratch(x[whole], book, near)
        state.code[whole], state.upper[whole], state.near[whole], state.low[whole] = (
            again.code, again.upper, again.near, again.low,
        )
    return state, most, len(whole)


#: One row a vector, and one a task with its sums.
_STATE = (
    "id long, label string, vector array<int>, code array<int>, upper array<long>, near array<int>, low array<long>, "
    "error long, sums array<long>, counts array<long>, needed long, whole long"
)


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A two-dimensional array as one list a row."""
    offsets = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(x).ravel()).cast(kind))


def _stacked(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)


def _round(books: np.ndarray, moved: np.ndarray | None, near: int, last: bool):
    """A task's round: books (parts, entries, d); moved (parts, entries + 1), or None in the first round."""
    parts, entries, d = books.shape
    names = [f.split()[0] for f in _STATE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries * d), np.int64), np.zeros((parts, entries), np.int64)
        needed = whole = 0
        step = max(1, _ROOM // (entries * d))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                n = rows.num_rows
                x = _stacked(rows.column("vector"), n).reshape(n, parts, d)
                old = None
                if moved is not None:
                    code, upper = _stacked(rows.column("code"), n), _stacked(rows.column("upper"), n)
                    others = _stacked(rows.column("near"), n).reshape(n, parts, -1)
                    low = _stacked(rows.column("low"), n).reshape(n, parts, -1)
                    old = [Bounds(code[:, p], upper[:, p], others[:, p], low[:, p]) for p in range(parts)]
                new, error = [], np.zeros(n, np.int64)
                for p in range(parts):
                    mine = np.ascontiguousarray(x[:, p])
                    if old is None:
                        state = from_scratch(mine, books[p], near)
                    else:
                        state = moved_on(fitted_to(old[p], near, entries), moved[p])
                        state, most, all_of = assigned(mine, books[p], state)
                        needed, whole = max(needed, most), whole + all_of
                    new.append(state)
                    if last:
                        error += squared(mine, books[p][state.code][:, None, :])[:, 0]
                    else:
                        place = (state.code[:, None] * d + np.arange(d)).ravel()
                        sums[p] += np.bincount(place, weights=mine.ravel(), minlength=entries * d).astype(np.int64)
                        counts[p] += np.bincount(state.code, minlength=entries)
                none = pa.nulls(n, pa.list_(pa.int64()))
                kept = [
                    _lists(np.stack([s.code for s in new], axis=1), pa.int32()),
                    _lists(np.stack([s.upper for s in new], axis=1), pa.int64()),
                    _lists(np.stack([s.near for s in new], axis=1).reshape(n, -1), pa.int32()),
                    _lists(np.stack([s.low for s in new], axis=1).reshape(n, -1), pa.int64()),
                ]
                if last:  # no round follows that would read them
                    empty = [pa.nulls(n, x.type) for x in kept[1:]]
                    kept, vector = [kept[0], *empty], pa.nulls(n, pa.list_(pa.int32()))
                else:
                    vector = rows.column("vector")
                zero = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("label"), vector, *kept, pa.array(error), none, none, zero, zero],
                    names=names,
                )
        if not last:
            nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.string())]
            lists = [pa.nulls(1, pa.list_(t)) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [
                    *nothing,
                    *lists,
                    pa.nulls(1, pa.int64()),
                    _lists(sums.reshape(1, -1), pa.int64()),
                    _lists(counts.reshape(1, -1), pa.int64()),
                    pa.array([needed]),
                    pa.array([whole]),
                ],
                names=names,
            )

    return run


def _totals(state: DataFrame, column: str, size: int) -> list[int]:
    """Place by place the sum of the tasks' arrays: as many rows as the codebooks have numbers."""
    places = state.filter("sums IS NOT NULL").select(F.posexplode(column).alias("place", "value"))
    summed = places.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    out = [0] * size
    for place, total in summed:
        out[place] = int(total)
    return out


def next_books(books: np.ndarray, sums: list[int], counts: list[int]) -> np.ndarray:
    """Componentwise floor(sum / count); entries that nothing was assigned to stay."""
    parts, entries, d = books.shape
    out = books.copy()
    for p in range(parts):
        for e in range(entries):
            if count := counts[p * entries + e]:
                at = (p * entries + e) * d
                out[p, e] = [s // count for s in sums[at : at + d]]
    return out


def movements(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry went, rounded up, and for each part the farthest."""
    far = root_up(((new - old) ** 2).sum(axis=2))
    return np.hstack([far, far.max(axis=1, keepdims=True)])


def whole_numbers(
    vectors: DataFrame, vec_id: str, embedding: str, label: str, parts: int
) -> DataFrame:
    """(id, label, vector) of the vectors that can be coded, components as floor(SCALE * x)."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("raw"),
    )
    sound = (F.size("raw") > 0) & (F.size("raw") % parts == 0)
    sound &= F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LARGEST))
    return rows.filter(F.coalesce(sound, F.lit(False))).select(
        "id", "label", F.transform("raw", lambda x: F.floor(x * SCALE).cast("int")).alias("vector")
    )


def learn(
    numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[np.ndarray, DataFrame, str | None]:
    """The final codebooks (parts, entries, width of a part), the rows (id, label, code, error), and where those are.

    ``numbers`` is a written table as of ``whole_numbers``.
    """
    spark = numbers.sparkSession
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = numbers.orderBy(*order).select("vector").first()
    width = len(first["vector"])
    numbers = numbers.filter(F.size("vector") == width)
    chosen = [r["vector"] for r in numbers.orderBy(*order).select("vector").limit(entries).collect()]
    books = np.array(chosen, np.int64).reshape(len(chosen), parts, -1).transpose(1, 0, 2)
    entries, d = len(chosen), width // parts
    least = min(max(1, entries // 8), entries - 1)
    near = min(max(1, entries // 4), entries - 1)
    state, path, moved = numbers, None, None
    for _ in range(rounds):
        done = state.mapInArrow(_round(books, moved, near, False), _STATE)
        following, new_path = written(done, "codes")
        before, books = books, next_books(
            books, _totals(following, "sums", parts * entries * d), _totals(following, "counts", parts * entries)
        )
        moved = movements(before, books)
        used = following.agg(F.max("needed").alias("needed"), F.sum("whole").alias("whole"), F.count("code").alias("n"))
        needed, whole, n = used.first()
        # As many near entries as were needed; twice as many if the outer bound often did not hold.
        if path is not None:  # the first round has no bounds to go by
            near = min(2 * near, entries - 1) if 4 * (whole or 0) > n * parts else min(near, max(needed or 0, least))
        if path is not None:
            deleted(spark, path)
        state, path = following.filter("sums IS NULL"), new_path
    final = state.mapInArrow(_round(books, moved, near, True), _STATE)
    coded, coded_path = written(final.select("id", "label", "code", "error"), "coded")
    if path is not None:
        deleted(spark, path)
    return books, coded, coded_path


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def book_table(spark: SparkSession, books: np.ndarray) -> DataFrame:
    """(part, entry, components): the codebooks as a table."""
    rows = [(p, e, books[p, e].tolist()) for p in range(books.shape[0]) for e in range(books.shape[1])]
    return spark.createDataFrame(rows, "part int, entry int, components array<long>")


def vector_codes(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector that can be coded: vec_id, code, error, label_error, codebooks_sha256.

    Each component x becomes floor(SCALE * x); vectors are cut into ``parts`` equal parts. Codebooks start
    as the parts of the ``entries`` smallest vec_ids (repeated ids by vector, null ids last); each of
    ``rounds`` rounds assigns every part to its nearest entry, ties to the lower index, and replaces each
    entry by the componentwise floor of its parts' mean; an unused entry stays. ``code`` has two hex digits
    a part (so at most 256 entries), ``error`` the squared distances summed over the parts, ``label_error`` the
    errors summed over equal labels, nulls together.

    Left out are vectors that are null, empty, that hold a null or non-finite component or one beyond 28 bits
    once scaled (whose error would not be a 64-bit number), or whose length is no multiple of ``parts`` or
    other than that of the smallest vec_id left. With fewer vectors than ``entries`` there are as many entries
    as vectors. Repeated rows are coded each, an empty table gives an empty one. Other columns are not read.
    """
    spark = vectors.sparkSession
    numbers, path = written(whole_numbers(vectors, vec_id, embedding, label, parts), "numbers")
    if numbers.isEmpty():
        return spark.createDataFrame(
            [], f"`{vec_id}` long, code string, error long, label_error long, codebooks_sha256 string"
        )
    books, coded, _ = learn(numbers, parts, entries, rounds)
    deleted(spark, path)
    totals = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    both = coded.join(totals.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    code = F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    return both.select(
        F.col("id").alias(vec_id),
        code.alias("code"),
        "error",
        "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"),
    )


shipped(__name__)
