import random

import numpy as np
import pytest

from keepwell.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code int, error string"


def brute(rows, parts=8, entries=16, rounds=6):
    """(codes, errors, books) of (id, vector) rows in their order."""
    x = np.floor(np.array([v for _, v in rows], np.float64) * 4096).astype(np.int64)
    x = x.reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0], x[k].ravel().tolist()))[:entries]
    books = [x[first, p] for p in range(parts)]

    def nearest(p):
        d = ((x[:, p][:, None] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p in range(parts):
            code, _ = nearest(p)
            books[p] = np.array(
                [x[code == e, p].sum(axis=0) // (code == e).sum() if (code == e).any() else b for e, b in enumerate(books[p])]
            )
    found = [nearest(p) for p in range(parts)]
    codes = ["".join("%02x" % c[k] for c, _ in found) for k in range(len(rows))]
    return codes, sum(e for _, e in found), np.stack(books)


def vectors(n=400, width=16, seed=1):
    rng = np.random.default_rng(seed)
    out = rng.normal(0, 0.3, (n, width)).round(2)
    out[: n // 3] = out[0] + rng.normal(0, 0.02, (n // 3, width))  # a third close together
    out[5:20] = out[5]  # equal vectors among the first entries
    out[30:40] = 0
    return out.astype(np.float32).tolist()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("n", [400, 9, 1])
def test_codes(spark, n):
    rows = [(k * 3, v, k % 5 or None) for k, v in enumerate(vectors(max(n, 40))[:n])]
    odd = [(-1, None, 1), (-2, [], 1), (-3, [float("nan")] * 16, 1), (-4, [None] + [0.1] * 15, 1),
           (-5, [float("inf")] * 16, 2), (-6, [1e30] * 16, 2), (10_000, [0.1] * 8, 2), (10_001, [0.1] * 15, 2)]
    got = {r.vec_id: r for r in codebooks.vector_codes(frame(spark, rows + odd)).collect()}
    codes, errors, books = brute([(i, v) for i, v, _ in rows])
    assert set(got) == {i for i, _, _ in rows}
    sums = {}
    for (_, _, label), e in zip(rows, errors, strict=True):
        sums[label] = sums.get(label, 0) + int(e)
    for (i, _, label), code, error in zip(rows, codes, errors, strict=True):
        r = got[i]
        assert (r.code, r.error, r.label_error, r.codebooks_sha256) == (code, error, sums[label], codebooks.books_digest(books))


def test_repeated_and_null_ids_and_no_rows(spark):
    v = vectors(40)
    rows = [(None, v[20], 1), (3, v[21], 1), (3, v[21], 1), (3, v[22], 1), *[(k, v[k], 2) for k in range(4, 18)]]
    got = codebooks.vector_codes(frame(spark, rows)).collect()
    codes, errors, books = brute([(i, x) for i, x, _ in rows])
    assert sorted((r.vec_id or -1, r.code, r.error) for r in got) == sorted(
        (i or -1, c, int(e)) for (i, _, _), c, e in zip(rows, codes, errors, strict=True)
    )
    assert {r.codebooks_sha256 for r in got} == {codebooks.books_digest(books)}
    assert codebooks.vector_codes(frame(spark, rows).limit(0)).collect() == []
    assert codebooks.book_table(spark, books).count() == books.shape[0] * books.shape[1]


@pytest.mark.parametrize("near", [1, 2, 5, 15])
def test_bounds_hold_with_any_number_of_entries(near):
    """Assignments under moving entries, with more and fewer near entries from round to round."""
    rng = np.random.default_rng(near)
    x = rng.integers(-50, 50, (500, 3))
    book = rng.integers(-50, 50, (16, 3))
    book[4] = book[9]
    state, pick = codebooks.from_scratch(x, book, near), random.Random(near)
    for _ in range(12):
        new = book + rng.integers(-6, 7, book.shape) * (rng.random((16, 1)) < 0.6)
        far = codebooks.movements(book[None], new[None])[0]
        book, near = new, min(15, max(1, near + pick.choice([-2, 0, 3])))
        state, _, _ = codebooks.assigned(x, book, codebooks.moved_on(codebooks.fitted_to(state, near, 16), far))
        d = codebooks.squared(x, book)
        assert (state.code == d.argmin(axis=1)).all()
        distance = np.sqrt(d)
        assert (state.upper >= distance[np.arange(500), state.code] - 1e-9).all()
        outside = np.ones((500, 16), bool)
        outside[np.arange(500), state.code] = False
        for z in range(near):
            real = state.near[:, z] < 16
            rows = np.flatnonzero(real)
            assert (state.low[rows, z] <= distance[rows, state.near[rows, z]] + 1e-9).all()
            outside[rows, state.near[rows, z]] = False
        assert (np.where(outside, distance, 1e9).min(axis=1) >= np.minimum(state.low[:, -1], 1e9) - 1e-9).all()


def test_roots():
    x = np.array([0, 1, 2, 3, 4, 15, 16, 17, (1 << 40) ** 1, (1 << 29) ** 2, (1 << 29) ** 2 - 1, (1 << 29) ** 2 + 1])
    assert all(r * r <= v < (r + 1) ** 2 for r, v in zip(codebooks.root(x).tolist(), x.tolist(), strict=True))
    assert all((r - 1) ** 2 < v <= r * r for r, v in zip(codebooks.root_up(x).tolist()[1:], x.tolist()[1:], strict=True))
