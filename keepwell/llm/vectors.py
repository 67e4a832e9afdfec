"""Embedding near-dedup: int8 tile products with rigorous error bounds, then double precision.

A unit vector x is stored as s * q + e with whole numbers q in [-127, 127], a scale s and a remainder
e whose length is computed, not estimated. For two vectors
|x.y - s_x s_y q_x.q_y| <= |s_x q_x| |e_y| + |e_x| |s_y q_y| + |e_x| |e_y|, so a pair whose quantised
product lies further than that below the threshold cannot be a link. Only the other pairs are
computed in double precision.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.common import components, shipped, staged

THRESHOLD = 0.93
#: Vectors in a block; a task holds two blocks and their product, TILE x TILE floats.
TILE = 1024


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, lengths of scale * row, lengths of the remainder (with room for its rounding)."""
    scale = np.abs(unit).max(axis=1, initial=0.0) / 127
    scale[scale == 0] = 1.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    rest = np.sqrt(((unit - back) ** 2).sum(axis=1)) + 1e-12
    return q, scale, np.sqrt((back**2).sum(axis=1)), rest


def _in_range(x: np.ndarray) -> np.ndarray:
    """Vectors so large or small that a square leaves the range of doubles, brought to length about one."""
    most = np.abs(x).max(axis=1, initial=0.0, keepdims=True)
    return np.where((most > 1e150) | (most < 1e-150), x / np.where(most > 0, most, 1.0), x)


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with cosine >= threshold; within one block only i < j."""
    left, right = _in_range(left), _in_range(right)
    norms = [np.sqrt((x**2).sum(axis=1)) for x in (left, right)]
    (qa, sa, la, ea), (qb, sb, lb, eb) = (quantised(x / n[:, None]) for x, n in zip((left, right), norms, strict=True))
    # Whole numbers of this size are exact in single precision up to about 1000 dimensions,
    # and in double precision beyond.
    exact = np.float32 if 127 * 127 * left.shape[1] < 1 << 24 else np.float64
    product = (qa.astype(exact) @ qb.astype(exact).T).astype(np.float64)
    bound = la[:, None] * eb + ea[:, None] * (lb + eb)
    maybe = product * sa[:, None] * sb + bound >= threshold - 1e-9
    if same:
        maybe = np.triu(maybe, 1)
    i, j = np.nonzero(maybe)
    hit = np.zeros(len(i), bool)
    for start in range(0, len(i), 1 << 14):
        part = slice(start, start + (1 << 14))
        a, b = left[i[part]], right[j[part]]
        hit[part] = (a * b).sum(axis=1) / (norms[0][i[part]] * norms[1][j[part]]) >= threshold
    return i[hit], j[hit]


def _lowest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node in its component under the links (i, j)."""
    low = np.arange(n)
    while True:
        before = low.copy()
        np.minimum.at(low, i, low[j])
        np.minimum.at(low, j, low[i])
        low = low[low]
        if np.array_equal(low, before):
            return low


def _compare(threshold: float):
    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        """One row a vector: links found here by its partners' weights, and the smallest id it hangs on to here."""
        x, y = int(tile["x"].iloc[0]), int(tile["y"].iloc[0])
        tile = tile.sort_values("id", ignore_index=True)
        vectors = np.stack([np.asarray(v, np.float64) for v in tile["vector"]])
        block, weight, n = tile["block"].to_numpy(), tile["copies"].to_numpy(), len(tile)
        if x == y:
            i, j = tile_links(vectors, vectors, threshold, True)
        else:
            a, b = np.flatnonzero(block == x), np.flatnonzero(block == y)
            if not len(a) or not len(b):
                return pd.DataFrame({"id": [], "links": [], "low": []}).astype("int64")
            i, j = tile_links(vectors[a], vectors[b], threshold, False)
            i, j = a[i], b[j]
        links = np.zeros(n, np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        ids = tile["id"].to_numpy()
        low = ids[_lowest(n, i, j)]
        found = links > 0
        return pd.DataFrame({"id": ids[found], "links": links[found], "low": low[found]})

    return compare


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    tile: int = TILE,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors with equal labels are linked if their cosine in double precision is >= threshold; links
    are complete, as every pair within a label is compared. n_links counts the other rows linked
    directly, copies included; component_id is the smallest id in reach; kept marks that row.

    Vectors that are null, empty, zero, or that hold a null or non-finite component, and rows with a
    null label or a null id, link with nothing; so do vectors of different lengths. Equal vectors of
    a label are searched once and count as often as they occur (among repeated rows with one id, too).
    Tiles have about ``tile`` vectors a side however large a label is; a task returns at most one row
    a vector. Other columns are not read.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    sound = (
        F.col("label").isNotNull()
        & F.col("id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    # Minus zero is zero: equal vectors need equal bytes.
    usable = rows.filter(F.coalesce(sound, F.lit(False))).withColumn(
        "vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    )
    copies = staged(
        usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    # One representative id may stand for several vectors if ids repeat; number them by id and vector.
    sizes = copies.groupBy("label", F.size("vector").alias("width")).agg(
        F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks")
    )
    placed = copies.withColumn("width", F.size("vector")).join(sizes, ["label", "width"])
    blocks = placed.withColumn("block", F.pmod(F.xxhash64("rep", "vector"), F.col("blocks")).cast("int"))
    tiles = blocks.select(
        "label", "width", "rep", "vector", "copies", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    partial = tiles.select(
        "label", "width", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        F.col("rep").alias("id"), "vector", "copies", "block",
    )
    compared = staged(
        partial.groupBy("label", "width", "x", "y").applyInPandas(_compare(threshold), "id long, links long, low long"),
        "tiles",
    )
    links = compared.groupBy("id").agg(F.sum("links").alias("links"))
    members = usable.join(copies, ["label", "vector"]).select("id", "rep", "copies")
    edges = compared.select(F.col("low").alias("a"), F.col("id").alias("b")).unionByName(
        members.select(F.col("rep").alias("a"), F.col("id").alias("b"))
    )
    per_id = (
        members.join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
        .groupBy("id")
        .agg(F.max("links").alias("links"))
    )
    found = per_id.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    return rows.select("id").join(found, "id", "left").select(
        F.col("id").alias(vec_id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


shipped(__name__)
