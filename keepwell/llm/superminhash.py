"""MinHash near-dedup by SuperMinHash signatures, banding, verification on full sets and union-find.

SuperMinHash gives every element of a set one random permutation of the signature's slots and, step
by step, a rank ``step + fraction`` for the slot that comes next in it; a slot keeps its lowest rank.
The ranks of one element are thus correlated over the slots, which lowers the variance against
independent hashes, and as soon as every slot is filled no later step can win, so large sets stop
after a few steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm import kernels
from keepwell.llm.common import components, fresh, leader_pairs, open_buckets, shared_buckets, shipped, staged

SHINGLE = 5
#: Links need 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: 32 bands of 4 rows miss a pair of similarity 0.75 with a chance of (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
#: Documents and characters on either side of a tile in which documents are compared in memory, about.
TILE_ROWS, TILE_CHARS = 1024, 1 << 24
#: Elements in the slot permutations of one batch; each takes one byte a slot.
_ELEMENTS = 1 << 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int, letters, rolling) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle count as one shingle."""
    data = kernels.lowered(data)
    starts, ends, at = kernels.word_bounds(data, offsets)
    hashes = letters.runs(letters.prefix(letters.byte_values[data]), starts, ends)
    sets = []
    sums = rolling.prefix(hashes)
    for i in range(len(offsets) - 1):
        lo, hi = int(at[i]), int(at[i + 1])
        if lo == hi:
            sets.append(np.zeros(0, np.uint64))
            continue
        first = np.arange(lo, max(lo + 1, hi - shingle + 1))
        sets.append(np.unique(rolling.runs(sums, first, np.minimum(first + shingle, hi))))
    return sets


def superminhash(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """Signatures, sets x slots, of the non-empty sets that ``owner`` numbers from 0."""
    ranks = np.full(sets * slots, np.inf)
    done = np.zeros(sets, bool)
    seeds, order = elements, None
    for step in range(slots):
        draw = kernels.mixed(seeds + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        fraction = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        pick = step + (kernels.mixed(draw) % np.uint64(slots - step)).astype(np.int64)
        if step == 0:
            slot = pick
        else:
            if order is None:  # only what outlives the first step gets its permutation written out
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(seeds), 1))
                rows = np.arange(len(seeds))
                order[rows, first_pick] = 0
            rows = np.arange(len(seeds))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, step]
        np.minimum.at(ranks, owner * slots + slot, step + fraction)
        done = np.isfinite(ranks.reshape(sets, slots)).all(axis=1)
        if done.all():
            break
        alive = ~done[owner]
        seeds, owner = seeds[alive], owner[alive]
        if step == 0:
            first_pick = pick[alive]
        else:
            order = order[alive]
    return ranks.reshape(sets, slots)


def _signed(shingle: int, bands: int, rows: int):
    def sign(sets: list[np.ndarray]) -> tuple[list, list]:
        """(digest, band keys) of each set."""
        digests, keys = [], [None] * len(sets)
        for s in sets:
            a = int(np.bitwise_xor.reduce(kernels.mixed(s))) if len(s) else 0
            b = int(np.add.reduce(kernels.mixed(s ^ np.uint64(0x5851F42D4C957F2D)))) if len(s) else 0
            digests.append(a.to_bytes(8, "little") + b.to_bytes(8, "little"))
        some = [i for i, s in enumerate(sets) if len(s)]
        while some:
            take, size = [], 0
            while some and (not take or size + len(sets[some[0]]) <= _ELEMENTS):
                size += len(sets[some[0]])
                take.append(some.pop(0))
            sizes = [len(sets[i]) for i in take]
            ranks = superminhash(
                np.concatenate([sets[i] for i in take]), np.repeat(np.arange(len(take)), sizes), len(take), bands * rows
            )
            bits = kernels.mixed(ranks.view(np.uint64)).reshape(len(take), bands, rows)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(take), bands)).copy()
            for r in range(rows):
                key = kernels.mixed(key + bits[:, :, r])
            for i, k in zip(take, key.view(np.int64), strict=True):
                keys[i] = k
        return digests, keys

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, rolling = kernels.RollingHash(51), kernels.RollingHash(52)
        for batch in batches:
            for row, data, offsets in kernels.text_slices(batch.column(1)):
                sets = shingle_sets(data, offsets, shingle, letters, rolling)
                digests, keys = sign(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc", "n_shingles", "digest", "bands"],
                )

    return find


def _verified(shingle: int, threshold: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, rolling = kernels.RollingHash(51), kernels.RollingHash(52)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                sides = []
                for column in (2, 3):
                    sets = []
                    for _, data, offsets in kernels.text_slices(part.column(column)):
                        sets += shingle_sets(data, offsets, shingle, letters, rolling)
                    sides.append(sets)
                linked = []
                for x, y in zip(*sides, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(100 * both >= threshold * (len(x) + len(y) - both) and both > 0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
                )

    return verify


def _tile_links(sets: list[np.ndarray], component: np.ndarray, block: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Index pairs of one tile that are linked and join two of its components; full sets are compared.

    Shingles are numbered within the tile; one document's numbers are marked and the marks counted for
    all documents at once. Within a component nothing is compared, and what gets linked is one.
    """
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    component = np.unique(component, return_inverse=True)[1]
    across = block.min() != block.max()
    largest = np.bincount(component).argmax()
    marks = np.zeros(numbers.max() + 1, bool)
    found = []
    for y in np.flatnonzero(component != largest):
        other = component != component[y]
        if across:
            other &= block != block[y]
        if not other.any():
            continue
        own = numbers[starts[y] : starts[y] + sizes[y]]
        marks[own] = True
        both = np.add.reduceat(marks[numbers], starts)
        marks[own] = False
        for x in np.flatnonzero(other & (100 * both >= threshold * (sizes[y] + sizes - both))):
            if component[x] != component[y]:
                found.append((x, y))
                component[component == component[x]] = component[y]
    return found


def _compare_tiles(shingle: int, threshold: int):
    """Over rows (key, x, y, rep, component, block, text) sorted by tile (key, x, y)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, rolling = kernels.RollingHash(51), kernels.RollingHash(52)
        tile, rows = None, []
        links: list[tuple[int, int]] = []

        def finish() -> None:
            if len(rows) > 1:
                rep, component, block, sets = zip(*rows, strict=True)
                for i, j in _tile_links(list(sets), np.array(component), np.array(block), threshold):
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))

        def found() -> pa.RecordBatch:
            a, b = zip(*links, strict=True) if links else ((), ())
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for row, data, offsets in kernels.text_slices(batch.column(6)):
                sets = shingle_sets(data, offsets, shingle, letters, rolling)
                key, x, y, rep, component, block = (
                    batch.column(c).slice(row, len(sets)).to_pylist() for c in range(6)
                )
                for i, s in enumerate(sets):
                    if (key[i], x[i], y[i]) != tile:
                        finish()
                        tile, rows = (key[i], x[i], y[i]), []
                    rows.append((rep[i], component[i], block[i], s))
            if links:
                yield found()
        finish()
        yield found()

    return compare


def _links(members: DataFrame, texts: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """Links (a, b) between the (rep, key) rows of ``members`` that are enough to connect all that is linked.

    Documents with a band in common are candidates. A bucket is never paired out. First its members
    are compared with the smallest one, as many pairs as members; in a group of thousands of copies
    that links nearly all. Only buckets that then hold several components go on. Their documents meet
    in tiles of bounded size, in which each is compared with those of other components in memory;
    what leaves a tile are the links that join components, fewer than it has documents.
    """
    buckets = shared_buckets(members)
    # Repeated rows count once; they are in one partition already, as the join is by id.
    wanted = buckets.select("rep").distinct()
    bodies = staged(texts.join(wanted, texts["doc"] == wanted["rep"], "left_semi").distinct(), "bodies")
    left = bodies.select(F.col("doc").alias("a"), F.col("text").alias("text_a"))
    right = bodies.select(F.col("doc").alias("b"), F.col("text").alias("text_b"))
    compared = leader_pairs(buckets).join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    judged = compared.mapInArrow(_verified(shingle, threshold), "a long, b long, linked boolean")
    first = staged(judged.filter("linked").select("a", "b").distinct(), "first-links")

    rows = open_buckets(buckets, first)
    lengths = bodies.select(F.col("doc").alias("rep"), F.length("text").alias("chars"))
    sizes = rows.join(lengths, "rep").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    blocks = F.ceil(F.greatest(F.col("n") / TILE_ROWS, F.col("chars") / TILE_CHARS)).cast("int")
    sizes = staged(sizes.select("key", blocks.alias("blocks")), "tile-sizes")
    placed = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "rep", "component", "block"
    )
    full = tiles.join(bodies.withColumnRenamed("doc", "rep"), "rep")
    met = full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    rest = met.select("key", "x", "y", "rep", "component", "block", "text").mapInArrow(
        _compare_tiles(shingle, threshold), "a long, b long"
    )
    return first.unionByName(staged(rest.distinct(), "more-links"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: int = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= threshold * |union| of their sets of distinct
    ``shingle``-word shingles (A-Z lower-cased). component_id is the smallest id in reach, kept marks
    the document with that id.

    Equal sets are grouped by digest first, so that copies enter the search once. A text with fewer
    words than a shingle is one shingle; a null or empty text, or one of white space, has an empty
    set and is its own component. Rows with a null id come back with a null component and are kept.
    Repeated rows give repeated results. Rows that share an id share its component, the id of all of
    them; of different texts under one id, each is searched. Other columns are not read.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    signed = staged(
        texts.mapInArrow(
            _signed(shingle, bands, rows), "doc long, n_shingles long, digest binary, bands array<long>"
        ),
        "signatures",
    )
    known = signed.filter("doc IS NOT NULL AND n_shingles > 0")
    groups = known.groupBy("digest").agg(F.min("doc").alias("rep"))
    grouped = staged(known.select("doc", "digest", "n_shingles").join(groups, "digest"), "groups")
    # Ids that are a copy of a smaller one need no search; the others stand for their group.
    reps = grouped.filter("doc = rep").select("doc", "digest").distinct()
    members = (
        known.join(reps, ["doc", "digest"])
        .select(F.col("doc").alias("rep"), F.explode("bands").alias("key"))
        .distinct()
    )
    links = _links(members, texts, shingle, threshold)
    copies = grouped.filter("rep < doc").select(F.col("rep").alias("a"), F.col("doc").alias("b"))
    label = components(links.unionByName(copies))
    out = signed.select("doc", "n_shingles").join(label.withColumnRenamed("node", "doc"), "doc", "left")
    return out.select(
        F.col("doc").alias(doc_id),
        "n_shingles",
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc") == F.col("doc"), F.lit(True)).alias("kept"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Rows with the same id and text stay once, different texts under one id all, as do rows with a null id.
    """
    judged = near_duplicates(docs)
    gone, text = fresh("_near_doc", docs.columns), fresh("_near_text", docs.columns)
    dropped = judged.filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    known = docs.filter(F.col("doc_id").isNotNull()).withColumn(text, F.xxhash64("text"))
    stay = known.join(dropped, F.col("doc_id").cast("long") == F.col(gone), "left_anti")
    return (
        stay.dropDuplicates(["doc_id", text]).drop(text).unionByName(docs.filter(F.col("doc_id").isNull()))
    )


shipped(__name__)
