"""Mixing sources to target weights by hash thresholds: no sort, no draw, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.llm.common import WORD, fresh, staged

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3

#: A document's hash has 60 bits, looked at 15 at a time: 32768 buckets a source and level.
_HASH_BITS, _LEVEL_BITS = 60, 15


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(*keys: Column) -> Column:
    """The first 60 bits of an MD5, as a number; the same in any engine."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """(source, source_size, target): one row per source of (source, size) rows.

    All sizes together are shared by weight; a target stops at ``most`` times its source's size and
    what is over goes to the others by weight, until none is above. The end of that is
    target = min(most * size, level * weight) for one level: with the sources in the order in which
    a rising level reaches their stops, it is found from running sums. One row per source, not per
    document, goes through the two windows.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything, by_name = Window.partitionBy(), Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    )
    stops = per_source.withColumn("weight", weight).withColumns(
        {"stop": F.col("source_size") * F.lit(float(most)), "total": F.sum("source_size").over(everything)}
    )
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_stop.rowsBetween(0, Window.unboundedFollowing)
    # The level if all before this source stop and none from it on does.
    level = (F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    # Stopping too few or too many sources gives a lower level than stopping the right ones.
    leveled = stops.withColumn("level", level).withColumn("common", F.max("level").over(everything))
    return leveled.select(
        "source", "source_size", F.least(F.col("stop"), F.col("common") * F.col("weight")).alias("target")
    )


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, full, threshold): every document is taken ``full`` times, those with a hash below it once more.

    The threshold is the largest with which the source stays within its target. It is found from the
    top bits down: tokens are summed by source and bucket, running sums give the bucket in which the
    budget ends, and only the documents of that bucket are looked at for the next bits.
    """
    least = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = staged(
        targets.select(
            "source",
            least.cast("int").alias("full"),
            (F.col("target") - least * F.col("source_size")).alias("budget"),
            F.lit(0).cast("long").alias("prefix"),
        ),
        "budgets",
    )
    for done in range(0, _HASH_BITS, _LEVEL_BITS):
        rest = _HASH_BITS - done
        inside = sized
        if done:
            place = F.shiftrightunsigned("hash", rest).alias("prefix")
            ends = state.select(F.col("source").alias("s"), F.col("prefix").alias("p"))
            inside = sized.join(ends, F.col("source").eqNullSafe(F.col("s")) & (place == F.col("p")), "left_semi")
        bucket = F.shiftrightunsigned("hash", rest - _LEVEL_BITS)
        counts = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"))
        running = Window.partitionBy("source").orderBy("bucket")
        upto = counts.withColumn("upto", F.sum("size").over(running))
        budgets = state.select(F.col("source").alias("s"), "budget")
        fits = (
            upto.join(budgets, F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(
                F.max(F.when(F.col("upto") <= F.col("budget"), F.col("upto"))).alias("spent"),
                F.min(F.when(F.col("upto") > F.col("budget"), F.col("bucket"))).alias("next"),
            )
            .withColumnRenamed("source", "s")
        )
        # Nothing over the budget in reach: the threshold lies beyond the last bucket of this prefix.
        state = staged(
            state.join(fits, F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source",
                "full",
                (F.col("budget") - F.coalesce("spent", F.lit(0))).alias("budget"),
                F.coalesce(
                    "next", F.shiftleft(F.col("prefix") + 1, _LEVEL_BITS)
                ).alias("prefix"),
            ),
            "budgets",
        )
    return state.select("source", "full", F.col("prefix").alias("threshold"))


def _copies(full: Column, hashed: Column, threshold: Column, most: float) -> Column:
    return F.least(full + (hashed < threshold).cast("int"), F.lit(int(most)))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST_REPEATS,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per row of ``docs``.

    Sizes are counts of words, 0 for a null text. Sources, ordered by code point with null last, have
    ``weights`` in turn and share 100 % of all sizes; no target is above ``most`` times its source's
    size. Every document of a source is taken floor(target / size of the source) times, and once more
    if its hash lies below the source's threshold, the largest one that stays within the target; so a
    source's taken words are below its target by less than one document, or than all documents of one
    hash. copies is at most ``most``.

    The hash is of the id alone: repeated rows are taken alike, as are rows with a null id, and reruns
    and other partitionings agree. Empty texts have size 0; their copies count as documents, not as
    words. A source without words has target 0 and
    keeps its documents once. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(source).cast("string").alias("source"), F.col(text).alias("t"))
    sized = staged(
        rows.select("doc", "source", word_count(F.col("t")).alias("size"), hash60(F.col("doc")).alias("hash")), "sizes"
    )
    targets = staged(source_targets(sized, weights, most), "targets")
    rules = targets.join(
        _thresholds(sized, targets).select(F.col("source").alias("s2"), "full", "threshold"),
        F.col("source").eqNullSafe(F.col("s2")),
    ).select(F.col("source").alias("s"), "source_size", "target", "full", "threshold")
    copies = _copies(F.col("full"), F.col("hash"), F.col("threshold"), most)
    return sized.join(rules, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("doc").alias(doc_id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """``docs`` itself with every document as often as ``mix`` takes it; all columns stay.

    The texts are not shuffled by source: a document's copies follow from its source's rule, one
    small row, and its own hash.
    """
    rows = docs.select(F.col("doc_id").alias("doc"), F.col("source").cast("string").alias("source"), F.col("text").alias("t"))
    sized = staged(
        rows.select("doc", "source", word_count(F.col("t")).alias("size"), hash60(F.col("doc")).alias("hash")), "sizes"
    )
    targets = staged(source_targets(sized, weights, most), "targets")
    s, full, threshold, copy = (fresh(f"_mix_{x}", docs.columns) for x in ("source", "full", "threshold", "copy"))
    rules = _thresholds(sized, targets).toDF(s, full, threshold)
    copies = _copies(F.col(full), hash60(F.col("doc_id")), F.col(threshold), most)
    return (
        docs.join(rules, F.col("source").cast("string").eqNullSafe(F.col(s)))
        .withColumn(copy, F.explode(F.sequence(F.lit(0), copies)))
        .filter(F.col(copy) > 0)
        .select(*docs.columns)
    )


QUERY_COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]

#: The same in DuckDB: the documents of a source in hash order, as long as they fit.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sized GROUP BY source
), stops AS (
  SELECT *, 3.0::DOUBLE * source_size AS stop, sum(source_size) OVER ()::DOUBLE AS total FROM per_source
), levels AS (
  SELECT *, (total - coalesce(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM stops
), targets AS (
  SELECT source, source_size, least(stop, weight * (SELECT max(level) FROM levels)) AS target
  FROM levels
), ordered AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS full_copies,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((full_copies + CASE WHEN upto <= target - full_copies * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ordered
"""
