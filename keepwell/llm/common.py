"""What the operators share: table access, names that cannot clash, staging, connected components."""

from __future__ import annotations

import gc
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.session import scratch_path
from keepwell.session import staged as _staged

#: A word is a run of other characters than ASCII white space.
SPACES = " \\t\\n\\x0B\\f\\r"
WORD = f"[^{SPACES}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(module_name: str) -> None:
    """Let Spark send this module's functions to the executors by value, where the package is not installed.

    What they call in other modules of the package goes with them, so the whole package is sent so.
    """
    for name in (__name__.partition(".")[0], module_name):
        cloudpickle.register_pickle_by_value(sys.modules[name])


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column of the input has (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder, go on from the written table, and let go of its shuffle files.

    Spark deletes the shuffle files of a finished phase when the driver's garbage collector has
    found its plan unreachable; asking for a collection here keeps the phases' files from adding up.
    """
    out = _staged(df, f"llm-{label}")
    released(df.sparkSession)
    return out


def written(df: DataFrame, label: str, **options: str) -> tuple[DataFrame, str]:
    """As ``staged``, with the path, so that a round can delete what the one before has written; ``options`` of the writer."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.options(**options).parquet(path)
    released(spark)
    return spark.read.schema(df.schema).parquet(path), path


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing will read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def released(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def word_array(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+"), lambda w: w != "")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges``: (node, component), component = smallest node in reach.

    Distributed union-find by alternating stars: every node hands its larger neighbours to the
    smallest node it knows (large star), then its smaller ones (small star), until nothing changes;
    each round halves the depth of the forest. Neighbours are reduced to their minimum map-side, so
    a hub with any number of neighbours is a minimum, never a list, and only joins by node are left;
    the minima are written first, so that those are of two plain shuffles, which Spark splits where a
    node is hot. Nulls and self-links are ignored; no edges give no rows.
    """
    links = (
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .filter(F.col("lo") < F.col("hi"))
        .distinct()
    )
    links = staged(links, "links")
    before = None
    while True:
        now = _fingerprint(links)
        if now == before or now[0] == 0:
            break
        before = now
        links = _small_star(staged(_large_star(links), "links"))
        links = staged(links, "links")
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def shared_buckets(members: DataFrame) -> DataFrame:
    """(key, rep, low): the (rep, key) rows whose key has two different reps or more, with the smallest of them."""
    # A written table, so that the join below is of two plain shuffles, of which Spark can split a hot key's.
    shared = members.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    shared = staged(shared.select("key", "low"), "shared")
    return staged(members.join(shared, "key").distinct(), "buckets")


def leader_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the bucket's smallest; as many pairs as members."""
    return buckets.select(F.col("low").alias("a"), F.col("rep").alias("b")).filter("a < b").distinct()


def open_buckets(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """(key, rep, component): the buckets that still hold several components under ``links`` (a, b)."""
    label = components(links).withColumnRenamed("node", "rep")
    rows = buckets.select("key", "rep").join(label, "rep", "left")
    rows = staged(rows.withColumn("component", F.coalesce("component", "rep")), "labelled")
    split = rows.groupBy("key").agg(F.min("component").alias("c_lo"), F.max("component").alias("c_hi"))
    split = staged(split.filter("c_lo < c_hi").select("key"), "split")
    return staged(rows.join(split, "key"), "open")


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("hi", "lo"))
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    # Larger neighbours of u only: (lo = u, hi = v).
    moved = links.join(least.withColumnRenamed("u", "lo"), "lo").select(F.col("m").alias("lo"), "hi")
    return moved.filter(F.col("lo") < F.col("hi")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = staged(links.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    moved = links.join(least, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
    kept = least.select(F.col("m").alias("lo"), "hi")
    return moved.filter(F.col("lo") < F.col("hi")).unionByName(kept).distinct()
