"""Session defaults and the shared scratch folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "keepwell") -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


_LOCAL_ROOTS: dict[str, str] = {}
_HANDED_OUT: dict[str, list[str]] = {}
_KEPT: dict[SparkSession, dict] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder of its own: on a
    cluster such a folder would vanish with the machine that holds it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster.")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="keepwell-")
    return _LOCAL_ROOTS[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Long boosting runs cut their lineage by checkpoints, which need a folder to go to."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{scratch_root(spark)}/keepwell-checkpoints")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path, never used before, under the shared folder."""
    path = f"{scratch_root(spark)}/keepwell-{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage: everything downstream reads Parquet from shared storage, so a lost
    executor costs a re-read and not a recomputation, and column pruning works on the way back.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gave for ``key`` in this session, until its scratch paths are released."""
    held = _KEPT.setdefault(spark, {})
    if key not in held:
        held[key] = make()
    return held[key]


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch paths, once nothing reads it any more."""
    for session in [s for s in _KEPT if s.sparkContext is spark.sparkContext]:
        del _KEPT[session]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _HANDED_OUT.pop(spark.sparkContext.applicationId, []):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
