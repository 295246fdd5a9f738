"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_root_where_unset: str | None = None


def get_spark(app_name: str = "mercato", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every plan here assumes.

    Joins carry no broadcast hints on data of unknown size: the static and the adaptive broadcast
    thresholds decide from measured sizes, and adaptive skew-join splits hot keys beyond them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot key even where that costs one more shuffle, as between two joins on the same key
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_shared_root(path: str) -> None:
    """Folder for sessions without ``spark.checkpoint.dir``, as in local trials. The setting always comes first."""
    global _root_where_unset
    _root_where_unset = path


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _root_where_unset
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, empty folder in the shared folder, deleted when the session's JVM ends normally."""
    path = "/".join([shared_root(spark), "mercato-scratch", f"{label}-{uuid.uuid4().hex}"])
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the scan of it.

    Cuts lineage so that a lost executor costs a re-read, never a recompute that might differ; unlike a
    checkpoint, the files keep column pruning, filter pushdown and a size the planner can trust.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label) + "/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operation, deleted when it is done.

    Use it where nothing that is returned reads them; lazy results need :func:`materialise`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def materialise(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(f"{path}/data")
        return self.spark.read.schema(df.schema).parquet(f"{path}/data")

    def __exit__(self, *_) -> None:
        for path in self.paths:
            hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


_SHORT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files are deleted when the write or action that made them is done, and not only when the driver
    next collects its memory: an operation of many writes then needs the disk of those under way. Do not return lazy
    results from it."""
    before = spark.conf.get(_SHORT, None)
    spark.conf.set(_SHORT, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHORT) if before is None else spark.conf.set(_SHORT, before)


def bench_session(app_name: str = "mercato-bench") -> SparkSession:
    """Local session sized by ``BENCH_CPUS``."""
    import tempfile

    cpus = os.environ.get("BENCH_CPUS", "8")
    return get_spark(app_name, master=f"local[{cpus}]", **{
        "spark.checkpoint.dir": "file://" + tempfile.mkdtemp(prefix="mercato-bench-"),
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "20g",
    })
