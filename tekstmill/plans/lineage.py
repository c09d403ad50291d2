"""Where intermediate results are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Lists that note the paths handed out, one per open ``scratch`` block.
_LISTENERS: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``. Only where the
    setting is missing in a local session, as in a test, a temporary folder takes its
    place; on a cluster that is an error, since executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for written in _LISTENERS:
        written.append(path)
    return path


def cut_lineage(df: DataFrame, name: str = "step", drop_shuffles: bool = False) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    What is built on them is planned with their true size, computes them once only, and
    outlives the executors that made them. With ``drop_shuffles`` the shuffle files of the
    write go as soon as it stands; else they stay until the driver collects its garbage.
    """
    path = scratch_path(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession) if drop_shuffles else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are removed at its end."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def remove_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders that a job wrote below the shared folder, once its outputs stand."""
    jvm = spark._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Whatever is written below the shared folder inside is removed at the end, and kept where a job fails, so that
    its cause can be looked into."""
    written: list[str] = []
    _LISTENERS.append(written)
    try:
        yield
        remove_scratch(spark, written)
    finally:
        _LISTENERS.remove(written)
