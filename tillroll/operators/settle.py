"""Cutting lineage through tables written to the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        folder = tempfile.mkdtemp(prefix="tillroll-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_handed_out: list[str] = []
_stored_since = 0  # rises whenever stored tables are removed


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for a table that is written and read back."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def remove_stored(spark: SparkSession) -> int:
    """Deletes every table that this process has stored so far; says how many there were.

    Frames that still read them, lazy results included, can no longer be computed afterwards.
    """
    global _stored_since
    conf, removed = spark._jsc.hadoopConfiguration(), 0
    _stored_since += 1
    while _handed_out:
        path = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        removed += path.getFileSystem(conf).delete(path, True)
    return removed


def generation() -> int:
    """Tells results that read stored tables from those made before the last removal."""
    return _stored_since


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for an action within is removed as soon as the action ends.

    Otherwise it stays until the driver happens to collect its garbage.
    """
    before = spark.conf.get(SHUFFLES_GO)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder and read from there afterwards.

    A lost executor cannot take them along. As a Parquet table they still give later steps
    column pruning and a known size. What was shuffled for them is removed once they are written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "settled")
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Deletes settled frames that nothing reads any longer."""
    for df in stored:
        spark = df.sparkSession
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
