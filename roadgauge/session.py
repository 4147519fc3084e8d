"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from roadgauge.sinks.state import file_system

_owned: ContextVar[list[str] | None] = ContextVar("owned_folders", default=None)

RUNTIME_CONF = {
    # hour(), to_date() and casts follow the session zone; events are UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # one day's run must never delete another day's files
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partition folders named by a day are read as dates; readers that compare text cast them
    "spark.sql.sources.partitionColumnTypeInference.enabled": "true",
    # session windows merge on the map side, so a hot vehicle ships sessions and not pings
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "roadgauge", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session. Cluster sizing is left to the submit command."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only a local session may fall back to a machine-local folder, since its driver and
    executors share one disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="roadgauge-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    owned = _owned.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def own_folders(spark: SparkSession) -> Iterator[list[str]]:
    """Owner of the folders that scratch_dir and stage name within the block: they are removed at its end, also after an error.

    Frames made in the block read them, so results must be collected or written elsewhere before it ends. Of nested
    blocks the inner one owns. Without a block the folders stay, as do those named by other threads, such as a stream's.
    """
    made: list[str] = []
    token = _owned.set(made)
    try:
        yield made
    finally:
        _owned.reset(token)
        for path in made:
            fs, where = file_system(spark, path)
            fs.delete(where, True)


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends within the block are removed with it, and not when the driver happens to collect its garbage.

    For writes, which are not run a second time.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that is used more than once and read it back.

    Cuts lineage: the frame is computed once, and a lost executor costs a read.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
