"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Run-time settings the plans rely on; all can be set on a live session.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time into advisory-sized pieces.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # What a task sorts for a join is a few times its shuffled bytes: many small partitions, joined up to this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "256",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Fused rule projections are wide; let codegen split them instead of giving up.
    "spark.sql.codegen.maxFields": "400",
    # The JVM never compiles a method over 8,000 bytes; above that Spark evaluates a projection in split methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended run-time settings to a live session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "ledgerproof", cpus: int | str = "*") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes inside leave no shuffle files behind.

    Spark otherwise keeps them until the driver happens to collect garbage, so a run of several writes would hold the files
    of all. Only for frames that are written once: a second action on the same frame would have to make its shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def empty(spark: SparkSession, path: str) -> None:
    """Make room: an intermediate table that nothing reads any more is replaced by one without rows."""
    spark.createDataFrame([], "nothing int").write.mode("overwrite").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session on one machine (a test) that names none gets a local one; on a cluster that is an error, since
    executors would write where nobody else can read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"ledgerproof-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
