"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings, applied only where the session has not chosen its own.
# The skew settings let Spark split a hot join partition even when the split
# costs one extra exchange of already aggregated rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a cached table has as many partitions as its size asks for, not all of the shuffle before it
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch stores what it changed instead of whole files, and does not read each key again only to count the rows
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` without overriding anything set explicitly."""
    chosen = spark.conf.getAll
    for name, value in SETTINGS.items():
        if name not in chosen:
            spark.conf.set(name, value)
    return spark


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Statements run inside delete their shuffle files when they end.

    By default these stay until the driver happens to collect the plans that
    made them. A plan that is run a second time has to shuffle again.
    """
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a
    cluster a driver-local path would be invisible to the executors.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="marquee-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path or context.getCheckpointDir()
