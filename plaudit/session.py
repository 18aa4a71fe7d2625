"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Settings that results or scale depend on; they can be applied to a session that already runs.
RUNTIME = {
    # Epoch and calendar functions must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # Skewed join partitions are split and tiny ones merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also when the rows are then grouped by the join key, at the price of one more shuffle of
    # partial aggregates; otherwise a hot product would be joined and grouped in one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A write split in valid and rejected rows keeps both files open instead of sorting each task.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Shuffle files go when the query that wrote them ends, and not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
SETTINGS = {**RUNTIME, "spark.ui.enabled": "false"}

ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload state changes, not whole snapshots, at every commit.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A count of all rows would cost one more look-up for each write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# A query that drains its source has few micro-batches and then stops. The next start would make every change since the last
# snapshot again, so a snapshot is kept, of which only new files are uploaded.
_DRAINING = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("plaudit")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def in_utc(spark: SparkSession) -> SparkSession:
    """The one setting that results depend on."""
    spark.conf.set("spark.sql.session.timeZone", RUNTIME["spark.sql.session.timeZone"])
    return spark


def tuned_session(spark: SparkSession) -> SparkSession:
    """A sibling session with all settings, so the caller's session stays untouched."""
    return tune(spark.newSession())


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile delete their shuffle files when they end; for those whose result is written and read again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, RUNTIME[key])
    try:
        yield
    finally:
        spark.conf.set(key, before)


def measured_session(spark: SparkSession) -> SparkSession:
    """A sibling session that broadcasts a join's side by its measured size alone.

    Spark's estimate takes parsed variants for 2,048 bytes each, and the typed columns left of them for so small a share of
    the input that any number of parsed rows would be broadcast, through the driver.
    """
    child = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        child.conf.set(key, spark.conf.get(key))
    most = "spark.sql.autoBroadcastJoinThreshold"
    child.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", spark.conf.get(most))
    child.conf.set(most, "-1")
    return child


def stateful_session(spark: SparkSession, state_partitions: int, draining: bool = False) -> SparkSession:
    """A sibling session with the state-store settings, so the caller's session stays untouched."""
    child = tune(spark.newSession())
    for key, value in {**ROCKSDB_STATE, **(_DRAINING if draining else {})}.items():
        child.conf.set(key, value)
    child.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return child


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="plaudit-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder all executors share.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used only in local
    mode with that setting unset, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/plaudit/{label}-{uuid.uuid4().hex}"
