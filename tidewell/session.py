"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package counts on. Broadcasts are left to
# Spark: it broadcasts a side only when its measured size is below
# spark.sql.autoBroadcastJoinThreshold (AQE measures at run time), and falls back to a shuffled join that
# AQE may split on skew. forceOptimizeSkewedJoin lets AQE split a hot key even
# where that costs one more exchange further up.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What AQE cuts a shuffle into before it merges small partitions again; see size_shuffles.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Bytes of stored (Parquet) input per shuffle partition: some 200,000 rows of a fact of this lake.
PARTITION_INPUT = 4 << 20
# AQE merges partitions up to this size; the default of 64 MB of shuffled facts is millions of rows in a task's hash table.
ADVISORY, TASK_SHUFFLE = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 << 20

# Whether the sides of a join must be dealt out by all of its keys; without, a side dealt out by some of them stays so.
JOIN_ON_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Only takes effect when the context starts: drop stored results nobody refers to any more.
CLEAN_CHECKPOINTS = "spark.cleaner.referenceTracking.cleanCheckpoints"


def configure(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(ADVISORY)) > TASK_SHUFFLE:  # a session that asks for less keeps it
        spark.conf.set(ADVISORY, TASK_SHUFFLE)
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Hold a setting for the plans that run inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with: the session's number, or more where ``size_shuffles`` asked for it."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, int(spark.conf.get(INITIAL_PARTITIONS, None) or 0))


def size_shuffles(spark: SparkSession, paths: Sequence[str]) -> None:
    """Cut shuffles into enough partitions for the files at ``paths``, so that a task's share does not grow with them.

    A number fixed for the session makes every sort and hash table of a task grow with the input until it spills. The
    number is only raised, as plans made earlier in the session may still run; AQE merges what turns out small.
    """
    found = 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found += system.getContentSummary(folder).getLength() if system.exists(folder) else 0
    wanted = -(-found // PARTITION_INPUT)
    if wanted > shuffle_partitions(spark):
        spark.conf.set(INITIAL_PARTITIONS, wanted)


def build_session(app: str = "tidewell", master: str | None = None, **settings) -> SparkSession:
    """A session with the settings above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config(CLEAN_CHECKPOINTS, "true")
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, for checkpoints and intermediate tables.

    The cluster names it in spark.checkpoint.dir. Only a local session without
    that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not folder:
        # "local-cluster" has executors of its own, so it counts as a cluster.
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="tidewell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Run ``df`` once and continue from the stored result.

    Needed where two later passes must see the very same rows in the very same
    place (range partitions are laid out from a sample, so evaluating them twice
    may differ), and where several passes would redo a fact-sized job.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
