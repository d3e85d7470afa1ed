"""Session and shared-folder helpers.

The library never creates its own session inside a job: callers own it.
``local_session`` exists for tests and ``bench.py`` only.

Scratch space (staged tables, copies of extracts written by the example
queries) always lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (a local test
session) do we choose one ourselves.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows that a task after a shuffle is dealt, and the shuffled bytes (compressed; in
#: memory they take some ten times that) up to which Spark puts small tasks together.
TASK_ROWS = 250_000
TASK_BYTES = 16 << 20
#: Spark's setting for removing the shuffle files of a job that has ended.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: With it, two sides that were both shuffled by some of a join's keys are shuffled again by all of them.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the cluster profile, for tests and bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillroll")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # small files: do not let one task read a whole 1 GB-per-split default
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
        # local disk only: no .crc side files for every Parquet file written
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.hadoop.fs.file.impl.disable.cache", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]?)b?\s*", text.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit.replace("b", "")]


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, object]) -> Iterator[None]:
    """What runs in the block has the ``wanted`` settings; those before come back after it."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:  # not set before
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs in the block shuffles ``rows`` rows into tasks of a bounded size, however many rows there are.

    The session's number of shuffle partitions is raised, never lowered, and its bound
    on the bytes of joined partitions lowered, never raised; each job's shuffle files go
    when it ends, not when the driver's memory is next collected.  All is put back after
    the block.  A frame that is made in the block but runs after it has the session's
    own settings.
    """
    number, joined = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    wanted = {number: max(int(spark.conf.get(number)), -(-rows // TASK_ROWS)), joined: min(_bytes(spark.conf.get(joined)), TASK_BYTES), FILES_GO: "true"}
    with settings(spark, wanted):
        yield


@contextmanager
def sized_reads(spark: SparkSession) -> Iterator[None]:
    """What runs in the block reads files in splits of a bounded size, the session's own bound lowered, never raised."""
    split = "spark.sql.files.maxPartitionBytes"
    with settings(spark, {split: min(_bytes(spark.conf.get(split)), TASK_BYTES)}):
        yield


def shared_root(spark: SparkSession) -> str:
    """Root of the shared scratch folder (``spark.checkpoint.dir``).

    Read from the session; only an unset value in a session with a local master
    gets a folder of our own, which is then registered as the checkpoint dir so
    that ``DataFrame.checkpoint`` lands in the same place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext handle (e.g. a remote session)
            root = None
    if not root and not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TILLROLL_LOCAL_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root for one run."""
    return f"{shared_root(spark)}/tillroll/{label}-{uuid.uuid4().hex[:12]}"
