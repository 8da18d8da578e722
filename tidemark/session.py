"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_BYTES = 128 << 20  # input, as compressed in its files, per shuffle partition
UNKNOWN_BYTES = 1 << 60  # Spark reports a size like this when it knows none

# Kept alive so that the folder goes away with the process (local runs only).
_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(
    cores: int | str = "*", memory: str = "8g", app: str = "tidemark"
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording a call site for every column expression costs more than planning.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.TemporaryDirectory(prefix="tidemark-")
    return _local_folders[app].name


# Paths given out within the innermost `staging` block, if any.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    inside = _staged.get()
    if inside is not None:
        inside.append(path)
    return path


@contextmanager
def staging(spark: SparkSession, keep: str | None = None) -> Iterator[list[str]]:
    """Delete what was staged within the block when it ends, also by an error.

    Paths named ``keep`` (all, if that is empty) outlive a block that ends well; they then
    belong to the block around it or, without one, to the caller.
    """
    outer, own = _staged.get(), []
    token = _staged.set(own)
    kept: list[str] = []
    try:
        yield own
        if keep is not None:
            name = f"{keep}-" if keep else ""
            kept = [p for p in own if p.rpartition("/")[2].startswith(name)]
    finally:
        _staged.reset(token)
        for path in own:
            if path not in kept:
                discard(spark, path)
        if outer is not None:
            outer.extend(kept)


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative fits a checkpoint folder unless the session has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


def input_bytes(df: DataFrame) -> int | None:
    """Total size of the tables ``df`` reads, or None if Spark cannot tell."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    total = sum(sizes)
    return total if total < UNKNOWN_BYTES else None


def shuffle_partitions(df: DataFrame) -> int:
    """How many partitions a shuffle of ``df`` should have.

    Never fewer than the session says; on large input, enough for each to fit
    in memory. Adaptive execution merges those that turn out small.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = input_bytes(df)
    return configured if size is None else max(configured, -(-size // SHUFFLE_BYTES))


def stage_at(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back, with shuffles sized to the input.

    Cuts lineage so that later passes neither repeat a shuffle nor depend on
    lost executors, and, unlike a checkpoint, keeps column pruning and pushdown.
    """
    with sized_shuffles(df):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """:func:`stage_at` a fresh path in the shared folder."""
    return stage_at(df, scratch_path(df.sparkSession, name))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table; only paths in the shared folder are accepted."""
    if not path.startswith(f"{shared_folder(spark)}/"):
        raise ValueError(f"{path} was not staged here")
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a runtime setting for one write and put the old value back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def sized_shuffles(*frames: DataFrame) -> Iterator[int]:
    """Run jobs on lazily returned tables with shuffles sized to what the largest reads.

    ``with sized_shuffles(result): result.write...``; yields the number of partitions. The setting is
    the session's, so jobs of other threads that start meanwhile get it too.
    """
    parts = max(shuffle_partitions(df) for df in frames)
    spark = frames[0].sparkSession
    with session_setting(spark, "spark.sql.shuffle.partitions", str(parts)):
        yield parts
