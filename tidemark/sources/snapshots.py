"""Versioned feature snapshots: one Parquet dataset per id, split on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import snapshot_stamp
from tidemark.operators.sampling import TEST, TRAIN
from tidemark.session import session_setting, stage, staging
from tidemark.sources.csv import read_csv, write_csv

SPLIT = "split"
ID = "snapshot_id"
COPY = "copy_no"  # numbers the copies balancing made of a row, from 1


def new_snapshot_id(spark: SparkSession) -> str:
    """An id from the current time, to the second; ``Registry.reserve`` gives one nobody else has."""
    return spark.range(1).select(snapshot_stamp().alias(ID)).first()[ID]


def snapshot_path(root: str, snapshot_id: str) -> str:
    return f"{root.rstrip('/')}/{ID}={snapshot_id}"


def write_snapshot(df: DataFrame, root: str, snapshot_id: str) -> None:
    """Write features, label and ``split`` column; an existing id is refused.

    Each task keeps a file open per side rather than sorting its rows by side.
    """
    with session_setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        df.write.mode("errorifexists").partitionBy(SPLIT).parquet(snapshot_path(root, snapshot_id))


def read_snapshot(
    spark: SparkSession,
    root: str,
    snapshot_id: str,
    split: str | None = None,
    originals_only: bool = False,
) -> DataFrame:
    """Read one snapshot, or one side of it, touching only those files.

    ``originals_only`` leaves out the copies made by balancing.
    """
    df = spark.read.parquet(snapshot_path(root, snapshot_id))
    if split is not None:
        df = df.where(F.col(SPLIT) == split)
    if COPY in df.columns:
        df = (df.where(F.col(COPY) == 1) if originals_only else df).drop(COPY)
    return df.drop(SPLIT) if split is not None else df


def write_snapshot_csv(df: DataFrame, root: str, snapshot_id: str) -> None:
    """The same snapshot as two CSV folders, ``<id>_train`` and ``<id>_test``.

    Features and label share a file: two separate writes of one distributed
    table would not keep their rows in step. The table is staged, so that it is computed once.
    """
    with staging(df.sparkSession):
        staged = stage(df, "csv-snapshot")
        for side in (TRAIN, TEST):
            rows = staged.where(F.col(SPLIT) == side).drop(SPLIT)
            write_csv(rows, f"{root.rstrip('/')}/{snapshot_id}_{side}")


def read_snapshot_csv(
    spark: SparkSession, root: str, snapshot_id: str, schema: str | None = None
) -> DataFrame:
    """Both sides of a CSV snapshot as one table."""
    folder = root.rstrip("/")
    return read_csv(spark, [f"{folder}/{snapshot_id}_{s}" for s in (TRAIN, TEST)], schema)


def read_feature_files(
    spark: SparkSession, root: str, snapshot_id: str, schema: str | None = None
) -> DataFrame:
    """Features of a snapshot kept as ``<id>_x_train.csv`` and ``<id>_x_test.csv``."""
    folder = root.rstrip("/")
    return read_csv(spark, [f"{folder}/{snapshot_id}_x_{s}.csv" for s in (TRAIN, TEST)], schema)
