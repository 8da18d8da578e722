"""CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """Read CSV. Without a schema types are inferred, which reads the files twice."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.csv(path, header=True, schema=schema)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write CSV with a header and no index column."""
    df.write.mode(mode).csv(path, header=True)
